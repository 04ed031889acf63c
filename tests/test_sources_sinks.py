import base64
import csv
import json

import pytest
from pyspark.sql import functions as F

from gleanrow.functions.jsonslice import balanced, value_at_key
from gleanrow.operators import report
from gleanrow.sinks import files
from gleanrow.sources import pages, payloads, tables
from gleanrow.streaming import ingest


def frame(spark, items):
    return payloads.items(spark.createDataFrame([("c1", json.dumps(items))], "cell string, payload string"))


def test_platform_a(spark):
    item = {
        "displayName": {"text": "Flat — “A”"}, "blocks": [{"finalPrice": {"amount": 497.0, "currency": "RON"}}],
        "matchingUnitConfigurations": [{"commonConfiguration": {"nbBedrooms": 2, "nbBathrooms": 1, "nbAllBeds": 3}}],
        "basicPropertyData": {"id": 7, "location": {"latitude": 44.4, "longitude": 26.1}, "starRating": {"value": 3},
        "reviews": {"totalScore": 8.7, "reviewsCount": 12}, "photos": {"main": {"highResJpegUrl": {"relativeUrl": "/x.jpg"}}},
        "pageName": "p", "accommodationTypeId": 204},
    }
    zero, missing = json.loads(json.dumps(item)), json.loads(json.dumps(item))
    zero["basicPropertyData"]["location"] = {}
    missing["basicPropertyData"]["id"] = ""
    one = item | {"matchingUnitConfigurations": {"commonConfiguration": {"nbBedrooms": 1}}, "blocks": []}
    rows = payloads.parse_a(frame(spark, [item, zero, missing, "text", one]), "ro", F.lit("c1"))
    assert {r["status"]: r["n"] for r in report.parse_stats(rows).collect()} == {"parsed": 2, "zero_coords": 1, "missing_id": 1,
        "parse_error": 1}
    r, s = payloads.parsed(rows).orderBy(F.desc("bedrooms")).collect()
    assert (r["id"], r["name"], r["property_type"], r["price_per_night"], r["currency"], r["price_original"],
        r["currency_original"]) == ("booking_7", 'Flat - "A"', "hotel", 100.0, "EUR", 497.0, "RON")
    assert (r["bedrooms"], r["beds"], r["bathrooms"], r["review_count"], r["star_rating"]) == (2, 3, 1.0, 12, 3.0)
    assert (r["url"], r["thumbnail_url"], r["grid_cell_id"]) == ("https://www.booking.com/hotel/ro/p.html", "https://cf.bstatic.com/x.jpg",
        "c1")
    assert (s["bedrooms"], s["price_per_night"], s["currency_original"]) == (1, None, None)


def raw_item(pid, desc="5 nights x € 174.69", kind="StaySearchResult"):
    return {
        "__typename": kind, "avgRatingLocalized": "4.85 (120)",
        "demandStayListing": {"id": base64.b64encode(f"DemandStayListing:{pid}".encode()).decode(),
        "location": {"coordinate": {"latitude": 44.4, "longitude": 26.1}},
        "description": {"name": {"localizedStringWithTranslationPreference": "Flat’s"}}},
        "structuredDisplayPrice": {"explanationData": {"priceDetails": [{"items": [{"description": desc}]}]},
        "primaryLine": {"price": "€ 1,234"}},
        "structuredContent": {"mapPrimaryLine": [{"body": "2 bedrooms"}, {"body": "3 beds"}]}, "contextualPictures": [{"picture": "u"}],
    }


def test_platform_b_raw(spark):
    body = {"data": {"presentation": {"staysSearch": {"results": {"searchResults": [raw_item(123456), raw_item(7777, "total"),
        raw_item(1, kind="Other")], "paginationInfo": {"nextPageCursor": "cur"}}}}}}
    df = spark.createDataFrame([(json.dumps(body),), ("{}",)], "payload string")
    assert [r[0] for r in df.select(payloads.next_cursor(F.col("payload"))).collect()] == ["cur", None]
    r, s = payloads.parsed(payloads.parse_b_raw(payloads.items(df, payloads.RAW_ITEMS_PATH))).orderBy("id").collect()
    assert (r["id"], r["name"], r["price_per_night"], r["review_score"], r["review_count"], r["bedrooms"], r["beds"],
        r["thumbnail_url"]) == ("airbnb_123456", "Flat's", 174.69, 4.85, 120, 2, 3, "u")
    assert (s["id"], s["price_per_night"]) == ("airbnb_7777", 1234.0)


def test_platform_b_map_and_library(spark):
    m = {"listing": {"id": "5", "coordinate": {"latitude": 1.0, "longitude": 2.0}, "name": "n", "roomTypeCategory": "entire",
        "avgRating": 4.5, "reviewsCount": 3, "isSuperhost": True}, "pricingQuote": {"rate": {"amount": 80, "currency": "EUR"}}}
    body = {"data": {"presentation": {"staysSearch": {"mapResults": {"mapSearchResults": [m]}}}}}
    df = spark.createDataFrame([(json.dumps(body),)], "payload string")
    r = payloads.parse_b_map(payloads.items(df, payloads.MAP_ITEMS_PATH)).first()
    assert (r["id"], r["price_per_night"], r["currency"], r["is_superhost"], r["property_type"], r["status"]) == ("airbnb_5", 80.0, "EUR",
        True, "entire", "parsed")
    lib = {"room_id": 9, "name": "n", "coordinates": {"latitude": 1.0, "longitud": 2.0}, "price": {"unit": {"amount": 50}},
        "rating": {"value": 4.0, "reviewCount": "12"}, "images": ["i"]}
    r = payloads.parse_b_library(frame(spark, [lib])).first()
    assert (r["id"], r["longitude"], r["price_per_night"], r["currency"], r["review_count"], r["thumbnail_url"]) == ("airbnb_9", 2.0, 50.0,
        "USD", 12, "i")
    d = payloads.parse_detail(spark.createDataFrame([(json.dumps({"person_capacity": 4, "is_super_host": False,
        "sub_description": {"items": ["1 bedroom", "2 beds"]}}),)], "detail string")).first()
    assert (d["max_guests"], d["is_superhost"], d["bedrooms"], d["beds"]) == (4, False, 1, 2)


def test_slices():
    assert balanced('{"a":"}\\"{","b":{"c":1}} tail', 0) == '{"a":"}\\"{","b":{"c":1}}'
    assert balanced('{"a":', 0) is None and balanced('{"a":1}', 0, 3) is None
    assert value_at_key('x "k" : null', "k") == ("null", None)
    assert value_at_key('"k":{"a":1}', "k") == ("object", '{"a":1}')
    assert value_at_key('"k":{bad}', "k") == ("object", None)
    assert value_at_key('"k":3', "k") == value_at_key(None, "k") == (None, None)


def page_a(spark, html):
    return pages.parse_pages_a(spark.createDataFrame([(h,) for h in html], "html string")).collect()


def test_pages_a(spark):
    ld = lambda x: f'<script type="application/ld+json">{json.dumps(x)}</script>'
    hotel = {"@type": "Hotel", "offers": [{"priceSpecification": {"price": "497", "priceCurrency": "RON"}}], "occupancy": {"maxValue": 4},
        "numberOfRooms": 2, "legalName": " Firm SRL ", "vatID": "RO1", "email": "a@b.c"}
    trader = lambda x: '"traderInfo":' + json.dumps(x)
    contact = {"companyLegalName": "", "firstName": "A", "lastName": "B", "registrationNumber": 55, "phoneNumber": "07",
        "address": {"addressLine1": "S 1", "city": "T", "countryCode": "ro"}}
    rows = page_a(
        spark,
        [
            ld(hotel), "<script type=\"application/ld+json\">{bad</script>" + ld([{"@type": "Other", "offers": {"price": 9}},
            {"@type": "Organization", "name": "Org"}]),
            '<meta property="og:price:amount" content="80.5"><meta property="og:price:currency" content="USD">',
            '{"price": 70, "currency": "EUR", "maxOccupancy": 3}',
            trader({"isTrader": True, "contactDetails": contact, "regulatorySubjectType": "PRIVATE_INDIVIDUAL"}),
            trader({"isTrader": False, "contactDetails": contact}), None,
        ],
    )
    a, b, c, d, e, f, g = rows
    assert (a["price_per_night"], a["currency"], a["price_original"], a["max_guests"], a["bedrooms"], a["business_name"], a["vat"],
        a["email"]) == (100.0, "EUR", 497.0, 4, 2, "Firm SRL", "RO1", "a@b.c")
    assert (b["price_per_night"], b["business_name"]) == (9.0, "Org")  # scripts are scanned over the whole page
    assert (c["price_per_night"], c["currency"], d["price_per_night"], d["max_guests"]) == (80.5, "USD", 70.0, 3)
    assert (e["business_name"], e["registration"], e["phone"], e["address"], e["country"], e["business_type"]) == ("A B", "55", "07",
        "S 1, T, RO", "RO", "Individual")
    assert (f["business_type"], f["business_name"]) == ("Private", None)
    assert all(g[k] is None for k in ("price_per_night", "business_type", "business_name"))
    addr = spark.createDataFrame([('{"streetAddress":"S 1","addressCountry":{"name":"RO"}}',), (" plain ",)], "a string")
    assert [r[0] for r in addr.select(pages.ld_address(F.col("a"))).collect()] == ["S 1, RO", "plain"]


def test_pages_b(spark):
    said = "Ann is solely responsible for offering this listing on Airbnb, and they host as a business. <ul><li>Business name: Firm SRL.</li><li>Unique identification number: 123</li><li>Address: S 1, Town, Romania</li></ul>"
    html = [
        '"htmlText":' + json.dumps(said) + ',"x":1', '"hostLegalDisclaimer":null "hostLegalDisclaimer":"Firm \\u0041"',
        '"businessDetails":{"detailsHtml":"<b>Firm</b>  X"}',
        '"businessDetailsItem":{"action":{"screenId":"PROFESSIONAL_HOST_DETAILS"}}',
        '"businessDetailsItem":{"title":"Offered by an individual"}', '"businessDetails":null', "nothing",
        '"PassportCardData","name":"Ann","userId":"' + base64.b64encode(b"User:98765").decode() + '" "hostDetails":["Response rate: 100%","Responds within an hour"] "title":"4 years hosting"',
    ]
    rows = pages.parse_pages_b(spark.createDataFrame([(h,) for h in html], "html string")).collect()
    assert [r["business_type"] for r in rows] == ["Professional"] * 4 + ["Individual"] * 2 + [None, None]
    assert [r["business_name"] for r in rows[:4]] == ["Firm SRL", "Firm A", "Firm X", None]
    assert (rows[0]["registration"], rows[0]["address"], rows[0]["country"]) == ("123", "S 1, Town, Romania", "Romania")
    h = rows[-1]
    assert (h["host_name"], h["host_id"], h["host_response_rate"], h["host_response_time"], h["host_join_date"]) == ("Ann", "98765",
        "Response rate: 100%", "Responds within an hour", "4 years hosting")


LISTINGS = "id string, platform string, name string, latitude double, longitude double, latitude_best double, longitude_best double, location_source string, location_precision string, geocoded_address string, raw_json string, is_superhost int, business_type string, group_id string"


@pytest.fixture
def listings(spark):
    rows = [
        ("a", "booking", "B <x>", 1.0, 2.0, 1.5, None, "geocoded_address", "exact", "S 1", '{"location":{"address":"S 1, bloc 2"}}', 1,
        "Professional", "g"),
        ("b", "airbnb", "A", 3.0, 4.0, None, None, None, None, None, "bad", None, None, "g"),
        ("c", "airbnb", "Z", 0.0, 4.0, None, None, None, None, None, None, 0, None, None),
    ]
    return spark.createDataFrame(rows, LISTINGS)


def test_sinks(spark, listings, tmp_path):
    path = files.export_csv(listings, str(tmp_path / "l.csv"))
    data = (tmp_path / "l.csv").read_bytes()
    assert data.startswith(b"\xef\xbb\xbf")
    rows = list(csv.DictReader(open(path, encoding="utf-8-sig")))
    assert [r["id"] for r in rows] == ["b", "c", "a"]
    names = list(rows[0])
    assert names[names.index("name") + 1 :][:4] == ["map_latitude", "map_longitude", "map_source",
        "map_precision"] and names[names.index("geocoded_address") + 1] == "address_raw"
    assert (rows[2]["map_latitude"], rows[2]["address_raw"], rows[0]["map_source"], rows[0]["map_precision"]) == ("1.5", "S 1, bloc 2",
        "platform_coord", "approximate")
    doc = json.loads(open(files.export_geojson(listings, str(tmp_path / "l.json"))).read())
    f = doc["features"][2]
    assert f["geometry"]["coordinates"] == [2.0, 1.5] and "latitude" not in f["properties"] and f["properties"]["is_superhost"] is True
    assert doc["features"][0]["properties"]["location_source"] is None
    files.save_geojson(listings, str(tmp_path / "parts"))
    parts = [json.loads(x.read_text()) for x in sorted((tmp_path / "parts").glob("part-*"))]
    assert all(x["type"] == "FeatureCollection" for x in parts) and [f for x in parts for f in x["features"]] == doc["features"]
    page = open(files.export_map(listings, str(tmp_path / "m.html"))).read()
    assert "B &lt;x&gt;" in page and "darkblue" in page and "Total: 2" in page
    review = list(csv.DictReader(open(files.export_review(listings, str(tmp_path / "r.csv"), 1), encoding="utf-8-sig")))
    assert [r["id"] for r in review] == ["a", "b"]
    files.export_metrics(spark.createDataFrame([(1, None)], "n int, x double"), str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"n": 1, "x": None}
    files.dump_raw(spark.createDataFrame([("c1", "{}")], "cell_id string, payload string"), str(tmp_path / "raw"))
    assert tables.landed(spark, str(tmp_path / "raw" / "*")).count() == 1
    with pytest.raises(ValueError, match="nope"):
        report.map_projection(listings, ("nope", "name"))


def test_snapshots(spark, tmp_path):
    for d in ("db.backup-1", "db.backup-3", "db.backup-2"):
        (tmp_path / d).mkdir()
    assert tables.latest_snapshot(spark, str(tmp_path / "db.backup-*")).endswith("db.backup-3")
    assert tables.latest_snapshot(spark, str(tmp_path / "none-*")) is None


def test_stream_upsert_keeps_known_values(spark, tmp_path):
    schema = "id long, name string, price double, seq long"
    src = str(tmp_path / "in")
    start = lambda: ingest.upsert_into(spark.readStream.schema(schema).json(src), str(tmp_path / "t"), str(tmp_path / "cp"), ["id"], "seq",
        ["name"], []).awaitTermination()
    spark.createDataFrame([(1, "a", 5.0, 1), (1, "b", None, 2)], schema).coalesce(1).write.json(src)
    start()
    spark.createDataFrame([(1, "c", None, 3), (2, "n", 1.0, 4)], schema).coalesce(1).write.mode("append").json(src)
    start()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t" / "v=1")).collect())) == [(1, "c", 5.0), (2, "n", 1.0)]


def test_popup_rounds_ties_to_even(spark):
    rows = spark.createDataFrame([(1, 62.5, 0.25), (2, 63.5, 0.75), (3, 62.4, 1.0)], "id long, price_per_night double, bathrooms double")
    rows = rows.selectExpr("*", "'x' as name", "'u' as url", "'EUR' as currency")
    shown = {r["id"]: r["popup"] for r in rows.select("id", files.popup_html(rows).alias("popup")).collect()}
    for i, price, baths in ((1, 62, 0.2), (2, 64, 0.8), (3, 62, 1.0)):
        assert f"<td>{price} EUR</td>" in shown[i] and f"<td>{baths}</td>" in shown[i]
