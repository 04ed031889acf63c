import pytest
from pyspark.sql import functions as F

from gleanrow.functions import geo, similarity
from gleanrow.functions import text as T
from gleanrow.functions.options import Options


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").collect()]


def test_identity_normalisers(spark):
    assert values(spark, ["RO 41137103", "J40/1234/2020", "", None, "ro"], T.normalize_registration) == ["41137103", "j4012342020", None,
        None, None]
    phones = ["+40 721 234 567", "0040721234567", "0721234567", "123", None, "721234567", "40123456", "0012345678901"]
    assert values(spark, phones, T.normalize_phone) == ["721234567", "721234567", "721234567", None, None, "721234567", None, "345678901"]
    assert values(spark, ["  Host@Example.COM ", "not-an-email", None, "a@b@c.d", "a b@c.d"], T.normalize_email) == ["host@example.com",
        None, None, None, None]


def test_keys_share_a_namespace_unless_asked(spark):
    df = spark.createDataFrame([("RO721234567", "0721234567", None)], "r string, p string, e string")
    cols = F.col("r"), F.col("p"), F.col("e")
    one, two = df.select(T.identity_keys(*cols), T.identity_keys(*cols, namespaced=True)).first()
    assert one == ["721234567"] and two == ["reg:721234567", "tel:721234567"]


def test_plain_text(spark):
    assert values(spark, ["a—b–c ‘x’ “y” …`"], T.plain_text) == ["a-b-c 'x' \"y\" ...'"]


@pytest.mark.parametrize(
    ("address", "want"),
    [
        ("Strada Lunga nr. 94-100, bloc A2, ap. 3", "Strada Lunga 94"), ("Strada Lunga 12, A2", "Strada Lunga 12"),
        ("Strada Lunga, 12", "Strada Lunga, 12"), ("Calea X 5 sc1 et 2", "Calea X 5"),
        ("Bd. Y 7, 12B", "Bd. Y 7"), ("bloc 3", ""), ("Strada Apei 4", "Strada Apei 4"),
    ],
)
def test_clean_street(spark, address, want):
    assert values(spark, [address], T.clean_street) == [want]


def test_payload_address_and_level(spark):
    rows = ['{"basicPropertyData":{"location":{"address":"Strada A nr. 3, ap. 1","city":"Town"}}}', '{"location":{"address":"Old Square"}}',
        '{"location":{"address":"ap. 1","city":"T"}}', "{bad", None, "[]"]
    assert values(spark, rows, T.payload_address) == ["Strada A 3, Town", "Old Square", None, None, None, None]
    assert values(spark, ["Strada A 3", "12 Main", "Main 12", None, ""], T.is_street_level) == [True, True, False, False, False]
    assert values(spark, ["  Strada   A\n3 "], T.address_key) == ["strada a 3"]


def test_page_scalars(spark):
    assert values(spark, ['x"mapMarkerRadiusInMeters": 152.5,', '"mapMarkerRadiusInMeters":0', "none", None], T.map_radius) == [152.5, 0.0,
        None, None]
    html = "".join(f'{{"__typename":"AmenityItem","available":{a},"title":"{t}"}}' for a,
        t in (("true", "Wifi "), ("false", "Pool"), ("true", "wifi"), ("true", "Air con")))
    assert values(spark, [html, None], T.available_amenities) == [["air con", "wifi"], []]


def test_room_counts(spark):
    rows = [["2 bedrooms", "3 beds", "1.5 baths", "4 guests"], ["Studio", "1 bed"], ["studio", "2 bedrooms"], ["1 bed", "2 beds"], [], None]
    got = [tuple(x) for x in values(spark, rows, T.room_counts, "array<string>")]
    assert got == [(2, 3, 1.5, 4), (0, 1, None, None), (2, None, None, None), (None, 2, None, None), (None,) * 4, (None,) * 4]


def test_prices_ratings_ids(spark):
    assert [tuple(x) for x in values(spark, ["4.85 (120)", "4,7", "New", None], T.rating_parts)] == [(4.85, 120), (4.7, None), (None, None),
        (None, None)]
    assert values(spark, [["x", "5 nights x € 174.69"], ["1 night × 80,5"], ["total"], []], T.nightly_price, "array<string>") == [174.69,
        80.5, None, None]
    assert values(spark, ["€ 1,234", "none", None], T.digits_price) == [1234.0, None, None]
    assert values(spark, ["RGVtYW5kU3RheUxpc3Rpbmc6MTIzNDU=", "RGVtYW5kU3RheUxpc3Rpbmc6MTIzNDU", "plain!", None], T.decoded_id) == ["12345",
        "12345", "plain!", None]
    assert values(spark, [204, 999, None], T.accommodation_type, "int") == ["hotel", "type_999", None]
    assert values(spark, ["<a href=\"x\">'&'</a>", None], T.html_escape) == ["&lt;a href=&quot;x&quot;&gt;&#x27;&amp;&#x27;&lt;/a&gt;", ""]


def test_geo(spark):
    df = spark.createDataFrame([(44.43, 26.10, 44.44, 26.10)], "a double, b double, c double, d double")
    d = df.select(geo.haversine(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]
    assert d == pytest.approx(1111.9, abs=0.2)
    assert values(spark, [0.0, 75.0, 150.0, 400.0], geo.position_confidence, "double") == [1.0, 0.5, 0.0, 0.0]
    assert values(spark, [360.0, 1.0, 0.0, 1e-9], geo.zoom_level, "double") == [1, 8, 15, 20]


def test_sigma_ladder(spark):
    rows = [("booking", "Strada A 3", None, 1), ("booking", "Park", None, 1), ("booking", "Strada A 3", None, 3), ("airbnb", None, None, 1),
        ("airbnb", None, 0.0, 9), ("airbnb", None, 152.0, 1)]
    df = spark.createDataFrame(rows, "p string, a string, r double, n int")
    got = [x[0] for x in df.select(geo.scraped_sigma(F.col("p"), F.col("a"), F.col("r"), F.col("n"))).collect()]
    assert got == [50.0, 150.0, 150.0, 100.0, 15.0, pytest.approx(106.4)]
    own = [x[0] for x in df.select(geo.platform_precision(F.col("p"), F.col("a"), F.col("r"))).collect()]
    assert own == ["exact", "approximate", "exact", None, "exact", "approximate"]


def test_name_similarity_both_ways(spark):
    pairs = [("Cosy Flat", "cosy flat"), ("abc", "xyz"), (None, ""), ("kitten", "sitting"), ("", "a"),
        ("Old Town Apartment 2", "Old Town Apartament"), ("ää", "äb")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select(similarity.name_similarity("a", "b").alias("u"),
        similarity.indel_ratio_sql(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r["u"] for r in rows] == pytest.approx([100, 0, 100, 100 * 8 / 13, 0, 100 * 36 / 39, 50])
    assert [r["s"] for r in rows] == pytest.approx([r["u"] for r in rows])


def test_name_similarity_of_long_names(spark):
    import random

    rng = random.Random(5)
    names = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (0, 1, 30, 61, 62, 63, 123, 124, 125, 200, 400)]
    pairs = [(a, b) for a in names for b in names] + [(None, names[7]), ("A" * 124, "a" * 62 + "b" + "a" * 62)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", similarity.name_similarity("a", "b").alias("r")).collect()
    assert [x["r"] for x in got] == pytest.approx([similarity.indel_ratio(x["a"], x["b"]) for x in got])


def test_pair_plans_have_no_python(spark):
    from gleanrow.operators import blocking

    side = "id long, platform string, name string, latitude double, longitude double, bedrooms int, beds int, bathrooms double, " \
        "max_guests int, amenities array<string>"
    rows = spark.createDataFrame([(i, "booking", f"Flat {i % 3}", 44.4, 26.1, 1, 1, 1.0, 2, ["x"]) for i in range(9)], side)
    pairs = blocking.strict_candidates(rows)
    assert "Python" not in pairs._jdf.queryExecution().toString() and pairs.count() == 36


def test_options(tmp_path):
    (tmp_path / "o.yaml").write_text("strict_name: 90\n")
    o = Options.load(str(tmp_path / "o.yaml"))
    assert (o.strict_name, o.relaxed_name) == (90, 70.0)
    (tmp_path / "o.yaml").write_text("nope: 1\n")
    with pytest.raises(ValueError, match="nope"):
        Options.load(str(tmp_path / "o.yaml"))


def test_options_from_sections(tmp_path):
    from gleanrow.functions.options import Options

    city = tmp_path / "city.yaml"
    city.write_text("city: X\ngrid:\n  refine_threshold: 0.8\n  other: 3\nbooking:\n  results_cap: 99\n")
    rules = tmp_path / "rules.yaml"
    rules.write_text("delays:\n  a: 1\ndedup:\n  strict_name_threshold: 85\nfusion:\n  disagreement_km: 2.5\nmin_sigma: 7.0\n")
    o = Options.load(str(city), str(rules))
    assert (o.refine_threshold, o.cap_a, o.strict_name, o.disagreement_m, o.min_sigma, o.cap_b) == (0.8, 99, 85, 2500.0, 7.0,
        Options().cap_b)
    rules.write_text("no_such_option: 1\n")
    with pytest.raises(ValueError, match="no_such_option"):
        Options.load(str(rules))
