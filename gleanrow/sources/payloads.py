"""Landed search payloads to listing rows.

Every source is text -> items (exploded) -> typed struct -> listing columns and a status:
parsed, missing_id, zero_coords or parse_error. Rows are never dropped silently: split them
with parsed() and count them with report.parse_stats().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.geo import to_eur
from ..functions.options import Options

LISTING = (
    "id", "platform", "platform_id", "name", "latitude", "longitude", "property_type", "star_rating", "review_score", "review_count",
    "price_per_night", "currency",
    "price_original", "currency_original", "url", "thumbnail_url", "bedrooms", "beds", "bathrooms", "max_guests", "is_superhost",
    "grid_cell_id", "raw_json", "status",
)
# Where items are in a payload, and public addresses.
RAW_ITEMS_PATH = "$.data.presentation.staysSearch.results.searchResults"
MAP_ITEMS_PATH = "$.data.presentation.staysSearch.mapResults.mapSearchResults"
CURSOR_PATH = "$.data.presentation.staysSearch.results.paginationInfo.nextPageCursor"
RAW_ITEM_TYPE = "StaySearchResult"
PHOTO_HOST = "https://cf.bstatic.com"
SITE_A, SITE_B = "https://www.booking.com/hotel", "https://www.airbnb.com/rooms"

_A = """displayName struct<text:string>, blocks array<struct<finalPrice:struct<amount:double,currency:string>>>, matchingUnitConfigurations string,
basicPropertyData struct<id:string, location:struct<latitude:double,longitude:double>, starRating:struct<value:double>, reviews:struct<totalScore:double,reviewsCount:int>,
photos:struct<main:struct<highResJpegUrl:struct<relativeUrl:string>>>, pageName:string, accommodationTypeId:int>"""
_PRICE_DETAILS = "explanationData:struct<priceDetails:array<struct<items:array<struct<description:string>>>>>"
_LINES = "structuredContent:struct<mapPrimaryLine:array<struct<body:string>>>"
_RAW = f"""demandStayListing struct<id:string, location:struct<coordinate:struct<latitude:double,longitude:double>>, description:struct<name:struct<localizedStringWithTranslationPreference:string>>>,
avgRatingLocalized string, structuredDisplayPrice struct<{_PRICE_DETAILS}, primaryLine:struct<originalPrice:string,price:string>>,
{_LINES.replace(':', ' ', 1)}, contextualPictures array<struct<picture:string>>"""
_MAP = f"""listing struct<id:string, coordinate:struct<latitude:double,longitude:double>, name:string, roomTypeCategory:string, avgRating:double, reviewsCount:int, isSuperhost:boolean,
{_LINES}, contextualPictures:array<struct<picture:string>>>, structuredDisplayPrice struct<{_PRICE_DETAILS}>, pricingQuote struct<rate:struct<amount:double,currency:string>>"""
_LIBRARY = f"""room_id string, name string, coordinates struct<latitude:double,longitud:double,longitude:double>, price struct<unit:struct<amount:double,currency:string>>,
rating struct<value:double,reviewCount:string>, images array<string>, {_LINES.replace(':', ' ', 1)}, room_type string, type string, is_superhost boolean"""


def items(payloads: DataFrame, path: str = "$", column: str = "payload") -> DataFrame:
    """payloads' other columns and item: the JSON text of each element of the array at path; no array, no rows."""
    found = F.get_json_object(column, path) if path != "$" else F.col(column)
    rest = [c for c in payloads.columns if c != column]
    return payloads.select(*rest, F.explode(F.from_json(found, "array<string>")).alias("item"))


def next_cursor(payload: Column) -> Column:
    return F.get_json_object(payload, CURSOR_PATH)


def _finish(rows: DataFrame, platform: str, fields: dict[str, Column], grid_cell_id: Column) -> DataFrame:
    """Listing columns of rows (item, p: the typed struct); fields may use p only."""
    lat, lng = F.coalesce(fields["latitude"], F.lit(0.0)), F.coalesce(fields["longitude"], F.lit(0.0))
    pid = F.coalesce(fields["platform_id"], F.lit(""))
    status = (
        F.when(F.json_object_keys("item").isNull(), "parse_error")
        .when(pid.isin("", "0") if platform == "airbnb" else pid == "", "missing_id")
        .when((lat == 0) & (lng == 0), "zero_coords")
        .otherwise("parsed")
    )
    given = fields | {
        "id": F.concat(F.lit(f"{platform}_"), pid), "platform": F.lit(platform), "platform_id": pid, "latitude": lat, "longitude": lng,
        "grid_cell_id": grid_cell_id, "raw_json": F.col("item"), "status": status,
    }
    return rows.select(*(given.get(c, F.lit(None)).alias(c) for c in LISTING))


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    return rows.withColumn("p", F.from_json("item", schema))


def parse_a(rows: DataFrame, country: str, grid_cell_id: Column | None = None, o: Options = Options()) -> DataFrame:
    """Listings of platform A from items."""
    p = lambda path: F.col(f"p.{path}")
    pid, page = p("basicPropertyData.id"), p("basicPropertyData.pageName")
    paid = F.get(p("blocks"), F.lit(0))["finalPrice"]
    currency = F.coalesce(paid["currency"], F.lit("EUR"))
    price, eur = to_eur(paid["amount"], currency, o.ron_per_eur)
    unit = p("matchingUnitConfigurations")
    common = F.coalesce(F.get_json_object(unit, "$[0].commonConfiguration"), F.get_json_object(unit, "$.commonConfiguration"))
    number = lambda key, kind: F.get_json_object(common, f"$.{key}").try_cast(kind)
    photo = p("basicPropertyData.photos.main.highResJpegUrl.relativeUrl")
    base = f"{SITE_A}/{country}"
    fields = {
        "platform_id": pid, "name": T.plain_text(F.coalesce(p("displayName.text"), F.lit(""))),
        "latitude": p("basicPropertyData.location.latitude"), "longitude": p("basicPropertyData.location.longitude"),
        "property_type": T.accommodation_type(p("basicPropertyData.accommodationTypeId")),
        "star_rating": p("basicPropertyData.starRating.value"),
        "review_score": p("basicPropertyData.reviews.totalScore"), "review_count": p("basicPropertyData.reviews.reviewsCount"),
        "price_per_night": price, "currency": eur, "price_original": paid["amount"],
        "currency_original": F.when(paid["amount"].isNotNull(), currency),
        "url": F.when(F.coalesce(page, F.lit("")) != "", F.concat(F.lit(f"{base}/"), page,
        F.lit(".html"))).otherwise(F.concat(F.lit(f"{base}/?hotel_id="), pid)),
        "thumbnail_url": F.concat(F.lit(PHOTO_HOST), T.none_if_empty(photo)), "bedrooms": number("nbBedrooms", "int"),
        "beds": number("nbAllBeds", "int"), "bathrooms": number("nbBathrooms", "double"),
    }
    return _finish(_typed(rows, _A), "booking", fields, grid_cell_id if grid_cell_id is not None else F.lit(""))


def _descriptions(details: Column) -> Column:
    empty = F.array().cast("array<string>")
    per = F.transform(F.coalesce(details, F.array().cast("array<struct<items:array<struct<description:string>>>>")),
        lambda d: F.coalesce(F.transform(d["items"], lambda i: F.coalesce(i["description"], F.lit(""))), empty))
    return F.flatten(per)


def _rooms(lines: Column) -> dict[str, Column]:
    r = T.room_counts(F.transform(lines, lambda e: F.coalesce(e["body"], F.lit(""))))
    return {c: r[c] for c in ("bedrooms", "beds", "bathrooms", "max_guests")}


def _room_url(pid: Column) -> Column:
    return F.concat(F.lit(f"{SITE_B}/"), pid)


def parse_b_raw(rows: DataFrame, grid_cell_id: Column | None = None) -> DataFrame:
    """Listings of platform B from raw search items; items of other types are left out."""
    p = lambda path: F.col(f"p.{path}")
    pid = T.decoded_id(p("demandStayListing.id"))
    rating = T.rating_parts(p("avgRatingLocalized"))
    line = p("structuredDisplayPrice.primaryLine")
    price = F.coalesce(T.nightly_price(_descriptions(p("structuredDisplayPrice.explanationData.priceDetails"))),
        T.digits_price(T.first_of(line["originalPrice"], line["price"])))
    fields = {
        "platform_id": pid, "name": T.plain_text(F.coalesce(p("demandStayListing.description.name.localizedStringWithTranslationPreference"), F.lit(""))),
        "latitude": p("demandStayListing.location.coordinate.latitude"), "longitude": p("demandStayListing.location.coordinate.longitude"),
        "review_score": rating["score"], "review_count": rating["count"], "price_per_night": price, "currency": F.lit("EUR"),
        "price_original": price, "currency_original": F.lit("EUR"),
        "url": _room_url(pid), "thumbnail_url": F.get(p("contextualPictures"), F.lit(0))["picture"],
    } | _rooms(p("structuredContent.mapPrimaryLine"))
    wanted = rows.where((F.get_json_object("item", "$.__typename") == RAW_ITEM_TYPE) | F.json_object_keys("item").isNull())
    return _finish(_typed(wanted, _RAW), "airbnb", fields, grid_cell_id if grid_cell_id is not None else F.lit(""))


def parse_b_map(rows: DataFrame, grid_cell_id: Column | None = None) -> DataFrame:
    """Listings of platform B from map search items."""
    p = lambda path: F.col(f"p.{path}")
    pid = p("listing.id")
    nightly, rate = T.nightly_price(_descriptions(p("structuredDisplayPrice.explanationData.priceDetails"))), p("pricingQuote.rate")
    currency = F.when(nightly.isNull(), F.coalesce(rate["currency"], F.lit("USD"))).otherwise("USD")
    price = F.coalesce(nightly, rate["amount"])
    fields = {
        "platform_id": pid, "name": T.plain_text(F.coalesce(p("listing.name"), F.lit(""))), "latitude": p("listing.coordinate.latitude"),
        "longitude": p("listing.coordinate.longitude"),
        "property_type": F.coalesce(p("listing.roomTypeCategory"), F.lit("")), "review_score": p("listing.avgRating"),
        "review_count": p("listing.reviewsCount"),
        "price_per_night": price, "currency": currency, "price_original": price, "currency_original": currency, "url": _room_url(pid),
        "thumbnail_url": F.get(p("listing.contextualPictures"), F.lit(0))["picture"],
        "is_superhost": F.coalesce(p("listing.isSuperhost"), F.lit(False)),
    } | _rooms(p("listing.structuredContent.mapPrimaryLine"))
    return _finish(_typed(rows, _MAP), "airbnb", fields, grid_cell_id if grid_cell_id is not None else F.lit(""))


def parse_b_library(rows: DataFrame, grid_cell_id: Column | None = None) -> DataFrame:
    """Listings of platform B from flat library items (longitude may be spelled ``longitud``)."""
    p = lambda path: F.col(f"p.{path}")
    pid = p("room_id")
    unit = p("price.unit")
    currency = F.coalesce(unit["currency"], F.lit("USD"))
    fields = {
        "platform_id": pid, "name": T.plain_text(F.coalesce(p("name"), F.lit(""))), "latitude": p("coordinates.latitude"),
        "longitude": F.coalesce(F.nullif(p("coordinates.longitud"), F.lit(0.0)), p("coordinates.longitude")),
        "property_type": T.first_of(p("room_type"), p("type")), "review_score": p("rating.value"),
        "review_count": p("rating.reviewCount").try_cast("int"),
        "price_per_night": unit["amount"], "currency": currency, "price_original": unit["amount"], "currency_original": currency,
        "url": _room_url(pid),
        "thumbnail_url": F.get(p("images"), F.lit(0)), "is_superhost": p("is_superhost"),
    } | _rooms(p("structuredContent.mapPrimaryLine"))
    return _finish(_typed(rows, _LIBRARY), "airbnb", fields, grid_cell_id if grid_cell_id is not None else F.lit(""))


def parse_detail(details: DataFrame, column: str = "detail") -> DataFrame:
    """details with bedrooms, beds, bathrooms, max_guests, is_superhost of a detail response."""
    d = F.from_json(column, "person_capacity int, is_super_host boolean, sub_description struct<items:array<string>>")
    rooms = T.room_counts(d["sub_description"]["items"])
    return details.select(
        "*", rooms["bedrooms"].alias("bedrooms"), rooms["beds"].alias("beds"), rooms["bathrooms"].alias("bathrooms"),
        F.coalesce(d["person_capacity"], rooms["max_guests"]).alias("max_guests"), d["is_super_host"].alias("is_superhost"),
    )


def parsed(rows: DataFrame) -> DataFrame:
    return rows.where("status = 'parsed'").drop("status")
