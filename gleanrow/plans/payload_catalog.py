"""Queries of the payload and page parsers, over payloads that SQL shared by both engines builds from the tables.

The SQL of a query parses the same payload texts with the other engine's JSON and regex functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonslice
from ..functions import text as T
from ..functions.options import Options
from ..operators import report
from ..sources import disclosures, pages, payloads
from .views import duck_view, spark_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
O = Options()


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


ITEMS_A = """
select c_custkey k, concat('[{"displayName":{"text":"Flat — “', cast(c_custkey as {S}), '”…"},"blocks":[',
 case when c_custkey % 5 = 0 then '' else concat('{"finalPrice":{"amount":', cast(c_custkey % 400 + 20 as {S}), '.5,"currency":"', case when
  c_custkey % 2 = 0 then 'RON' else 'EUR' end, '"}}') end,
 '],"matchingUnitConfigurations":', case when c_custkey % 3 = 0 then '[' else '' end, '{"commonConfiguration":{"nbBedrooms":',
  cast(c_custkey % 4 as {S}), ',"nbBathrooms":', cast(c_custkey % 3 as {S}),
 ',"nbAllBeds":', cast(c_custkey % 5 as {S}), '}}', case when c_custkey % 3 = 0 then ']' else '' end, ',"basicPropertyData":{"id":', case
  when c_custkey % 17 = 0 then '""' else cast(c_custkey as {S}) end,
 ',"location":', case when c_custkey % 13 = 0 then '{}' else '{"latitude":44.4375,"longitude":26.125}' end, ',"starRating":{"value":',
  cast(c_custkey % 6 as {S}),
 '},"reviews":{"totalScore":8.5,"reviewsCount":', cast(c_custkey % 90 as {S}), '},"photos":{"main":{"highResJpegUrl":{"relativeUrl":"', case
  when c_custkey % 7 = 0 then '' else concat('/p', cast(c_custkey as {S}), '.jpg') end,
 '"}}},"pageName":"', case when c_custkey % 4 = 0 then '' else concat('page-', cast(c_custkey as {S})) end, '","accommodationTypeId":',
 cast(case c_custkey % 4 when 0 then 201 when 1 then 204 when 2 then 220 else 999 end as {S}), '}}, "no object"]') payload
from customer
"""

RAW_B = """
select c_custkey k, concat('{"data":{"presentation":{"staysSearch":{"results":{"searchResults":[{"__typename":"', case when c_custkey % 9 =
  0 then 'OtherResult' else 'StaySearchResult' end,
 '","avgRatingLocalized":"4,', cast(c_custkey % 90 + 10 as {S}), ' (', cast(c_custkey % 300 as {S}), ')","demandStayListing":{"id":"',
  base64(cast(concat('DemandStayListing:', cast(100000 + c_custkey as {S})) as {Y})),
 '","location":{"coordinate":{"latitude":44.5,"longitude":26.25}},"description":{"name":{"localizedStringWithTranslationPreference":"Flat’s `',
  cast(c_custkey as {S}), '"}}},"structuredDisplayPrice":{"explanationData":{"priceDetails":[{"items":[{"description":"',
 case when c_custkey % 3 = 0 then 'total' else concat(cast(2 + c_custkey % 5 as {S}), ' nights x € ', cast(50 + c_custkey % 200 as {S}),
  '.75') end, '"},{"description":"5 nights x € 9"}]}]},"primaryLine":{"price":"€ 1,', cast(100 + c_custkey % 800 as {S}), '"}},"structuredContent":{"mapPrimaryLine":[{"body":"',
 cast(1 + c_custkey % 4 as {S}), ' bedrooms"},{"body":"', cast(1 + c_custkey % 6 as {S}), ' beds"},{"body":"', case when c_custkey % 2 = 0
  then '1.5 baths' else 'Studio' end, '"}]},"contextualPictures":[{"picture":"u', cast(c_custkey as {S}), '"}]}],"paginationInfo":{"nextPageCursor":',
 case when c_custkey % 8 = 0 then 'null' else concat('"cur', cast(c_custkey as {S}), '"') end, '}}}}}}') payload
from customer
"""

MAP_B = """
select c_custkey k, concat('{"data":{"presentation":{"staysSearch":{"mapResults":{"mapSearchResults":[{"listing":{"id":"', case when
  c_custkey % 11 = 0 then '0' else cast(c_custkey as {S}) end, '","coordinate":{"latitude":44.5,"longitude":', case when c_custkey % 2 = 0
  then '26.5' else '-26.5' end,
 '},"name":"n', cast(c_custkey as {S}), '","roomTypeCategory":"entire_home","avgRating":4.5,"reviewsCount":', cast(c_custkey % 70 as {S}),
  case when c_custkey % 3 = 0 then ',"isSuperhost":true' else '' end, ',"structuredContent":{"mapPrimaryLine":[{"body":"', cast(c_custkey %
  9 as {S}), ' guests"}]}},"pricingQuote":{"rate":{"amount":',
 cast(c_custkey % 500 as {S}), case when c_custkey % 4 = 0 then '' else ',"currency":"EUR"' end, '}}}]}}}}}') payload
from customer
"""

LIBRARY_B = """
select c_custkey k, concat('[{"room_id":', cast(c_custkey as {S}), ',"name":"n…","coordinates":{"latitude":', case when c_custkey % 10 = 0
  then '0' else '44.5' end, case when c_custkey % 10 = 0 then '' when c_custkey % 2 = 0 then ',"longitud":26.5' else
  ',"longitud":0,"longitude":26.75' end,
 '},"price":{"unit":{"amount":', cast(c_custkey % 300 as {S}), '}},"rating":{"value":4.25,"reviewCount":"', cast(c_custkey % 40 as {S}),
  '"},"images":["i', cast(c_custkey as {S}), '"],"', case when c_custkey % 3 = 0 then 'room_type' else 'type' end, '":"private"}]') payload,
 concat('{"person_capacity":', case when c_custkey % 3 = 0 then 'null' else cast(1 + c_custkey % 8 as {S}) end, ',"is_super_host":', case
  when c_custkey % 2 = 0 then 'true' else 'false' end, ',"sub_description":{"items":["', cast(c_custkey % 7 + 1 as {S}), ' guests","',
  cast(c_custkey % 3 as {S}), ' bedrooms","', cast(c_custkey % 4 as {S}), ' beds","1 shared bath"]}}') detail
from customer
"""

TEXTS = """
select c_custkey k, concat('x "mapMarkerRadiusInMeters" : ', cast(c_custkey % 500 as {S}), case when c_custkey % 2 = 0 then '.25' else ''
  end, ', {"__typename":"AmenityItem","available":true,"title":" Wifi ', cast(c_custkey % 3 as {S}),
  '"},{"__typename":"AmenityItem","available":false,"title":"Pool"},{"__typename":"AmenityItem","available":true,"title":"Air Con"},{"__typename":"AmenityItem","available":true,"title":"air con"}') html,
 concat(cast(c_custkey % 4 as {S}), ' Bedrooms|', cast(c_custkey % 6 as {S}), ' beds|', cast(c_custkey % 3 as {S}), '.5 baths|',
  cast(c_custkey % 9 as {S}), ' guests', case when c_custkey % 5 = 0 then '|7 beds' else '' end) lines,
 case when c_custkey % 7 = 0 then 'New' else concat('4.', cast(c_custkey % 100 as {S}), ' (', cast(c_custkey % 900 as {S}), ' reviews)') end rating,
 concat('about ', cast(c_custkey % 9 as {S}), ' night x $ ', cast(c_custkey as {S}), '.5') price, concat('€ ', cast(c_custkey % 9 as {S}),
  ',', cast(100 + c_custkey % 899 as {S}), ' total') digits,
 case when c_custkey % 3 = 0 then concat('plain', cast(c_custkey as {S})) else base64(cast(concat('Listing:', cast(100 + c_custkey as {S}))
  as {Y})) end code, cast(200 + c_custkey % 30 as int) type_id, cast(c_custkey % 20 as int) ahead,
 case when c_custkey % 4 = 0 then null else concat(' Street ', cast(c_custkey as {S}), ' ') end street, case when c_custkey % 3 = 0 then ' '
  else 'Town' end town
from customer
"""

PAGES_A = """
select c_custkey k, case c_custkey % 5
 when 0 then concat('<script type="application/ld+json">{"@type":"Hotel","offers":[{"priceSpecification":{"price":"', cast(50 + c_custkey %
  300 as {S}), '","priceCurrency":"RON"}}],"occupancy":{"maxValue":', cast(c_custkey % 7 as {S}), '},"numberOfRooms":', cast(c_custkey % 5
  as {S}), ',"legalName":" Firm ', cast(c_custkey as {S}), ' ","vatID":"RO1","email":"a@b.c"}</script>')
 when 1 then concat('<script type="application/ld+json">{bad</script><meta property="og:price:amount" content="', cast(c_custkey as {S}), '.5"><meta name="og:price:currency" content="USD">')
 when 2 then concat('<b>{"price": ', cast(c_custkey as {S}), ', "currency": "EUR", "maxOccupancy": ', cast(c_custkey % 6 as {S}), '}</b>')
 when 3 then concat('<i>"traderInfo":{"isTrader":true,"contactDetails":{"companyLegalName":"', case when c_custkey % 2 = 0 then '' else
  concat('Firm } ', cast(c_custkey as {S})) end, '","firstName":"Ana","lastName":"Pop","registrationNumber":"J', cast(c_custkey as {S}), '","phoneNumber":"07","address":{"addressLine1":"S 1","city":"Town","countryCode":"ro"}}}</i>')
 else '<i>"traderInfo":{"isTrader":false}</i>' end html
from customer
"""

PAGES_B = """
select c_custkey k, concat(case c_custkey % 6
 when 0 then
  concat('{"htmlText":"Intro<br/>The host is solely responsible for offering this listing on Airbnb, and they host as a business.<br/>Business name: Firm ',
  cast(c_custkey as {S}), '.<br/>Registration number: J', cast(c_custkey as {S}), '</li><br />Address: Street 1, Town, Romania"}')
 when 1 then concat('"hostLegalDisclaimer":"Sold by ', chr(92), '"Firm', chr(92), '" ', cast(c_custkey as {S}), '"')
 when 2 then concat('"businessDetails":{"detailsHtml":"<p>Firm <b>', cast(c_custkey as {S}), '</b></p>"}')
 when 3 then '"businessDetailsItem":{"action":{"screenId":"INDIVIDUAL_HOST_PROMPT"},"title":"x"}'
 when 4 then '"businessDetails":null' else '"businessDetailsItem":{"title":"Offered by a Business"}' end,
 ' "PassportCardData" "name":"Host ', cast(c_custkey as {S}), '" "userId":"', cast(1000 + c_custkey as {S}),
  '" "hostDetails":["Response rate: ', cast(c_custkey % 101 as {S}), '%","Responds within an hour"] "title":"', cast(c_custkey % 9 + 1 as
  {S}), ' years hosting"') html
from customer
"""


def _items(view: str, path: str, column: str = "payload", other: str = "") -> str:
    """DuckDB: k, i (JSON) of the elements at a path."""
    source = f"json_extract({column}, '{path}')" if path != "$" else column
    return f"with v as ({duck_view(view)}), it as (select k, unnest(from_json({source}, '[\"json\"]')) i from v)"


def _text(path: str) -> str:
    return f"json_extract_string(i, '$.{path}')"


def _status(pid: str, lat: str, lng: str, none: str) -> str:
    return f"case when json_type(i) <> 'OBJECT' then 'parse_error' when coalesce({pid}, '') in ({none}) then 'missing_id' when coalesce({lat}, 0) = 0 and coalesce({lng}, 0) = 0 then 'zero_coords' else 'parsed' end status"


def _plain(value: str) -> str:
    for mark, plain in T.PLAIN_PUNCTUATION.items():
        value = f"replace({value}, '{mark}', '{plain.replace(chr(39), chr(39) * 2)}')"
    return value


_NUM = lambda path, kind="double": f"try_cast({_text(path)} as {kind})"
_AMOUNT, _CUR = _NUM("blocks[0].finalPrice.amount"), f"coalesce({_text('blocks[0].finalPrice.currency')}, 'EUR')"
_COMMON = "coalesce(json_extract(i, '$.matchingUnitConfigurations[0].commonConfiguration'), json_extract(i, '$.matchingUnitConfigurations.commonConfiguration'))"
_LAT_A, _LNG_A, _PID_A = _NUM("basicPropertyData.location.latitude"), _NUM("basicPropertyData.location.longitude"), _text("basicPropertyData.id")
_TYPE = " ".join(f"when {k} then '{v}'" for k, v in T.ACCOMMODATION_TYPES.items())


@query(
    _items(ITEMS_A, "$")
    + f""" select k, 'booking_' || coalesce({_PID_A}, '') id, {_plain(f"coalesce({_text('displayName.text')}, '')")} "name",
  coalesce({_LAT_A}, 0.0) latitude, coalesce({_LNG_A}, 0.0) longitude,
 case {_NUM('basicPropertyData.accommodationTypeId', 'int')} {_TYPE} else 'type_' || {_text('basicPropertyData.accommodationTypeId')} end
  property_type, {_NUM('basicPropertyData.starRating.value')} star_rating,
 {_NUM('basicPropertyData.reviews.totalScore')} review_score, {_NUM('basicPropertyData.reviews.reviewsCount', 'int')} review_count,
 case when {_CUR} = 'RON' and {_AMOUNT} is not null then round({_AMOUNT} / {O.ron_per_eur}, 2) else {_AMOUNT} end price_per_night, case when
  {_CUR} = 'RON' and {_AMOUNT} is not null then 'EUR' else {_CUR} end currency,
 {_AMOUNT} price_original, case when {_AMOUNT} is not null then {_CUR} end currency_original,
 '{payloads.SITE_A}/ro/' || case when coalesce({_text('basicPropertyData.pageName')}, '') <> '' then {_text('basicPropertyData.pageName')}
  || '.html' else '?hotel_id=' || {_PID_A} end url,
 '{payloads.PHOTO_HOST}' || nullif({_text('basicPropertyData.photos.main.highResJpegUrl.relativeUrl')}, '') thumbnail_url,
 try_cast(json_extract_string({_COMMON}, '$.nbBedrooms') as int) bedrooms, try_cast(json_extract_string({_COMMON}, '$.nbAllBeds') as int)
  beds, try_cast(json_extract_string({_COMMON}, '$.nbBathrooms') as double) bathrooms,
 {_status(_PID_A, _LAT_A, _LNG_A, "''")} from it"""
)
def q_parse_a(spark, sf_dir):
    """Platform A's document lists, with the status of every item."""
    rows = payloads.items(spark_view(spark, sf_dir, ITEMS_A))
    out = payloads.parse_a(rows.withColumn("cell", F.col("k").cast("string")), "ro", F.col("cell"))
    return out.select(
        F.col("grid_cell_id").cast("long").alias("k"), "id", "name", "latitude", "longitude", "property_type", "star_rating",
        "review_score", "review_count", "price_per_night", "currency", "price_original",
        "currency_original", "url", "thumbnail_url", "bedrooms", "beds", "bathrooms", "status",
    )


@query(_items(ITEMS_A, "$") + f", s as (select {_status(_PID_A, _LAT_A, _LNG_A, chr(39) * 2)} from it) select status, count(*) "
    f"n from s group by 1")
def q_parse_stats(spark, sf_dir):
    """How many items were parsed, and why others were not."""
    return report.parse_stats(payloads.parse_a(payloads.items(spark_view(spark, sf_dir, ITEMS_A)), "ro"))


_ROOM = lambda words, pattern, kind: f"try_cast(list_filter(list_transform({words}, lambda t: nullif(regexp_extract(lower(t), '{pattern}', 1), '')), lambda t: t is not null)[-1] as {kind})"
_BODIES = "json_extract_string(i, '$.structuredContent.mapPrimaryLine[*].body')"
_B_ID = "regexp_extract(decode(from_base64(" + _text("demandStayListing.id") + ")), '[0-9]{3,}')"
_DESCRIPTIONS = "json_extract_string(i, '$.structuredDisplayPrice.explanationData.priceDetails[*].items[*].description')"
_RATE = "nullif(regexp_extract({}, '([0-9]+)\\s*nights?\\s*[x×]\\s*[^0-9]*([0-9][0-9.,]*)', 2), '')"
_NIGHTLY = f"try_cast(replace(list_filter(list_transform({_DESCRIPTIONS}, lambda t: {_RATE.format('t')}), lambda t: t is not null)[1], ',', '.') as double)"
_DIGITS = "try_cast(nullif(regexp_replace({}, '[^0-9]', '', 'g'), '') as double)"


@query(
    _items(RAW_B, payloads.RAW_ITEMS_PATH)
    + f""" select 'airbnb_' || {_B_ID} id, {_plain(_text('demandStayListing.description.name.localizedStringWithTranslationPreference'))}
  "name", {_NUM('demandStayListing.location.coordinate.latitude')} latitude,
 cast(replace(split_part({_text('avgRatingLocalized')}, ' ', 1), ',', '.') as double) review_score,
  cast(regexp_extract(split_part({_text('avgRatingLocalized')}, ' ', 2), '[0-9]+') as int) review_count,
 coalesce({_NIGHTLY}, {_DIGITS.format(_text('structuredDisplayPrice.primaryLine.price'))}) price_per_night,
  {_ROOM(_BODIES, '([0-9]+[.]?[0-9]*)\\s*bedroom', 'int')} bedrooms,
 {_ROOM(_BODIES, '([0-9]+[.]?[0-9]*)\\s*beds', 'int')} beds, {_ROOM(_BODIES, '([0-9]+[.]?[0-9]*)\\s*bath', 'double')} bathrooms,
  {_text('contextualPictures[0].picture')} thumbnail_url, '{payloads.SITE_B}/' || {_B_ID} url
 from it where {_text('__typename')} = '{payloads.RAW_ITEM_TYPE}'"""
)
def q_parse_b_raw(spark, sf_dir):
    """Platform B's raw result lists."""
    rows = payloads.parse_b_raw(payloads.items(spark_view(spark, sf_dir, RAW_B), payloads.RAW_ITEMS_PATH))
    return payloads.parsed(rows).select("id", "name", "latitude", "review_score", "review_count", "price_per_night", "bedrooms", "beds",
        "bathrooms", "thumbnail_url", "url")


@query(f"with v as ({duck_view(RAW_B)}) select k, json_extract_string(payload, '{payloads.CURSOR_PATH}') next_cursor from v")
def q_next_cursor(spark, sf_dir):
    return spark_view(spark, sf_dir, RAW_B).select("k", payloads.next_cursor(F.col("payload")).alias("next_cursor"))


_GUESTS = "json_extract_string(i, '$.listing.structuredContent.mapPrimaryLine[*].body')"


@query(
    _items(MAP_B, payloads.MAP_ITEMS_PATH)
    + f""" select 'airbnb_' || {_text('listing.id')} id, {_text('listing.name')} "name", {_NUM('listing.coordinate.longitude')} longitude,
  {_text('listing.roomTypeCategory')} property_type, {_NUM('listing.avgRating')} review_score,
 {_NUM('listing.reviewsCount', 'int')} review_count, {_NUM('pricingQuote.rate.amount')} price_per_night,
  coalesce({_text('pricingQuote.rate.currency')}, 'USD') currency, coalesce(cast({_text('listing.isSuperhost')} as boolean), false) is_superhost,
 {_ROOM(_GUESTS, '([0-9]+)\\s*guest', 'int')} max_guests,
  {_status(_text('listing.id'), _NUM('listing.coordinate.latitude'), _NUM('listing.coordinate.longitude'), "'', '0'")} from it"""
)
def q_parse_b_map(spark, sf_dir):
    """Platform B's map lists."""
    rows = payloads.parse_b_map(payloads.items(spark_view(spark, sf_dir, MAP_B), payloads.MAP_ITEMS_PATH))
    return rows.select("id", "name", "longitude", "property_type", "review_score", "review_count", "price_per_night", "currency",
        "is_superhost", "max_guests", "status")


@query(
    _items(LIBRARY_B, "$")
    + f""" select 'airbnb_' || {_text('room_id')} id, {_plain(_text('name'))} "name", coalesce({_NUM('coordinates.latitude')}, 0.0)
  latitude, coalesce(nullif({_NUM('coordinates.longitud')}, 0), {_NUM('coordinates.longitude')}, 0.0) longitude,
 coalesce(nullif({_text('room_type')}, ''), nullif({_text('type')}, '')) property_type, {_NUM('rating.value')} review_score,
  {_NUM('rating.reviewCount', 'int')} review_count, {_NUM('price.unit.amount')} price_per_night, 'USD' currency,
 {_text('images[0]')} thumbnail_url,
  {_status(_text('room_id'), _NUM('coordinates.latitude'), f"coalesce(nullif({_NUM('coordinates.longitud')}, 0), {_NUM('coordinates.longitude')})", "'', '0'")}
  from it"""
)
def q_parse_b_library(spark, sf_dir):
    """Platform B's flat library lists."""
    rows = payloads.parse_b_library(payloads.items(spark_view(spark, sf_dir, LIBRARY_B).select("k", "payload")))
    return rows.select("id", "name", "latitude", "longitude", "property_type", "review_score", "review_count", "price_per_night",
        "currency", "thumbnail_url", "status")


_WORDS = "json_extract_string(i, '$.sub_description.items[*]')"


@query(
    f"with v as ({duck_view(LIBRARY_B)}), it as (select k, cast(detail as json) i from v)"
    + f""" select k, {_ROOM(_WORDS, '([0-9]+[.]?[0-9]*)\\s*bedroom', 'int')} bedrooms, {_ROOM(_WORDS, '([0-9]+[.]?[0-9]*)\\s*beds', 'int')}
  beds, {_ROOM(_WORDS, '([0-9]+[.]?[0-9]*)\\s*bath', 'double')} bathrooms,
 coalesce({_NUM('person_capacity', 'int')}, {_ROOM(_WORDS, '([0-9]+)\\s*guest', 'int')}) max_guests, cast({_text('is_super_host')} as
  boolean) is_superhost from it"""
)
def q_parse_detail(spark, sf_dir):
    """Detail responses."""
    return payloads.parse_detail(spark_view(spark, sf_dir, LIBRARY_B).select("k", "detail")).drop("detail")


_T = f"with v as ({duck_view(TEXTS)})"


@query(
    _T
    + """ select k, cast(regexp_extract(html, '"mapMarkerRadiusInMeters"\\s*:\\s*([0-9]+(?:[.][0-9]+)?)', 1) as double) radius_m,
 list_aggregate(list_sort(list_distinct(list_transform(regexp_extract_all(html,
  '"__typename":"AmenityItem","available":true,"title":"([^"]{1,80})"', 1), lambda t: lower(trim(t))))), 'string_agg', ',') amenities from v"""
)
def q_page_details(spark, sf_dir):
    """Map radius and available amenities of listing pages."""
    return pages.page_details_b(spark_view(spark, sf_dir, TEXTS).select("k", "html")).select("k", "radius_m",
        F.array_join("amenities", ",").alias("amenities"))


_LINES = "string_split(lines, '|')"


@query(
    _T
    + f""" select k, {_ROOM(_LINES, '([0-9]+[.]?[0-9]*)\\s*bedroom', 'int')} bedrooms, {_ROOM(_LINES, '([0-9]+[.]?[0-9]*)\\s*beds', 'int')}
  beds, {_ROOM(_LINES, '([0-9]+[.]?[0-9]*)\\s*bath', 'double')} bathrooms,
 {_ROOM(_LINES, '([0-9]+)\\s*guest', 'int')} max_guests from v"""
)
def q_room_counts(spark, sf_dir):
    """Rooms and capacity from text lines."""
    return spark_view(spark, sf_dir, TEXTS).select("k", T.room_counts(F.split("lines", r"\|")).alias("r")).select("k", "r.*")


@query(
    _T
    + f""" select k, try_cast(split_part(rating, ' ', 1) as double) score, try_cast(regexp_extract(split_part(rating, ' ', 2), '[0-9]+') as
  int) n, try_cast({_RATE.format('price')} as double) nightly, {_DIGITS.format('digits')} total from v"""
)
def q_rating_and_price(spark, sf_dir):
    """Ratings, nightly rates and totals from display texts."""
    rating = T.rating_parts(F.col("rating"))
    nightly, total = T.nightly_price(F.array("price")), T.digits_price(F.col("digits"))
    return spark_view(spark, sf_dir, TEXTS).select("k", rating["score"].alias("score"), rating["count"].alias("n"),
        nightly.alias("nightly"), total.alias("total"))


@query(
    _T
    + f""" select k, case when code like 'plain%' then code else regexp_extract(decode(from_base64(code)), '[0-9]{{3,}}') end decoded, case
  type_id {_TYPE} else 'type_' || type_id end kind,
 cast(cast('2026-05-01' as date) + ahead as varchar) checkin, cast(cast('2026-05-01' as date) + ahead + 3 as varchar) checkout,
 nullif(concat_ws(', ', nullif(trim(street), ''), nullif(trim(town), '')), '') address from v"""
)
def q_page_scalars(spark, sf_dir):
    """Encoded ids, accommodation types, stay dates and joined addresses."""
    rows = spark_view(spark, sf_dir, TEXTS)
    day = F.date_add(F.lit("2026-05-01").cast("date"), F.col("ahead"))
    start, end = T.stay_dates(day, 0, 3)
    joined = T.join_present([F.col("street"), F.col("town")])
    return rows.select("k", T.decoded_id(F.col("code")).alias("decoded"), T.accommodation_type(F.col("type_id")).alias("kind"),
        start.cast("string").alias("checkin"), end.cast("string").alias("checkout"), joined.alias("address"))


_LD = "case when json_valid(ld) then cast(ld as json) end"
_OFFER = "json_extract(j, '$.offers[0].priceSpecification')"


@query(
    f"""with v as ({duck_view(PAGES_A)}), x as (select k, html, nullif(regexp_extract(html,
  '<script type="application/ld[+]json">(.*?)</script>', 1), '') ld, nullif(regexp_extract(html, '"traderInfo":(.*)</i>', 1), '') tr from v),
 y as (select *, {_LD} j, cast(tr as json) t from x),
 z as (select *, try_cast(json_extract_string({_OFFER}, '$.price') as double) lp, try_cast(nullif(regexp_extract(html,
  'og:price:amount" content="([^"]+)"', 1), '') as double) mp, try_cast(nullif(regexp_extract(html, '"price"\\s*:\\s*([0-9.]+)', 1), '') as
  double) sp,
  json_extract_string(t, '$.isTrader') = 'false' private, json_extract(t, '$.contactDetails') c from y),
 q as (select *, coalesce(lp, mp, case when ld is null or j is null then sp end) amount, case when lp is not null then
  json_extract_string({_OFFER}, '$.priceCurrency') when mp is not null then regexp_extract(html, 'og:price:currency" content="([^"]+)"', 1)
  when sp is not null then regexp_extract(html, '"currency"\\s*:\\s*"([A-Z]{{3}})"', 1) end cur from z)
 select k, case when cur = 'RON' then round(amount / {O.ron_per_eur}, 2) else amount end price_per_night, case when cur = 'RON' then 'EUR'
  else cur end currency, amount price_original, try_cast(json_extract_string(j, '$.numberOfRooms') as int) bedrooms,
 coalesce(case when lp is null and mp is null then try_cast(nullif(regexp_extract(html, '"maxOccupancy"\\s*:\\s*([0-9]+)', 1), '') as int)
  end, try_cast(json_extract_string(j, '$.occupancy.maxValue') as int)) max_guests,
 coalesce(trim(json_extract_string(j, '$.legalName')), case when not private then coalesce(nullif(json_extract_string(c,
  '$.companyLegalName'), ''), concat_ws(' ', json_extract_string(c, '$.firstName'), json_extract_string(c, '$.lastName'))) end) business_name,
 case when not private then json_extract_string(c, '$.registrationNumber') end registration, json_extract_string(j, '$.vatID') vat,
  coalesce(json_extract_string(j, '$.email'), json_extract_string(c, '$.email')) email,
 case when not private then concat_ws(', ', json_extract_string(c, '$.address.addressLine1'), json_extract_string(c, '$.address.city'),
  upper(json_extract_string(c, '$.address.countryCode'))) end address,
 case when t is null then null when private then 'Private' else 'Professional' end business_type from q"""
)
def q_pages_a(spark, sf_dir):
    """Platform A's property pages: structured data, meta and script prices, trader information."""
    out = pages.parse_pages_a(spark_view(spark, sf_dir, PAGES_A))
    return out.select("k", "price_per_night", "currency", "price_original", "bedrooms", "max_guests", "business_name", "registration",
        "vat", "email", "address", "business_type")


@query(
    f"""with v as ({duck_view(PAGES_B)}), x as (select k, html, k % 6 m, regexp_extract(html, '"businessDetails":(\\{{.*?\\}})', 1) details
  from v)
 select k, case when m in (0, 1, 2, 5) then 'Professional' else 'Individual' end business_type,
 case m when 0 then regexp_extract(html, 'Business name: ([^.<]*)', 1) when 1 then replace(regexp_extract(html,
  '"hostLegalDisclaimer":"((?:[^"\\\\]|\\\\.)+)"', 1), '\\"', '"')
  when 2 then trim(regexp_replace(regexp_replace(json_extract_string(details, '$.detailsHtml'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) end business_name,
 nullif(regexp_extract(html, 'Registration number: ([^<]*)', 1), '') registration, nullif(regexp_extract(html, 'Address: ([^"]*)', 1), '')
  address, case when m = 0 then 'Romania' end country,
 regexp_extract(html, '"name":"([^"]*)"', 1) host_name, regexp_extract(html, '"userId":"([^"]*)"', 1) host_id, regexp_extract(html,
  '"(Response rate[^"]*)"', 1) host_response_rate, regexp_extract(html, '"(Responds[^"]*)"', 1) host_response_time,
 regexp_extract(html, '"title":"([0-9]+ years hosting)"', 1) host_join_date from x"""
)
def q_pages_b(spark, sf_dir):
    """Platform B's listing pages: disclosure, disclaimer, business details, host card."""
    out = pages.parse_pages_b(spark_view(spark, sf_dir, PAGES_B))
    return out.select("k", "business_type", "business_name", "registration", "address", "country", "host_name", "host_id",
        "host_response_rate", "host_response_time", "host_join_date")


@query(
    f"""with v as ({duck_view(PAGES_A)}), x as (select k, nullif(regexp_extract(html, '"traderInfo":(.*)</i>', 1), '') slice from v), w as
  (select k, nullif(regexp_extract(html, '"contactDetails":(.*)\\}}</i>', 1), '') value from v)
 select k, md5(slice) slice_md5, case when value is not null then 'object' end kind, md5(value) value_md5 from x join w using (k)"""
)
def q_json_slices(spark, sf_dir):
    """JSON objects cut out of page source: after a needle, and at a key."""
    rows = spark_view(spark, sf_dir, PAGES_A)
    cut, value = jsonslice.object_after(F.col("html"), '"traderInfo"', pages.TRADER_CHARS), jsonslice.json_at_key(F.col("html"),
        "contactDetails")
    found = rows.select("k", cut.alias("slice"), value.alias("v"))
    return found.select("k", F.md5("slice").alias("slice_md5"), F.col("v.kind").alias("kind"), F.md5("v.json").alias("value_md5"))


DIALOGS = """
select c_custkey k, case c_custkey % 4
 when 0 then concat('<dl><dt>Business name</dt><dd>Firm ', cast(c_custkey as {S}), ' SRL.</dd><dt>Phone number: 0721 ', cast(100000 + c_custkey as {S}),
  '</dt><p>CUI</p><p>RO ', cast(c_custkey as {S}), '</p><p>Adresa: Strada ', cast(c_custkey as {S}), '</p></dl>')
 when 1 then concat('<p>An individual host</p><p>write to h', cast(c_custkey as {S}), '@b.ro.</p>')
 when 2 then '<p>hello</p>' else '' end dialog,
 concat('<h1>x</h1>', case when c_custkey % 3 = 0 then '' else '<h2>Legal information</h2>' end, '<p>Company name: Firm ', cast(c_custkey as {S}), '.</p><div>VAT ID: RO 12 ',
  cast(10000 + c_custkey as {S}), '</div><li>J 40 / ', cast(c_custkey as {S}), ' / 2020</li><p>Mail x', cast(c_custkey as {S}), '@y.ro</p><p>Business address: Strada ',
  cast(c_custkey as {S}), ', Town</p>') html,
 case c_custkey % 3 when 0 then concat('{"streetAddress":" S ', cast(c_custkey as {S}), ' ","addressLocality":"Town","postalCode":"","addressCountry":{"name":"Land"}}')
  when 1 then concat(' Street ', cast(c_custkey as {S}), ' ') else '{"addressCountry":"RO"}' end address
from customer
"""
_D = f"with v as ({duck_view(DIALOGS)})"


@query(
    _D
    + """ select k, nullif(regexp_extract(dialog, '<dd>(.*?)[.]</dd>', 1), '') business_name, nullif(regexp_extract(dialog, 'Phone number: ([0-9 ]+)', 1), '') phone,
 nullif(regexp_extract(dialog, '<p>CUI</p><p>([^<]*)', 1), '') vat, nullif(regexp_extract(dialog, 'Adresa: ([^<]*)', 1), '') address, nullif(regexp_extract(dialog, 'write to ([^<]*)[.]<', 1), '') email,
 case k % 4 when 0 then 'Professional' when 1 then 'Individual' when 2 then 'Unknown' end business_type from v"""
)
def q_dialogs(spark, sf_dir):
    """Labelled dialogs: values beside or under their labels."""
    fields = disclosures.dialog_fields(F.col("dialog"))
    rows = spark_view(spark, sf_dir, DIALOGS)
    return rows.select("k", *(fields[c].alias(c) for c in ("business_name", "phone", "vat", "address", "email", "business_type")))


#: Dialogs with marks around values, two labels in a line, and values that are only punctuation.
MARKED = """
select s_suppkey k, case s_suppkey % 5
 when 0 then concat('<dl><dt>Phone</dt><dd>: 0712 ', cast(100000 + s_suppkey as {S}), '</dd></dl>')
 when 1 then concat('<p>Business name</p><li>\u2022 Firm ', cast(s_suppkey as {S}), '</li>')
 when 2 then concat('<p>Phone (contact phone) = 0733 ', cast(100000 + s_suppkey as {S}), '</p>')
 when 3 then concat('<p>Phone number: .</p><p>Telephone \u2014 0799 ', cast(100000 + s_suppkey as {S}), ';</p>')
 else concat('<p>- VAT: - </p><p>\u2022 RO ', cast(s_suppkey as {S}), ' -</p>') end dialog
from supplier
"""


@query(
    f"with v as ({duck_view(MARKED)})"
    + """ select k, case k % 5 when 1 then regexp_extract(dialog, 'Firm [0-9]+') end business_name,
 case k % 5 when 0 then regexp_extract(dialog, '0712 [0-9]+') when 2 then ') = ' || regexp_extract(dialog, '0733 [0-9]+') when 3 then regexp_extract(dialog, '0799 [0-9]+')
 end phone, case k % 5 when 4 then regexp_extract(dialog, 'RO [0-9]+') end vat from v"""
)
def q_dialog_marks(spark, sf_dir):
    """Dialogs whose values stand between marks, or after the longer of two labels."""
    fields = disclosures.dialog_fields(F.col("dialog"))
    return spark_view(spark, sf_dir, MARKED).select("k", *(fields[c].alias(c) for c in ("business_name", "phone", "vat")))


@query(
    _D
    + """, h as (select k, html, html like '%Legal%' there from v)
 select k, case when there then regexp_extract(html, 'Company name: ([^.<]*)', 1) end business_name, case when there then replace(regexp_extract(html, 'VAT ID: ([^<]*)', 1), ' ', '') end vat,
 case when there then replace(regexp_extract(html, '<li>([^<]*)', 1), ' ', '') end registration, case when there then regexp_extract(html, 'Mail ([^<]*)', 1) end email,
 case when there then regexp_extract(html, 'Business address: ([^<]*)', 1) end address, case when there then 'Professional' end business_type from h"""
)
def q_legal_blocks(spark, sf_dir):
    """Legal blocks of pages."""
    fields = disclosures.legal_fields(F.col("html"))
    rows = spark_view(spark, sf_dir, DIALOGS)
    return rows.select("k", *(fields[c].alias(c) for c in ("business_name", "vat", "registration", "email", "address", "business_type")))


@query(_D + " select k, case k % 3 when 0 then 'S ' || k || ', Town, Land' when 1 then 'Street ' || k else 'RO' end address from v")
def q_ld_address(spark, sf_dir):
    """Structured addresses as one line."""
    return spark_view(spark, sf_dir, DIALOGS).select("k", pages.ld_address(F.col("address")).alias("address"))
