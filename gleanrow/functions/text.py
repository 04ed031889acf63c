"""String, regex and JSON scalars as Column builders.

Patterns are Unicode-aware as in most regex dialects outside the JVM: (?U) makes \\d, \\s,
\\w and \\b follow Unicode, and case is ignored with (?iu).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation and its plain form.
PLAIN_PUNCTUATION = {
    "—": "-", "–": "-", "‘": "'", "’": "'",
    "“": '"', "”": '"', "…": "...", "`": "'",
}

# Accommodation type ids of platform A.
ACCOMMODATION_TYPES = {
    201: "apartment", 202: "guest_house", 203: "hostel", 204: "hotel",
    205: "motel", 206: "resort", 208: "bed_and_breakfast", 209: "homestay",
    213: "inn", 218: "villa", 219: "chalet", 220: "holiday_home",
    222: "campsite", 223: "boat", 224: "capsule_hotel", 225: "luxury_tent",
    226: "lodge", 228: "farm_stay",
}

# What makes an address one of a street, and where its street part ends.
STREET_LEVEL = r"(?iU)^\d+\s|strada|str\.|calea|bulevardul|bd\.|soseaua|sos\.|aleea|bloc|apartament|ap\."
ADDRESS_NOISE = (
    r"(?iU)\b(?:bloc|bl|sc\d+|bl\d+|scara|sc|etaj|et|apartament|apart|ap|corp|floor|"
    r"apartment|room|parter|casa|cladirea|cladire|building|demisol|subsol|mansarda)\b"
)
NUMBER_RANGE = r"(?U)(\d+)\s*[-\x{2013}]\s*\d+"
NUMBER_PREFIX = r"(?iU)\s*,?\s*\bnr\b\.?\s*"
TRAILING_CODE = r"(?iU),\s*(?:[a-z]{1,3}\s*\d+|\d+\s*[a-z])\s*$"
ADDRESS_PATHS = ("$.basicPropertyData.location", "$.location")


def strip(value: Column, chars: str = r"\s") -> Column:
    """value without the given class of characters at both ends."""
    return F.regexp_replace(value, rf"(?U)\A[{chars}]+|[{chars}]+\z", "")


def none_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def extract(value: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null where there is none."""
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, group))


def first_of(*found: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(none_if_empty(x) for x in found))


# -- identity keys ------------------------------------------------------------------------


def normalize_registration(value: Column) -> Column:
    """[a-z0-9] of the lower-cased value, without a leading ``ro``; null if nothing is left."""
    plain = F.regexp_replace(F.lower(value), "[^a-z0-9]", "")
    return none_if_empty(F.regexp_replace(plain, r"\Aro", ""))


def normalize_phone(value: Column) -> Column:
    """The last 9 digits; a trunk or country prefix goes if 9 digits follow it; fewer: null."""
    digits = F.regexp_replace(value, r"(?U)\D", "")
    national = F.regexp_replace(digits, r"(?U)\A(?:0040(?=\d{9})|40(?=\d{9})|0(?=\d{9}))", "")
    return F.when(F.length(national) >= 9, F.right(national, F.lit(9)))


def normalize_email(value: Column) -> Column:
    plain = F.lower(strip(value))
    return F.when(plain.rlike(r"(?U)\A[^@\s]+@[^@\s]+\.[^@\s]+\z"), plain)


def identity_keys(registration: Column, phone: Column, email: Column, namespaced: bool = False) -> Column:
    """Distinct identity keys of a row. Not namespaced, a registration may equal a phone, as in the source data's rules."""
    kinds = (("reg", normalize_registration(registration)), ("tel", normalize_phone(phone)), ("mail", normalize_email(email)))
    keys = [F.concat(F.lit(f"{k}:"), x) if namespaced else x for k, x in kinds]
    return F.array_compact(F.array_distinct(F.array(*keys)))


def stable_id(prefix: str, sorted_parts: Column) -> Column:
    """prefix and 16 hex digits of the md5 of the parts, joined by a pipe."""
    return F.concat(F.lit(prefix), F.substring(F.md5(F.array_join(sorted_parts, "|")), 1, 16))


# -- names, addresses ---------------------------------------------------------------------


def plain_text(value: Column) -> Column:
    out = value
    for mark, plain in PLAIN_PUNCTUATION.items():
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return out


def clean_street(address: Column) -> Column:
    """Ranges to their first number, ``nr`` and trailing codes gone, cut at the first building detail."""
    one = F.regexp_replace(address, NUMBER_RANGE, "$1")
    bare = F.regexp_replace(one, NUMBER_PREFIX, " ")
    street = F.split(bare, ADDRESS_NOISE, 2)[0]
    return strip(F.regexp_replace(street, TRAILING_CODE, ""), " ,.")


def payload_address(raw_json: Column) -> Column:
    """``street number, city`` of a payload; null on bad JSON or without a street."""
    nested, top = (F.get_json_object(raw_json, p) for p in ADDRESS_PATHS)
    whole = F.when(nested.isNotNull() & ~nested.isin("{}", "null", '""'), nested).otherwise(top)
    address = clean_street(strip(F.coalesce(F.get_json_object(whole, "$.address"), F.lit(""))))
    city = strip(F.coalesce(F.get_json_object(whole, "$.city"), F.lit("")))
    return F.when(address != "", F.when(city != "", F.concat(address, F.lit(", "), city)).otherwise(address))


def is_street_level(address: Column) -> Column:
    return F.coalesce((address != "") & address.rlike(STREET_LEVEL), F.lit(False))


def address_key(address: Column) -> Column:
    return F.lower(F.regexp_replace(strip(address), r"(?U)\s+", " "))


# -- page and payload scalars -------------------------------------------------------------


def map_radius(html: Column) -> Column:
    return extract(html, r'"mapMarkerRadiusInMeters"\s*:\s*([0-9]+(?:\.[0-9]+)?)').try_cast("double")


def available_amenities(html: Column) -> Column:
    """Sorted, distinct, lower-case titles of the amenities that are available; empty if none."""
    titles = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'"__typename":"AmenityItem","available":true,"title":"([^"]{1,80})"'),
        F.lit(1))
    plain = F.transform(titles, lambda t: F.lower(strip(t)))
    return F.array_sort(F.array_distinct(F.filter(plain, lambda t: t != "")))


def _number(text: Column, kind: str) -> Column:
    return text.try_cast("double").cast(kind)


def room_counts(lines: Column) -> Column:
    """struct<bedrooms, beds, bathrooms, max_guests> of text lines; the last line that names a count decides."""
    low = F.transform(F.coalesce(lines, F.array().cast("array<string>")), lambda t: F.lower(strip(t)))

    def last(pattern: str, kind: str) -> Column:
        return F.try_element_at(F.array_compact(F.transform(low, lambda t: _number(extract(t, pattern), kind))), F.lit(-1))

    bedrooms = last(r"(?U)(\d+\.?\d*)\s*bedroom", "int")
    studio = F.exists(low, lambda t: t.contains("studio"))
    return F.struct(
        F.coalesce(bedrooms, F.when(studio, F.lit(0))).alias("bedrooms"),
        last(r"(?U)(\d+\.?\d*)\s*bed(?!room)", "int").alias("beds"),
        last(r"(?U)(\d+\.?\d*)\s*bath", "double").alias("bathrooms"),
        last(r"(?U)(\d+)\s*guest", "int").alias("max_guests"),
    )


def rating_parts(text: Column) -> Column:
    """struct<score double, count int> of ``4.85 (120)``; a decimal comma will do."""
    head, tail = F.split(text, " ", 2)[0], F.get(F.split(text, " ", 2), F.lit(1))
    return F.struct(F.replace(head, F.lit(","), F.lit(".")).try_cast("double").alias("score"),
        extract(tail, r"(?U)\d+", 0).try_cast("int").alias("count"))


def nightly_price(descriptions: Column) -> Column:
    """The rate of the first ``N nights x P`` among descriptions."""
    pattern = r"(?U)(\d+)\s*nights?\s*[x\x{D7}]\s*[^\d]*(\d[\d.,]*)"
    rates = F.filter(F.transform(descriptions, lambda d: extract(d, pattern, 2)), lambda x: x.isNotNull())
    return F.replace(F.get(rates, F.lit(0)), F.lit(","), F.lit(".")).try_cast("double")


def digits_price(text: Column) -> Column:
    """All digits of a price text as one number."""
    return none_if_empty(F.regexp_replace(F.replace(text, F.lit(","), F.lit("")), r"(?U)\D", "")).try_cast("double")


def decoded_id(value: Column) -> Column:
    """The first run of 3 digits or more in the base64-decoded value, else the value."""
    decoded = F.try_to_binary(_padded(F.regexp_replace(value, "=+$", "")), F.lit("base64"))
    return F.coalesce(extract(F.make_valid_utf8(decoded.cast("string")), r"\d{3,}", 0), value)


def _padded(value: Column) -> Column:
    return F.concat(value, F.repeat(F.lit("="), (4 - F.length(value) % 4) % 4))


def accommodation_type(type_id: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in ACCOMMODATION_TYPES.items() for x in pair))
    return F.coalesce(F.try_element_at(known, type_id.cast("int")), F.concat(F.lit("type_"), type_id.cast("string")))


def stay_dates(today: Column, checkin_days: int, checkout_days: int) -> tuple[Column, Column]:
    return F.date_add(today, checkin_days), F.date_add(today, checkout_days)


def html_escape(value: Column) -> Column:
    out = F.coalesce(value, F.lit(""))
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def json_path(value: Column, path: str, default: str | None = None) -> Column:
    """What a dotted path leads to; the default where a step is missing or null."""
    found = F.get_json_object(value, "$." + path)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def join_present(parts: Sequence[Column], by: str = ", ") -> Column:
    """The parts that are neither null nor blank, stripped and joined; null if there are none."""
    some = F.array_compact(F.array(*(none_if_empty(strip(p)) for p in parts)))
    return F.when(F.size(some) > 0, F.array_join(some, by))
