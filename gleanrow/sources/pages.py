"""Property pages: tiered prices, structured data and business disclosure from HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.geo import to_eur
from ..functions.jsonslice import json_at_key, object_after
from ..functions.options import Options

# Where pages keep things.
LD_TYPES = ("Hotel", "LodgingBusiness", "VacationRental", "Product", "Organization", "Corporation")
LD_BLOCK = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
META_PRICE = r'(?i)<meta\s+(?:property|name)="og:price:amount"\s+content="([^"]+)"'
META_CURRENCY = r'(?i)<meta\s+(?:property|name)="og:price:currency"\s+content="([^"]+)"'
JS_PRICE, JS_CURRENCY, JS_GUESTS = r'"price"\s*:\s*(\d+(?:\.\d+)?)', r'"currency"\s*:\s*"([A-Z]{3})"', r'"maxOccupancy"\s*:\s*(\d+)'
TRADER_CHARS, DISCLOSURE_BACK, DISCLOSURE_AHEAD = 20_000, 500, 4_000
DISCLOSURE_ANCHOR = "is solely responsible for offering this listing on Airbnb, and they host as a business"
HOST_CARD = r'"PassportCardData"[^}]*?"name"\s*:\s*"([^"\\]{1,80})"[^}]*?"userId"\s*:\s*"([^"\\]{1,120})"'
HOSTED_BY = r'"title"\s*:\s*"Hosted by ([^"\\]{1,80})"'
SUPERHOST = r'(?U)"superhostTitleText"\s*:\s*"([A-Z][\w \-\.]{0,60}?) is a Superhost"'
HOST_DETAILS = r'"hostDetails"\s*:\s*\[([^\]]{0,500})\]'
TENURE, JOINED = r'(?i)"title"\s*:\s*"(\d+\s*years?\s*(?:hosting|on\s+Airbnb))"', r'"joinedString"\s*:\s*"([^"\\]{1,80})"'
DISCLAIMER = r'"hostLegalDisclaimer"\s*:\s*"((?:[^"\\]|\\.){1,2000})"'
DISCLOSURE_LABELS = {
    "business_name": ("Business name",), "trade_register": ("Business registry",),
    "registration": ("Unique identification number", "Registration number"),
    "email": ("Email",), "phone": ("Phone",), "address": ("Address",),
}


def _first(items: Column, pick) -> Column:
    """The first non-null of pick(item)."""
    return F.try_element_at(F.array_compact(F.transform(items, pick)), F.lit(1))


def _text(item: Column, *keys: str) -> Column:
    return T.first_of(*(T.strip(F.get_json_object(item, f"$.{k}")) for k in keys))


def ld_items(html: Column) -> Column:
    """JSON texts of the structured-data items of a known type, in page order; broken blocks are skipped."""
    blocks = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LD_BLOCK), F.lit(1))
    lists = F.transform(blocks, lambda b: F.when(F.json_object_keys(b).isNotNull(),
        F.array(b)).otherwise(F.coalesce(F.from_json(b, "array<string>"), F.array().cast("array<string>"))))
    return F.filter(F.flatten(lists), lambda i: F.get_json_object(i, "$['@type']").isin(*LD_TYPES))


def _ld_offer(item: Column) -> Column:
    offer = F.coalesce(F.get_json_object(item, "$.offers[0]"), F.get_json_object(item, "$.offers"))
    spec = F.coalesce(F.get_json_object(offer, "$.priceSpecification"), offer)
    price = F.coalesce(F.get_json_object(spec, "$.price"), F.get_json_object(offer, "$.price")).try_cast("double")
    currency = F.coalesce(F.get_json_object(spec, "$.priceCurrency"), F.get_json_object(offer, "$.priceCurrency"), F.lit("EUR"))
    return F.when(price.isNotNull(), F.struct(price.alias("price"), currency.alias("currency")))


def ld_fields(items: Column) -> dict[str, Column]:
    named = lambda i: F.coalesce(_text(i, "legalName"), F.when(F.get_json_object(i, "$['@type']").isin("Organization", "Corporation"),
        _text(i, "name")))
    return {
        "offer": _first(items, _ld_offer),
        "max_guests": _first(items, lambda i: F.coalesce(F.get_json_object(i, "$.occupancy.value"),
        F.get_json_object(i, "$.occupancy.maxValue")).try_cast("int")),
        "bedrooms": _first(items, lambda i: F.get_json_object(i, "$.numberOfRooms").try_cast("int")),
        "business_name": _first(items, named), "vat": _first(items, lambda i: _text(i, "vatID", "taxID")),
        "email": _first(items, lambda i: _text(i, "email")), "phone": _first(items, lambda i: _text(i, "telephone")),
    }


def ld_address(address: Column) -> Column:
    """A structured address as one line; a plain text stays."""
    part = lambda k: F.get_json_object(address, f"$.{k}")
    country = F.coalesce(part("addressCountry.name"), part("addressCountry.identifier"), part("addressCountry"))
    joined = T.join_present([part("streetAddress"), part("addressLocality"), part("postalCode"), part("addressRegion"), country])
    return F.when(F.json_object_keys(address).isNotNull(), joined).otherwise(T.none_if_empty(T.strip(address)))


def _scanned_offer(html: Column, price: str, currency: str) -> Column:
    amount = T.extract(html, price).try_cast("double")
    return F.when(amount.isNotNull(), F.struct(amount.alias("price"),
        F.coalesce(T.extract(html, currency), F.lit("EUR")).alias("currency")))


def trader_fields(trader: Column) -> dict[str, Column]:
    """Business columns of a trader object; a declared non-trader has only a type."""
    c = lambda k: F.get_json_object(trader, f"$.contactDetails.{k}")
    private = F.get_json_object(trader, "$.isTrader") == "false"
    person = T.join_present([c("firstName"), c("middleName"), c("lastName")], " ")
    country = F.upper(T.none_if_empty(c("address.countryCode")))
    subject = F.get_json_object(trader, "$.regulatorySubjectType")
    kind = F.when(private, "Private").when(subject.isin("PRIVATE_INDIVIDUAL", "PRIVATE"), "Individual").otherwise("Professional")
    fields = {
        "business_name": T.first_of(T.strip(c("companyLegalName")), person),
        "registration": _text(trader, "contactDetails.registrationNumber"),
        "trade_register": _text(trader, "contactDetails.tradeRegisterName"), "email": _text(trader, "contactDetails.email"),
        "phone": _text(trader, "contactDetails.phoneNumber"),
        "address": T.join_present([c(f"address.{k}") for k in ("addressLine1", "addressLine2", "city", "postalCode", "state")] + [country]),
        "country": country,
    }
    known = trader.isNotNull() & ~F.coalesce(private, F.lit(False))
    return {k: F.when(known, v) for k, v in fields.items()} | {"business_type": F.when(trader.isNotNull(), kind)}


def parse_pages_a(pages: DataFrame, html: str = "html", o: Options = Options()) -> DataFrame:
    """pages with price, room and business columns of platform A's property pages.

    Prices: structured data, then meta tags, then scripts. Capacity is taken from scripts only where the price is.
    """
    h = F.col(html)
    rows = pages.withColumn("_items", ld_items(h)).withColumn("_trader", object_after(h, '"traderInfo"', TRADER_CHARS))
    ld, tr = ld_fields(F.col("_items")), trader_fields(F.col("_trader"))
    meta, script = _scanned_offer(h, META_PRICE, META_CURRENCY), _scanned_offer(h, JS_PRICE, JS_CURRENCY)
    rows = rows.withColumn("_ld", ld["offer"]).withColumn("_offer", F.coalesce("_ld", meta, script)).withColumn("_scripted",
        F.coalesce("_ld", meta).isNull())
    amount, currency = F.col("_offer.price"), F.col("_offer.currency")
    price, eur = to_eur(amount, currency, o.ron_per_eur)
    both = lambda k: F.coalesce(ld[k], tr[k])
    out = {
        "price_per_night": price, "currency": eur, "price_original": amount, "currency_original": currency, "bedrooms": ld["bedrooms"],
        "max_guests": F.coalesce(F.when(F.col("_scripted"), T.extract(h, JS_GUESTS).try_cast("int")), ld["max_guests"]),
        "business_name": both("business_name"), "registration": tr["registration"], "vat": ld["vat"], "email": both("email"),
        "phone": both("phone"),
        "address": tr["address"], "country": tr["country"], "trade_register": tr["trade_register"], "business_type": tr["business_type"],
    }
    return rows.select(*pages.columns, *(v.alias(k) for k, v in out.items()))


def unescaped(value: Column) -> Column:
    """A JSON string's content as text."""
    return F.get_json_object(F.concat(F.lit('{"v":"'), value, F.lit('"}')), "$.v")


def lines_of(html: Column) -> Column:
    """HTML text with a new line per list item or break and tags as spaces."""
    broken = F.regexp_replace(html, r"(?i)<\s*br\s*/?>|</\s*li\s*>", "\n")
    return T.strip(F.regexp_replace(F.regexp_replace(broken, "<[^>]+>", " "), "[ \t]+", " "))


def disclosure_text(html: Column) -> Column:
    """The professional host disclosure's HTML: from its opening quote before the anchor to the closing one after it."""
    at = F.instr(html, F.lit(DISCLOSURE_ANCHOR))
    low = F.greatest(F.lit(1), at - DISCLOSURE_BACK)
    before = F.substring(html, low, at - low)
    opened = F.regexp_extract(before, r'(?s).*"htmlText":"(.*)\z', 1)
    ahead = F.regexp_extract(F.substring(html, at, F.lit(DISCLOSURE_AHEAD)), r'(?s)\A((?:[^"\\]|\\.)*)"', 1)
    there = (at > 0) & before.contains('"htmlText":"') & (ahead != "")
    return F.when(there, F.concat(opened, ahead))


def disclosure_fields(block: Column) -> dict[str, Column]:
    text = lines_of(F.coalesce(unescaped(block), block))
    tidy = lambda x: T.none_if_empty(T.strip(F.regexp_replace(T.strip(x), r"[.,;:]+\z", "")))
    fields = {k: F.coalesce(*(tidy(T.extract(text, rf"(?iU){label}\s*:\s*([^\n]+)")) for label in labels)) for k,
        labels in DISCLOSURE_LABELS.items()}
    last = T.strip(F.substring_index(fields["address"], ",", -1))
    fields["country"] = F.when(F.length(last).between(2, 60) & last.rlike(r"\A\p{L}"), last)
    return fields


def host_fields(html: Column) -> dict[str, Column]:
    details = F.regexp_extract_all(T.extract(html, HOST_DETAILS), F.lit(r'"([^"\\]{1,120})"'), F.lit(1))
    rate = lambda d: F.lower(d).contains("response rate")
    pick = lambda test: T.strip(F.get(F.filter(details, test), F.lit(0)))
    return {
        "host_name": T.first_of(*(T.strip(T.extract(html, p)) for p in (HOST_CARD, HOSTED_BY, SUPERHOST))),
        "host_id": T.decoded_id(T.strip(T.extract(html, HOST_CARD, 2))),
        "host_response_rate": pick(rate), "host_response_time": pick(lambda d: F.lower(d).contains("respond") & ~rate(d)),
        "host_join_date": T.strip(F.coalesce(T.extract(html, TENURE), T.extract(html, JOINED))),
    }


def parse_pages_b(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with business and host columns of platform B's listing pages.

    The type is decided by the first of: disclosure, legal disclaimer, business details, the
    details item's screen or title, and at last that details are there but empty.
    """
    h = F.col(html)
    rows = pages.withColumn("_d", disclosure_text(h)).withColumn("_details", json_at_key(h, "businessDetails")).withColumn("_item",
        json_at_key(h, "businessDetailsItem"))
    d = disclosure_fields(F.col("_d"))
    rows = rows.withColumn("_f", F.struct(*(v.alias(k) for k, v in d.items())))
    of = lambda k: F.col(f"_f.{k}")
    disclaimers = F.transform(F.regexp_extract_all(h, F.lit(DISCLAIMER), F.lit(1)),
        lambda x: T.none_if_empty(T.strip(F.coalesce(unescaped(x), x))))
    disclaimer = F.substring(F.try_element_at(F.array_compact(disclaimers), F.lit(1)), 1, 500)
    detail = F.col("_details.json")
    said = T.first_of(*(T.strip(F.get_json_object(detail, f"$.{k}")) for k in ("detailsHtml", "title", "hostLegalDisclaimer")))
    details = F.substring(T.none_if_empty(T.strip(F.regexp_replace(F.regexp_replace(said, "<[^>]+>", " "), r"(?U)\s+", " "))), 1, 500)
    item = F.col("_item.json")
    screen, title = F.get_json_object(item, "$.action.screenId"), F.lower(F.coalesce(F.get_json_object(item, "$.title"), F.lit("")))
    yes = lambda c: F.coalesce(c, F.lit(False))
    disclosed = F.col("_d").isNotNull() & (of("business_name").isNotNull() | of("registration").isNotNull())
    kind = (
        F.when(disclosed | disclaimer.isNotNull() | details.isNotNull(), "Professional")
        .when(yes(screen == "PROFESSIONAL_HOST_DETAILS") | title.contains("offered by a business"), "Professional")
        .when(yes(screen == "INDIVIDUAL_HOST_PROMPT") | title.contains("offered by an individual"), "Individual")
        .when(yes(F.col("_item.kind") == "null") | (F.col("_item.kind").isNull() & h.contains('"businessDetails"')) | h.contains('"businessDetails":null'), "Individual")
    )
    name = F.when(disclosed, of("business_name")).otherwise(F.coalesce(disclaimer, details, of("business_name")))
    out = {"business_type": kind, "business_name": name} | {k: of(k) for k in ("registration", "trade_register", "email", "phone",
        "address", "country")} | host_fields(h)
    return rows.select(*pages.columns, *(v.alias(k) for k, v in out.items()))


def page_details_b(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with radius_m and amenities."""
    return pages.select(*pages.columns, T.map_radius(F.col(html)).alias("radius_m"), T.available_amenities(F.col(html)).alias("amenities"))


def title_and_lang(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with title (trimmed, null if there is none) and lang of the html element."""
    return pages.select(*pages.columns, T.strip(T.extract(F.col(html), r"(?s)<title>(.*?)</title>")).alias("title"),
        T.extract(F.col(html), r'<html[^>]*\blang="([^"]*)"').alias("lang"))
