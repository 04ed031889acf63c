"""Distances, local projection and position precision as Column builders."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T
from .options import Options

# The sphere, and the local projection's anchor and scale.
EARTH_RADIUS_M = 6_371_000.0
ANCHOR_LAT, ANCHOR_LNG = 44.4325, 26.1000
METRES_PER_DEGREE = 111_320.0
METRES_PER_DEGREE_LNG = METRES_PER_DEGREE * math.cos(math.radians(ANCHOR_LAT))


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres along a great circle."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.sin(dp / 2) * F.sin(dp / 2) + F.cos(p1) * F.cos(p2) * F.sin(dl / 2) * F.sin(dl / 2)
    return 2 * EARTH_RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def to_local(lat: Column, lng: Column) -> tuple[Column, Column]:
    """(x, y) in metres around the anchor."""
    return (lng - ANCHOR_LNG) * METRES_PER_DEGREE_LNG, (lat - ANCHOR_LAT) * METRES_PER_DEGREE


def to_geo(x: Column, y: Column) -> tuple[Column, Column]:
    """(lat, lng) of local metres."""
    return ANCHOR_LAT + y / METRES_PER_DEGREE, ANCHOR_LNG + x / METRES_PER_DEGREE_LNG


def position_confidence(sigma: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (150.0 - sigma) / 150.0))


def scraped_sigma(platform: Column, address: Column, radius: Column, stack_count: Column, o: Options = Options()) -> Column:
    """Standard error in metres of a landed coordinate."""
    street = F.when(T.is_street_level(address) & (stack_count < o.stack_min), o.sigma_address).otherwise(o.sigma_vague)
    pin = F.when(radius.isNull(), o.sigma_fuzzed).when(radius == 0,
        o.sigma_exact).otherwise(F.greatest(F.lit(o.sigma_fuzzed), radius.cast("double") * 0.7))
    return F.when(platform == "booking", street).otherwise(pin).cast("double")


def platform_precision(platform: Column, address: Column, radius: Column) -> Column:
    """The platform's own word: exact or approximate, null if it says nothing."""
    own = F.when(T.is_street_level(address), "exact").otherwise("approximate")
    return F.when(platform == "booking", own).otherwise(F.when(radius == 0, "exact").when(radius.isNotNull(), "approximate"))


def zoom_level(span_degrees: Column) -> Column:
    zoom = F.bround(F.log2(360.0 / F.nullif(span_degrees, F.lit(0.0)))).cast("int")
    return F.when(span_degrees > 0, F.greatest(F.lit(1), F.least(F.lit(20), zoom))).otherwise(15)


def to_eur(price: Column, currency: Column, ron_per_eur: float) -> tuple[Column, Column]:
    """(price, currency) with RON turned into EUR."""
    ron = (currency == "RON") & price.isNotNull()
    return F.when(ron, F.round(price / ron_per_eur, 2)).otherwise(price), F.when(ron, "EUR").otherwise(currency)


def block(coordinate: Column) -> Column:
    """Number of the 0.001 degree cell around a coordinate."""
    return F.round(F.bround(coordinate, 3) * 1000).cast("long")
