"""Filters, counts and summaries over listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_rooms(platform: str) -> Column:
    """Some room field is unknown."""
    return (F.col("platform") == platform) & (F.col("bedrooms").isNull() | F.col("beds").isNull() | F.col("bathrooms").isNull())


def missing_all_rooms() -> Column:
    """The enricher's narrower test: beds, bathrooms and capacity are all unknown."""
    return F.col("beds").isNull() & F.col("bathrooms").isNull() & F.col("max_guests").isNull()


def missing_price(platform: str) -> Column:
    return (F.col("platform") == platform) & F.col("price_per_night").isNull()


def missing_business(platform: str, with_host_stats: bool = True) -> Column:
    """No type yet; a professional of platform A without register; with_host_stats: or platform B without host figures."""
    unknown = F.coalesce(F.col("business_type"), F.lit("Unknown")) == "Unknown"
    unregistered = (F.col("platform") == "booking") & (F.col("business_type") == "Professional") & F.col("trade_register").isNull()
    out = unknown | F.coalesce(unregistered, F.lit(False))
    if with_host_stats:
        out = out | ((F.col("platform") == "airbnb") & (F.col("host_response_rate").isNull() | F.col("host_join_date").isNull()))
    return (F.col("platform") == platform) & out


def missing_page_details() -> Column:
    return (F.col("platform") == "airbnb") & F.col("url").isNotNull() & (F.col("radius_m").isNull() | F.col("amenities_json").isNull())


def queue(listings: DataFrame, condition: Column, limit: int | None = None) -> DataFrame:
    """The rows to work on; with a limit, the first by id."""
    out = listings.where(condition)
    return out if limit is None else out.orderBy("id").limit(limit)


def counts(listings: DataFrame) -> DataFrame:
    """Per platform, in one pass: listings, without price, without business data."""
    grouped = listings.groupBy("platform")
    either = lambda test: test("booking") | test("airbnb")
    return grouped.agg(F.count("*").alias("listings"), F.count_if(either(missing_price)).alias("missing_price"),
        F.count_if(either(lambda p: missing_business(p, False))).alias("missing_business"))


def missing_share(listings: DataFrame, column: str) -> float:
    """Percent of rows without column: the scalar that stops enrichment passes below 5."""
    r = listings.agg(F.count("*").alias("n"), F.count_if(F.col(column).isNull()).alias("k")).first()
    return 100.0 * r["k"] / r["n"] if r["n"] else 0.0


def missing_shares(listings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, missing (percent of rows without it) of all columns: one aggregation, nothing on the driver."""
    share = lambda c: F.coalesce(F.try_divide(100.0 * F.count_if(F.col(c).isNull()), F.count("*")), F.lit(0.0))
    shares = F.array(*(F.struct(F.lit(c).alias("field"), share(c).alias("missing")) for c in columns))
    return listings.agg(F.explode(shares).alias("x")).select("x.*")


def progress_summary(progress: DataFrame) -> DataFrame:
    return progress.groupBy("platform", "status").agg(F.count("*").alias("cells"),
        F.coalesce(F.sum("result_count"), F.lit(0)).cast("long").alias("results"))


def cells_by_status(progress: DataFrame, platform: str, status: str) -> DataFrame:
    return progress.where((F.col("platform") == platform) & (F.col("status") == status)).select("cell_id")


def cells_with_listings(cells: DataFrame, listings: DataFrame) -> DataFrame:
    """cells (cell_id, platform) that have a listing."""
    found = listings.select(F.col("grid_cell_id").alias("cell_id"), "platform")
    return cells.join(found, ["cell_id", "platform"], "left_semi")


def distinct_cells(listings: DataFrame) -> DataFrame:
    return listings.where("grid_cell_id is not null and grid_cell_id != ''").select("grid_cell_id").distinct()


def sample_cells(cells: DataFrame, share: float, seed: int) -> DataFrame:
    """An exact share of the cells (at least one), the same for a seed on any engine: those with the least md5."""
    k = max(1, int(cells.count() * share))
    return cells.orderBy(F.md5(F.concat("cell_id", F.lit(f"|{seed}"))), "cell_id").limit(k)


def parse_stats(parsed: DataFrame) -> DataFrame:
    """Rows per parse status."""
    return parsed.groupBy("status").agg(F.count("*").alias("n"))


def stack_counts(listings: DataFrame) -> DataFrame:
    """listings with stack_count: how many rows of any platform share the 6-decimal coordinate.

    Counted with map-side combining and joined back, so a crowded coordinate is not one task's window.
    """
    at = [F.bround("latitude", 6).alias("_lat"), F.bround("longitude", 6).alias("_lng")]
    sizes = listings.groupBy(*at).agg(F.count("*").alias("stack_count"))
    return listings.select("*", *at).join(sizes.hint("merge"), ["_lat", "_lng"]).drop("_lat", "_lng")


def operator_summary(listings: DataFrame) -> DataFrame:
    """One row per operator: key, name, registration, register, platforms, listing and professional counts.

    listings: operator_id, registration, business_name, host_id, host_name, trade_register, platform, business_type.
    """
    key = F.coalesce("operator_id", "registration", "business_name", "host_id")
    rows = listings.withColumn("operator_key", key).where("operator_key is not null")
    return rows.groupBy("operator_key").agg(
        F.coalesce(F.max("business_name"), F.max("host_name")).alias("operator_name"), F.max("registration").alias("registration_number"),
        F.max("trade_register").alias("trade_register"),
        F.array_join(F.sort_array(F.collect_set("platform")), ",").alias("platforms"), F.count("*").alias("listing_count"),
        F.count_if(F.col("business_type") == "Professional").alias("professional_listings"),
    )


def top_operators(summary: DataFrame, k: int = 5) -> DataFrame:
    return summary.orderBy(F.desc("listing_count"), "operator_key").limit(k)


def large_operators(summary: DataFrame, at_least: int = 10) -> DataFrame:
    return summary.where(F.col("listing_count") >= at_least)


def distinct_properties(listings: DataFrame) -> DataFrame:
    return listings.agg(F.count_distinct(F.coalesce("group_id", "id")).alias("properties"))


def union_targets(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both queues by id; a row of the first wins."""
    return first.unionByName(second.join(first.select("id"), "id", "left_anti"), allowMissingColumns=True)


def map_columns() -> dict[str, Column]:
    """The derived export columns: canonical position, its source and precision, raw address."""
    address = F.coalesce(F.get_json_object("raw_json", "$.basicPropertyData.location.address"),
        F.get_json_object("raw_json", "$.location.address"))
    return {
        "map_latitude": F.coalesce("latitude_best", "latitude"), "map_longitude": F.coalesce("longitude_best", "longitude"),
        "map_source": F.coalesce("location_source", F.lit("platform_coord")),
        "map_precision": F.coalesce("location_precision", F.lit("approximate")),
        "address_raw": address,
    }


def map_projection(listings: DataFrame, anchors: tuple[str, str] = ("name", "geocoded_address")) -> DataFrame:
    """All columns, the map columns after the first anchor and the raw address after the second."""
    derived = map_columns()
    out = []
    for c in listings.columns:
        out.append(F.col(c))
        if c == anchors[0]:
            out += [x.alias(n) for n, x in derived.items() if n.startswith("map_")]
        if c == anchors[1]:
            out.append(derived["address_raw"].alias("address_raw"))
    missing = set(anchors) - set(listings.columns)
    if missing:
        raise ValueError(f"no column to put derived columns after: {', '.join(sorted(missing))}")
    return listings.select(*out)


def marker_rows(listings: DataFrame) -> DataFrame:
    """Rows that a map can show: neither coordinate is zero or null."""
    return listings.where("latitude != 0 and longitude != 0")
