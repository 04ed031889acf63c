"""The named queries: each operator over a whole table or view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import text as T
from ..functions.options import Options
from ..functions.similarity import amenity_list, distinct_units, jaccard, masked_similarity, rooms_match
from ..functions.storage import stored
from ..operators import blocking, calibration, clustering, fusion, geocode, grid, hexgrid, identity, quality, report, upsert
from ..operators.components import component_changes, connected_components, with_changes
from ..sinks.files import map_markers
from ..sources import pages, tables
from . import linkage_sql, payload_catalog, state_catalog, views
from .curate import curate
from .sql import SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
IDS = {"a_id": "id_a", "b_id": "id_b"}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.listings(spark, sf_dir).withColumn("amenities", amenity_list(F.col("amenities_json")))


def fixed_groups(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.concat(F.lit("g"), (F.col("k") % 450).cast("string")).alias("group_id"),
        (F.col("k") % 13 == 0).alias("by_identity"))


@query
def q_normalize_keys(spark, sf_dir):
    return listings(spark, sf_dir).select("id", T.normalize_registration(F.col("registration")).alias("reg"),
        T.normalize_phone(F.col("phone")).alias("tel"), T.normalize_email(F.col("email")).alias("mail"))


@query
def q_operator_components(spark, sf_dir):
    return identity.operator_ids(listings(spark, sf_dir))


@query
def q_operator_summary(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return report.operator_summary(rows.join(identity.operator_ids(rows), "id", "left"))


@query
def q_top_operators(spark, sf_dir):
    summary = identity.operator_ids(listings(spark, sf_dir)).groupBy(F.col("operator_id").alias("operator_key")).agg(F.count("*").alias("listing_count"))
    return report.top_operators(summary)


@query
def q_haversine_block_join(spark, sf_dir):
    return blocking.near_rows(listings(spark, sf_dir), (), F.round("distance_m", 3).alias("distance_m")).withColumnsRenamed(IDS)


@query
def q_cross_platform_pairs(spark, sf_dir):
    rows, first = listings(spark, sf_dir), F.col("platform") == "booking"
    near = blocking.neighbour_pairs(rows.where(first), rows.where(~first)).withColumn("d",
        blocking.pair_distance("a_", "b_")).where("d < 100")
    return near.select(F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"), F.round("d", 3).alias("distance_m"))


@query
def q_singleton_identity(spark, sf_dir):
    return identity.singleton_twins(listings(spark, sf_dir))


@query
def q_room_and_amenity_veto(spark, sf_dir):
    read = ("platform", "bedrooms", "beds", "bathrooms", "max_guests", "amenities")
    return blocking.near_rows(listings(spark, sf_dir), read, F.round(jaccard(F.col("a_amenities"), F.col("b_amenities")), 6).alias("jaccard"),
        distinct_units("a_", "b_").alias("distinct_units"), rooms_match("a_", "b_").alias("rooms_match")).withColumnsRenamed(IDS)


@query
def q_component_changes(spark, sf_dir):
    """Rows that share identity keys: components of one platform's rows, then the other's as a batch of new edges."""
    keyed = identity.with_keys(listings(spark, sf_dir), Options()).select("id", "platform", F.explode("keys").alias("key"))
    keyed = stored(keyed, "keyed")

    def stars(rows):
        return rows.join(rows.groupBy("key").agg(F.min("id").alias("first")), "key").select(F.col("first").alias("a"), F.col("id").alias("b"))

    old = keyed.where("platform = 'airbnb'")
    labels = stored(connected_components(stars(old)), "labels")
    batch = stars(keyed.join(keyed.where("platform = 'booking'").select("key").distinct(), "key", "left_semi"))
    return with_changes(labels, stored(component_changes(labels, batch), "changes"))


@query
def q_link_classes(spark, sf_dir):
    """Rows that are equal but for their id, and how many rows each row is paired with."""
    return blocking.link_counts(stored(listings(spark, sf_dir), "rows"))


@query
def q_name_similarity(spark, sf_dir):
    similarity = masked_similarity(F.col("a_masks"), F.col("b_name")).alias("similarity")
    return blocking.near_rows(listings(spark, sf_dir), ("name",), similarity).withColumnsRenamed(IDS)


@query
def q_strict_pairs(spark, sf_dir):
    """The pair rule: near, not distinct units, similar names."""
    pairs = blocking.strict_pairs(listings(spark, sf_dir))
    return pairs.select(F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"), F.round("distance_m", 3).alias("distance_m"),
        "similarity")


@query
def q_matched_pairs(spark, sf_dir):
    """Cross-platform candidates with similar names."""
    pairs = blocking.cross_platform_matches(listings(spark, sf_dir))
    return pairs.select(F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"), F.round("distance_m", 3).alias("distance_m"),
        "similarity")


@query
def q_stack_count(spark, sf_dir):
    return report.stack_counts(listings(spark, sf_dir)).select("id", "stack_count")


@query
def q_fuse_positions(spark, sf_dir):
    fused = fusion.labelled(fusion.fuse(views.observations(spark, sf_dir)), F.lit(False))
    return fused.select("key", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
        F.round("sigma_m", 6).alias("sigma_m"), "dominant_id", "dominant_source", "position_confidence", "location_precision")


@query
def q_conflict_groups(spark, sf_dir):
    return fusion.conflicts(views.observations(spark, sf_dir)).select("key", F.round("max_distance_m", 3).alias("max_distance_m"))


@query
def q_offset_median(spark, sf_dir):
    none = F.lit(None).cast("double")
    members = listings(spark, sf_dir).withColumn("group_id", F.concat(F.lit("g"), F.col("k").cast("string")))
    return calibration.offsets(members.select("group_id", "id", "platform", "latitude", "longitude", none.alias("geo_latitude"),
        none.alias("geo_longitude"), F.lit(100.0).alias("sigma_m")))


@query
def q_sigma_calibration(spark, sf_dir):
    o = views.observations(spark, sf_dir).where("source = 'geocoded'")
    members = o.select(F.col("key").alias("group_id"), "listing_id", "platform", "latitude", "longitude",
        F.col("latitude").alias("geo_latitude"), F.col("longitude").alias("geo_longitude"), "sigma_m")
    return calibration.sigma_buckets(calibration.point_pairs(members))


@query
def q_dedup_metrics(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return quality.dedup_metrics(rows, fixed_groups(rows)).withColumn("conflict_groups", F.array_join("conflict_groups", ","))


@query
def q_upsert_last_nonnull(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type",
        F.when(F.col("event_id") % 3 != 0, F.round("value", 2)).alias("price"),
        F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("props"))
    old, new = (upsert.latest_non_null(x, ["user_id"], "event_id", ["event_type"]) for x in (e.where("event_type in ('view', 'click')"),
        e.where("event_type not in ('view', 'click')")))
    return upsert.upsert_last_non_null(old, new, ["user_id"], overwrite=["event_type"], frozen=["props"])


@query
def q_enrich_first_nonnull(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    old = o.select(k.alias("id"), F.when(k % 3 == 1, "Unknown").when(k % 3 == 2, "Private").alias("kind"),
        F.when(k % 4 != 0, F.col("o_totalprice")).alias("price"), F.col("o_orderpriority").alias("priority"))
    new = o.where("o_orderstatus = 'F'").select(k.alias("id"), F.when(k % 5 == 0, "Unknown").when(k % 5 > 1, "Professional").alias("kind"),
        (F.col("o_totalprice") * 2).alias("price"), F.when(k % 6 != 0, "new").alias("priority"))
    return upsert.enrich_first_non_null(old, new, ["id"], prefer_new=["priority"], soft={"kind": "Unknown"})


@query
def q_progress_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return report.progress_summary(o.select(F.when(F.col("o_custkey") % 2 == 0, "booking").otherwise("airbnb").alias("platform"),
        F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 300).alias("result_count")))


@query
def q_cell_transitions(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    status = F.when(k % 4 == 0, "in_progress").when(k % 4 == 1, "completed").when(k % 4 == 2, "failed").otherwise("needs_refinement")
    events = o.select(F.col("o_custkey").alias("cell_id"), F.lit("booking").alias("platform"), status.alias("status"), k.alias("at"),
        (F.col("o_custkey") % 300).alias("result_count"), F.lit(None).cast("string").alias("error_message"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("started_at", "long"), ("completed_at", "long"), ("result_count", "long"),
        ("error_message", "string"))]
    progress = upsert.init_progress(spark.createDataFrame([], "cell_id long, platform string, status string"), events).select("*", *none)
    return upsert.apply_transitions(progress, events).select("cell_id", "status", "started_at", "completed_at", "result_count")


@query
def q_missing_filters(spark, sf_dir):
    either = lambda test, *a: test("booking", *a) | test("airbnb", *a)
    return listings(spark, sf_dir).groupBy("platform").agg(
        F.count_if(either(report.missing_rooms)).alias("missing_rooms"), F.count_if(report.missing_all_rooms()).alias("missing_all_rooms"),
        F.count_if(either(report.missing_price)).alias("missing_price"),
        F.count_if(either(report.missing_business, False)).alias("missing_business"),
        F.count_if(either(report.missing_business)).alias("business_queue"), F.count_if(report.missing_page_details()).alias("page_queue"),
    )


@query
def q_business_queue(spark, sf_dir):
    """A limited work queue: the limit is the operator's own."""
    return report.queue(listings(spark, sf_dir), report.missing_business("airbnb"), 50).select("id")


@query
def q_union_targets(spark, sf_dir):
    rows = listings(spark, sf_dir)
    unknown = F.coalesce(F.col("business_type"), F.lit("Unknown")) == "Unknown"
    return report.union_targets(rows.where("price_per_night is null").select("id", F.lit("price").alias("why")),
        rows.where(unknown).select("id", F.lit("business").alias("why")))


@query
def q_distinct_cells(spark, sf_dir):
    return report.distinct_cells(listings(spark, sf_dir))


@query
def q_cells_with_listings(spark, sf_dir):
    cells = spark.range(150).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("cell_id"),
        F.explode(F.array(F.lit("booking"), F.lit("airbnb"))).alias("platform"))
    return report.cells_with_listings(cells, listings(spark, sf_dir))


@query
def q_distinct_properties(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return report.distinct_properties(rows.join(fixed_groups(rows), "id", "left"))


@query
def q_counts(spark, sf_dir):
    return report.counts(listings(spark, sf_dir))


@query
def q_currency(spark, sf_dir):
    price, currency = geo.to_eur(F.col("price_per_night"), F.col("currency"), Options().ron_per_eur)
    return listings(spark, sf_dir).select("id", price.alias("price"), currency.alias("currency"))


@query
def q_json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(T.json_path(F.col("props"), "k").try_cast("int"),
        F.lit(-1)).alias("k"), T.json_path(F.col("props"), "missing", "none").alias("missing"))


@query
def q_map_projection(spark, sf_dir):
    none = [F.lit(None).cast(t).alias(c) for c, t in (("latitude_best", "double"), ("longitude_best", "double"),
        ("location_source", "string"), ("location_precision", "string"), ("geocoded_address", "string"))]
    return report.map_projection(listings(spark, sf_dir).select("*", *none)).select("id", "map_latitude", "map_longitude", "map_source",
        "map_precision", "address_raw")


@query
def q_map_markers(spark, sf_dir):
    none = [F.lit(None).cast(t).alias(c) for c, t in (("latitude_best", "double"), ("longitude_best", "double"),
        ("location_source", "string"), ("location_precision", "string"), ("geocoded_address", "string"))]
    return map_markers(listings(spark, sf_dir).select("*", *none)).drop("popup")


@query
def q_html_title_meta(spark, sf_dir):
    return pages.title_and_lang(table(spark, sf_dir, "pages")).select("page_id", "title", "lang")


@query
def q_html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", pages.lines_of(F.col("html")).alias("stripped"))


@query
def q_html_escape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.html_escape(F.col("url")).alias("escaped"))


@query
def q_url_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"/$",
        "").alias("clean"))


@query
def q_text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.plain_text(F.col("text"))).alias("plain_md5"))


@query
def q_pii_keys(spark, sf_dir):
    """Every address and number of a text, as identity keys."""
    found = lambda pattern: F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("raw")
    kinds = (("mail", r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", T.normalize_email),
        ("tel", r"\+?\d[\d .()-]{7,18}\d", T.normalize_phone))
    docs = table(spark, sf_dir, "documents")
    mails, phones = (docs.select("doc_id", found(p)).select("doc_id", F.lit(kind).alias("kind"), key(F.col("raw")).alias("value")) for kind,
        p, key in kinds)
    return mails.unionByName(phones).where("value is not null").distinct()


@query
def q_exact_dup_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("first_id"),
        F.count("*").alias("copies")).where("copies > 1").drop("h")


@query
def q_address_clean(spark, sf_dir):
    rows = listings(spark, sf_dir).where("platform = 'booking'").select("id", T.payload_address(F.col("raw_json")).alias("address"))
    return rows.withColumn("address_key", T.address_key(F.col("address")))


@query
def q_precision_class(spark, sf_dir):
    rows = report.stack_counts(listings(spark, sf_dir)).withColumn("address", T.payload_address(F.col("raw_json")))
    args = F.col("platform"), F.col("address"), F.col("radius_m")
    return rows.select("id", geo.scraped_sigma(*args, F.col("stack_count")).alias("sigma_m"),
        geo.platform_precision(*args).alias("platform_precision"))


@query
def q_geocode_lookup(spark, sf_dir):
    rows = listings(spark, sf_dir).select("id", "k", T.payload_address(F.col("raw_json")).alias("address")).where("address is not null")
    k = rows.groupBy(T.address_key(F.col("address")).alias("address_norm")).agg(F.max("k").alias("k")).where("k % 5 != 4")
    m = F.col("k") % 5
    cache = k.select("address_norm", F.when(m == 0, "ok").when(m == 1, "not_found").otherwise("failed").alias("status"),
        F.lit(44.4).alias("latitude"), F.lit(26.1).alias("longitude"), F.when(m == 3, 5).otherwise(1).alias("attempts"))
    return geocode.lookup(rows, cache).select("id", "outcome")


@query
def q_grid_cells(spark, sf_dir):
    """Cells over the extent of the listings, with how many listings lie in each."""
    rows = listings(spark, sf_dir)
    south, north, west, east = rows.agg(F.min("latitude"), F.max("latitude"), F.min("longitude"), F.max("longitude")).first()  # one row
    cells = grid.generate(spark, south, west, north + 0.001, east + 0.001)
    row, col = grid.cell_of(F.col("latitude"), F.col("longitude"), south, west, 0.025, 7, F.lit(7))
    held = rows.groupBy(row.alias("row"), col.alias("col")).agg(F.count("*").alias("listings"))
    six = lambda c, n: F.round(c, 6).alias(n)
    return cells.join(held, ["row", "col"], "left").select("cell_id", six("center_lat", "center_lat"), six("center_lng", "center_lng"),
        six("bbox.ne_lat", "ne_lat"), six("bbox.sw_lng", "sw_lng"), F.coalesce("listings", F.lit(0)).alias("listings"))


@query
def q_hex_cells(spark, sf_dir):
    """Hexagons that meet the extent of the listings, with how many listings lie in each."""
    rows, frame = listings(spark, sf_dir), hexgrid.Frame(44.43, 26.1)
    south, north, west, east = rows.agg(F.min("latitude"), F.max("latitude"), F.min("longitude"), F.max("longitude")).first()  # one row
    held = rows.where("latitude is not null and longitude is not null").groupBy(frame.cell(F.col("latitude"), F.col("longitude"),
        7).alias("cell")).agg(F.count("*").alias("listings"))
    return hexgrid.cover(spark, frame, south, west, north, east).join(held, "cell", "left").select("cell_id", "parent_id",
        F.round("center_lat", 6).alias("center_lat"), F.round("center_lng", 6).alias("center_lng"), F.coalesce("listings", F.lit(0)).alias("listings"))


@query
def q_hex_refine(spark, sf_dir):
    """Hexagons of levels 7 to 10 that a search visits: children of cells with many listings."""
    return hexgrid.refine(listings(spark, sf_dir), hexgrid.Frame(44.43, 26.1), 7, 20)


@query
def q_grid_refine(spark, sf_dir):
    return grid.refine(listings(spark, sf_dir), 44.33, 25.92, 0.025, 7, 20)


@query
def q_history(spark, sf_dir):
    return tables.historical_observations(listings(spark, sf_dir).withColumn("scraped_at",
        F.lit(None).cast("timestamp"))).drop("capture_date")


@query
def q_zoom(spark, sf_dir):
    return listings(spark, sf_dir).where("radius_m is not null").select("id", geo.zoom_level(F.col("radius_m") / 100000).alias("zoom"))


@query
def q_stable_ids(spark, sf_dir):
    pair = F.sort_array(F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), T.stable_id("xpg_", pair).alias("gid"))


@query
def q_property_groups(spark, sf_dir):
    rows = stored(listings(spark, sf_dir), "rows")
    return clustering.property_groups(rows, stored(identity.operator_ids(rows), "operators"))


@query
def q_greedy_one_to_one(spark, sf_dir):
    return clustering.one_to_one(stored(listings(spark, sf_dir), "rows"))


@query
def q_batch_dedup(spark, sf_dir):
    rows = listings(spark, sf_dir).withColumn("seq", F.col("k") * 2 + F.when(F.col("platform") == "booking", 1).otherwise(0))
    return clustering.batch_dedup(rows).select("id", "seq")


def _curated(done) -> DataFrame:
    six = lambda c: F.round(c, 6).alias(c)
    return done.listings.select(
        "id", "operator_id", "group_id", "cross_group_id", six("latitude_best"), six("longitude_best"), "est_accuracy_m", "location_source",
        "location_precision", "offset_m", "platform_precision",
    )


def _landed(spark, sf_dir) -> DataFrame:
    return views.listings(spark, sf_dir).withColumn("scraped_at", F.lit("2026-05-01T00:00:00").cast("timestamp"))


@query
def q_curate(spark, sf_dir):
    """The whole plan over landed positions."""
    return _curated(curate(_landed(spark, sf_dir)))


@query
def q_curate_observed(spark, sf_dir):
    """The whole plan with geocodes and an older snapshot as further observations."""
    rows = stored(_landed(spark, sf_dir), "landed")
    address = rows.where("platform = 'booking'").select(T.payload_address(F.col("raw_json")).alias("address"), "latitude", "longitude").where("address is not null")
    geocodes = address.groupBy(T.address_key(F.col("address")).alias("address_norm")).agg(
        (F.min("latitude") + 0.001).alias("latitude"), (F.min("longitude") + 0.001).alias("longitude")
    )
    snapshot = rows.withColumn("latitude", F.col("latitude") + 0.0005)
    return _curated(curate(rows, geocodes, tables.historical_observations(snapshot)))


def queries() -> dict[str, Query]:
    return QUERIES | payload_catalog.QUERIES | state_catalog.QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL | linkage_sql.SQL | payload_catalog.SQL | state_catalog.SQL
