"""Queries of the upserts, caches, sinks and scans over the listing views, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.options import Options
from ..functions.similarity import amenity_list
from ..functions.storage import new_path
from ..operators import blocking, fusion, geocode, identity, quality, report, upsert
from ..sinks import files
from ..sources import tables
from ..streaming import ingest, keyed
from . import views
from .curate import reset
from .sql import _ADDR, FIXED_GROUPS, OBS, OPS, L, fused, hav
from .sql import SQL as BASE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
O = Options()


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.listings(spark, sf_dir).withColumn("amenities", amenity_list(F.col("amenities_json")))


def with_positions(rows: DataFrame) -> DataFrame:
    """Listings with the columns that curation adds, still unknown."""
    none = (("latitude_best", "double"), ("longitude_best", "double"), ("location_source", "string"), ("location_precision", "string"),
        ("geocoded_address", "string"))
    return rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in none))


@query(L + " select id, platform, \"name\", latitude, longitude, registration, phone, email, bedrooms, beds, bathrooms, max_guests, "
    "amenities_json, raw_json, radius_m from l where latitude is not null and longitude is not null")
def q_scan_curation(spark, sf_dir):
    return tables.for_curation(views.listings(spark, sf_dir))


@query(L + ' select id, platform, platform_id, "name", latitude, longitude from l')
def q_scan_minimal(spark, sf_dir):
    return tables.minimal(views.listings(spark, sf_dir))


@query(L + ", c as (select distinct grid_cell_id cell_id from l) select cell_id from c order by md5(cell_id || '|7'), cell_id limit "
    "(select greatest(1, cast(floor(count(*) * 0.2) as bigint)) from c)")
def q_cell_sample(spark, sf_dir):
    """A seeded sample of a fifth of the cells: the sample is the operator's own."""
    return report.sample_cells(report.distinct_cells(listings(spark, sf_dir)).withColumnRenamed("grid_cell_id", "cell_id"), 0.2, 7)


@query("select o_orderkey cell_id from orders where o_custkey % 2 = 0 and o_orderstatus = 'F'")
def q_cells_by_status(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    progress = o.select(F.col("o_orderkey").alias("cell_id"),
        F.when(F.col("o_custkey") % 2 == 0, "booking").otherwise("airbnb").alias("platform"), F.col("o_orderstatus").alias("status"))
    return report.cells_by_status(progress, "booking", "F")


_SHARES = ("bedrooms", "price_per_night", "radius_m", "name")


@query(L + " " + " union all ".join(f"select '{c}' field, 100.0 * count(*) filter (\"{c}\" is null) / "
    f"count(*) missing from l" for c in _SHARES))
def q_missing_share(spark, sf_dir):
    return report.missing_shares(listings(spark, sf_dir), _SHARES)


@query(BASE["q_operator_summary"].replace("select coalesce(operator_id", "select * from (select coalesce(operator_id",
    1) + ") where listing_count >= 2")
def q_large_operators(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return report.large_operators(report.operator_summary(rows.join(identity.operator_ids(rows), "id", "left")), 2)


_GEO = ", g as (select *, latitude + cast(k % 50 as double) / 1000 geo_latitude, longitude + cast(k % 7 as double) / 1000 geo_longitude from l)"


@query(L + _GEO + f", d as (select id, {hav('g', 'h').replace('h.latitude', 'g.geo_latitude').replace('h.longitude', 'g.geo_longitude')} "
    f"drift_m from g) select id, round(drift_m, 3) drift_m from d where drift_m <= {O.max_drift_m}")
def q_accept_near(spark, sf_dir):
    """Geocodes within the drift limit."""
    moved = listings(spark, sf_dir).withColumn("geo_latitude",
        F.col("latitude") + (F.col("k") % 50).cast("double") / 1000).withColumn("geo_longitude",
        F.col("longitude") + (F.col("k") % 7).cast("double") / 1000)
    return geocode.accept_near(moved).select("id", F.round("drift_m", 3).alias("drift_m"))


_CACHE = """c as (select concat('a', cast(c_custkey as varchar)) address_norm, case c_custkey % 3 when 0 then 'ok' when 1 then 'not_found'
  else 'failed' end status, case when c_custkey % 3 = 0 then 44.5 end latitude, case when c_custkey % 3 = 0 then 26.5 end longitude,
 case when c_custkey % 3 = 0 then 'street' end quality, cast(1 + c_custkey % 6 as int) attempts, timestamp '2026-01-01 00:00:00'
  last_tried_at from customer where c_acctbal > 0),
 d as (select concat('a', cast(c_custkey as varchar)) address_norm, case when c_custkey % 5 < 3 then cast(44 as double) + c_custkey % 5 end
  lat, c_custkey % 7 = 0 failed from customer where c_nationkey < 19),
 w as (select concat('a', cast(c_custkey as varchar)) address_norm, attempts from customer left join c on c.address_norm = concat('a',
  cast(c_custkey as varchar)) where status is null or (status = 'failed' and attempts < 5)),
 f as (select w.address_norm, case when coalesce(failed, false) then 'failed' when lat is null then 'not_found' else 'ok' end status, lat,
  coalesce(attempts, 0) + 1 attempts from w left join d using (address_norm)),
 r as (select address_norm, status, case when status = 'ok' then lat end latitude, case when status = 'ok' then 26.0 end longitude, case
  when status = 'ok' then 'house' end quality, cast(attempts as int) attempts from f)"""


def _cache(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(cache, fresh answers) of addresses that the customers stand for."""
    k = F.col("c_custkey")
    who = spark.read.parquet(f"{sf_dir}/customer.parquet").select(k, "c_acctbal", "c_nationkey",
        F.concat(F.lit("a"), k.cast("string")).alias("address_norm"))
    ok = k % 3 == 0
    status = F.when(ok, "ok").when(k % 3 == 1, "not_found").otherwise("failed")
    cache = who.where("c_acctbal > 0").select(
        "address_norm", status.alias("status"), F.when(ok, 44.5).alias("latitude"), F.when(ok, 26.5).alias("longitude"),
        F.when(ok, "street").alias("quality"), (1 + k % 6).cast("int").alias("attempts"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("last_tried_at"),
    )
    looked = geocode.lookup(who.select(F.col("c_custkey").alias("id"), F.col("address_norm").alias("address")), cache)
    answers = who.where("c_nationkey < 19").select("address_norm", F.when(k % 5 < 3, 44.0 + k % 5).alias("latitude"),
        F.when(k % 5 < 3, 26.0).alias("longitude"), F.lit("house").alias("quality"), (k % 7 == 0).alias("failed"))
    return cache, geocode.resolve(looked.drop("latitude", "longitude"), answers, F.lit("2026-02-01 00:00:00"))


@query(f"with {_CACHE} select * from r")
def q_geocode_resolve(spark, sf_dir):
    """New cache rows from an injected table of answers."""
    return _cache(spark, sf_dir)[1].drop("last_tried_at")


@query(f"with {_CACHE} select address_norm, status, latitude, longitude, quality, attempts from r union all select address_norm, status, "
    f"latitude, longitude, quality, attempts from c where address_norm not in (select address_norm from r)")
def q_cache_update(spark, sf_dir):
    """The cache after the answers: the latest row of an address stays."""
    return geocode.update_cache(*_cache(spark, sf_dir)).drop("last_tried_at")


@query(f"with {_CACHE} select address_norm, latitude from r where status = 'ok' union all select address_norm, latitude from c where "
    f"status = 'ok' and address_norm not in (select address_norm from r)")
def q_cache_purge(spark, sf_dir):
    return geocode.purge(geocode.update_cache(*_cache(spark, sf_dir))).select("address_norm", "latitude")


@query("""select o_orderkey run_id, case when o_orderstatus = 'F' then o_custkey end completed_at, case when o_orderstatus = 'F' then
  'completed' else 'running' end status,
 case when o_orderstatus = 'F' and o_orderkey % 3 <> 0 then o_orderkey % 100 else cast(5 as bigint) end total_listings, cast(7 as bigint)
  listings_dropped from orders""")
def q_finish_runs(spark, sf_dir):
    """The run audit: ends fill it, missing tallies stay."""
    k = F.col("o_orderkey")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    five, seven = F.lit(5).cast("long"), F.lit(7).cast("long")
    runs = o.select(k.alias("run_id"), F.lit(None).cast("long").alias("completed_at"), F.lit("running").alias("status"),
        five.alias("total_listings"), seven.alias("listings_dropped"))
    ends = o.where("o_orderstatus = 'F'").select(k.alias("run_id"), F.col("o_custkey").alias("completed_at"),
        F.when(k % 3 != 0, k % 100).alias("total_listings"))
    return upsert.finish_runs(runs, ends)


@query(OBS + " select listing_id, count(*) n, round(sum(latitude), 4) latitudes from o group by 1")
def q_ledger(spark, sf_dir):
    """The observation ledger, written as a whole and read back."""
    path = new_path(spark, "ledger")
    for _ in range(2):
        files.replace_ledger(views.observations(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("listing_id").agg(F.count("*").alias("n"), F.round(F.sum("latitude"), 4).alias("latitudes"))


@query(L + """ select id, coalesce(case when k % 2 = 0 then 'page' end, business_name, 'none') business_name, coalesce(max_guests, cast(k %
  5 as int)) max_guests from l""")
def q_merge_fields(spark, sf_dir):
    """A detail merge: page values overwrite, or only fill gaps."""
    k = F.col("k")
    row, page = F.struct("business_name", "max_guests").alias("row"), F.struct(F.when(k % 2 == 0, "page").alias("business_name"),
        (k % 5).cast("int").alias("max_guests")).alias("page")
    rows = listings(spark, sf_dir).select("id", row, page)
    return rows.select("id", *upsert.merge_fields("row", "page", ["business_name"], ["max_guests"], {"business_name": "none"}))


@query("select count(*) filter (o_orderstatus <> 'F') inserted, count(*) filter (o_orderstatus = 'F') updated from orders "
    "where o_custkey > 100")
def q_write_counts(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return upsert.write_counts(o.where("o_orderstatus = 'F'"), o.where("o_custkey > 100"), ["o_orderkey"])


@query(L + f" select id, platform, \"name\", latitude map_latitude, longitude map_longitude, 'platform_coord' map_source, 'approximate' "
    f"map_precision, {_ADDR} address_raw, phone, k from l")
def q_csv_rows(spark, sf_dir):
    """The listing export, written with a byte-order mark and read back."""
    path = new_path(spark, "csv")
    files.save_csv(with_positions(listings(spark, sf_dir)).drop("amenities"), path)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    typed = [F.col(c).cast(t).alias(c) for c, t in (("map_latitude", "double"), ("map_longitude", "double"), ("k", "long"))]
    # a byte-order mark stands before the first column's name
    return back.select(F.col(back.columns[0]).alias("id"), "platform", "name", *typed, "map_source", "map_precision", "address_raw",
        "phone")


@query(L + " select id, 'Feature' kind, 'Point' shape, longitude lng, latitude lat, platform, \"name\", bedrooms, phone from l")
def q_geojson(spark, sf_dir):
    """The GeoJSON features, read back from their text."""
    f = lambda p: F.get_json_object("feature", f"$.{p}")
    rows = files.geojson_features(with_positions(listings(spark, sf_dir)))
    return rows.select(
        f("properties.id").alias("id"), f("type").alias("kind"), f("geometry.type").alias("shape"),
        f("geometry.coordinates[0]").cast("double").alias("lng"), f("geometry.coordinates[1]").cast("double").alias("lat"),
        f("properties.platform").alias("platform"), f("properties.name").alias("name"),
        f("properties.bedrooms").cast("int").alias("bedrooms"), f("properties.phone").alias("phone"),
    )


@query(BASE["q_operator_summary"])
def q_operator_csv(spark, sf_dir):
    """The operator export, written and read back."""
    rows = listings(spark, sf_dir)
    path = new_path(spark, "operators")
    files.save_operators(report.operator_summary(rows.join(identity.operator_ids(rows), "id", "left")), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    names = ["operator_key", *back.columns[1:]]
    back = back.toDF(*names)
    return back.select(*(F.col(c).cast("long").alias(c) if c.endswith("listings") or c.endswith("count") else F.col(c) for c in names))


@query(BASE["q_dedup_metrics"].replace("select (select count(*) from a) comparable_groups",
    "select * exclude (conflict_groups, precision_proxy, recall_proxy) from (select (select count(*) from a) comparable_groups", 1) + ")")
def q_metrics_json(spark, sf_dir):
    """The metrics document, read back from its text."""
    rows = listings(spark, sf_dir)
    groups = rows.select("id", F.concat(F.lit("g"), (F.col("k") % 450).cast("string")).alias("group_id"),
        (F.col("k") % 13 == 0).alias("by_identity"))
    document = files.metrics_text(quality.dedup_metrics(rows, groups))
    n = lambda k: F.get_json_object("document", f"$.{k}").cast("long").alias(k)
    return document.select(*(n(k) for k in ("comparable_groups", "agreeing_groups", "identity_twins", "identity_twins_grouped")))


@query(L + FIXED_GROUPS + ' select group_id, id, platform, "name", latitude, longitude, registration, phone from l join g using (id) order '
    'by group_id, id limit 400')
def q_review_rows(spark, sf_dir):
    """The review sheet: its limit is the operator's own."""
    rows = listings(spark, sf_dir)
    groups = rows.select("id", F.concat(F.lit("g"), (F.col("k") % 450).cast("string")).alias("group_id"))
    return files.review_sample(rows.join(groups, "id")).select("group_id", "id", "platform", "name", "latitude", "longitude",
        "registration", "phone")


def _cell(label: str, value: str) -> str:
    return f"case when coalesce({value}, '') <> '' then '<tr><td>{label}</td><td>' || replace(replace({value}, '&', '&amp;'), '''', '&#x27;') || '</td></tr>' else '' end"


@query(
    L
    + " select id, '<b>' || \"name\" || '</b><table>' || "
    + " || ".join(
        _cell(label, value)
        for label, value in (
            ("Platform", "platform"), ("Price", "printf('%.0f', price_per_night) || ' ' || coalesce(currency, '')"),
            ("Bedrooms", "cast(bedrooms as varchar)"), ("Beds", "cast(beds as varchar)"), ("Bathrooms", "printf('%.1f', bathrooms)"),
            ("Guests", "cast(max_guests as varchar)"), ("Business", "business_name"), ("Kind", "business_type"),
            ("Registration", "registration"), ("Register", "trade_register"), ("Email", "email"), ("Phone", "phone"), ("Host", "host_name"),
            ("Response", "host_response_rate"), ("Since", "host_join_date"),
            ("Coordinates", "printf('%.5f', latitude) || ', ' || printf('%.5f', longitude)"),
            ("Radius", "printf('%.0f', radius_m) || ' m'"), ("Position", "'approximate'"), ("Source", "'platform_coord'"),
        )
    )
    + " || '<tr><td>Page</td><td><a href=\"' || url || '\">' || url || '</a></td></tr></table>' popup from l where latitude <> "
        "0 and longitude <> 0"
)
def q_popup(spark, sf_dir):
    """The pop-up of every marker."""
    rows = report.map_projection(report.marker_rows(with_positions(listings(spark, sf_dir))))
    return rows.select("id", files.popup_html(rows).alias("popup"))


@query(L + " select grid_cell_id cell_id, count(*) n, count(distinct raw_json) payloads from l where raw_json is not null group by 1")
def q_raw_dump(spark, sf_dir):
    """Landed payloads by cell, written and read back."""
    path = new_path(spark, "raw")
    files.dump_raw(listings(spark, sf_dir).where("raw_json is not null").select(F.col("grid_cell_id").alias("cell_id"),
        F.col("raw_json").alias("payload")), path)
    return spark.read.text(path).groupBy("cell_id").agg(F.count("*").alias("n"), F.count_distinct("value").alias("payloads"))


_NUMBER = "cast(substr(listing_id, 2) as int)"
_FARTHEST = hav("a", "b")


@query(
    OBS
    + f""", {fused('o', 'key', 'fk')}, {fused('o', 'listing_id', 'fl')}, p as (select distinct key, platform, latitude, longitude from o),
 bad as (select a.key from p a join p b on a.key = b.key and a.platform = 'booking' and b.platform = 'airbnb' group by a.key having
  max({_FARTHEST}) > {O.disagreement_m}),
 m as (select distinct listing_id, key, case when {_NUMBER} % 10 = 0 then 0.0 when {_NUMBER} % 3 = 0 then 152.0 end radius_m from o),
 ch as (select listing_id, bad.key is not null or coalesce(radius_m = 0, false) alone, fk.fy ky, fk.s ks, fk.d kd, fk.src ksrc, fl.fy ly,
  fl.s ls, fl.d ld, fl.src lsrc
  from m left join bad on bad.key = m.key join fk on fk.g = m.key join fl on fl.g = m.listing_id),
 f as (select listing_id, alone, case when alone then ly else ky end y, case when alone then ls else ks end s, case when alone then ld else
  kd end d, case when alone then lsrc else ksrc end src from ch)
 select listing_id, round({geo.ANCHOR_LAT} + y / {geo.METRES_PER_DEGREE}, 6) latitude, round(s, 1) est_accuracy_m,
 case when not alone and d <> listing_id then 'transferred_from_twin' when src = 'geocoded' then 'geocoded_address' else 'platform_coord'
  end location_source,
 case when s <= {O.exact_max_sigma} then 'exact' else 'approximate' end location_precision from f"""
)
def q_choose_positions(spark, sf_dir):
    """Fused positions per member: exact pins and conflicting keys keep their own."""
    seen = views.observations(spark, sf_dir)
    n = F.substring("listing_id", 2, 20).cast("int")
    radius = F.when(n % 10 == 0, 0.0).when(n % 3 == 0, 152.0)
    members = seen.select("listing_id", "key").distinct().withColumn("radius_m", radius)
    out = fusion.choose_positions(members, seen)
    return out.select("listing_id", F.round("latitude", 6).alias("latitude"), "est_accuracy_m", "location_source", "location_precision")


@query(L + " select id, radius_m, cast(null as varchar) operator_id, cast(null as double) latitude_best, cast(null as varchar) "
    "location_source from l")
def q_reset(spark, sf_dir):
    """Listings as they were landed: derived columns are emptied."""
    done = listings(spark, sf_dir).withColumn("operator_id", F.lit("op")).withColumn("latitude_best", F.col("latitude")).withColumn("location_source", F.lit("x"))
    return reset(done).select("id", "radius_m", "operator_id", "latitude_best", "location_source")


@query(
    OPS
    + f""", s as (select *, from_json(coalesce(amenities_json, '[]'), '["varchar"]') sa from l join op using (id)),
 j as (select a.id id_a, b.id id_b, {hav('a', 'b')} d, a.platform = b.platform same, a.max_guests ga, b.max_guests gb, a.bedrooms ra,
  b.bedrooms rb, a.beds ba, b.beds bb, a.bathrooms ta, b.bathrooms tb, a.sa, b.sa sb from s a join s b on a.operator_id = b.operator_id and
  a.id < b.id),
 q as (select *, case when len(sa) = 0 or len(sb) = 0 then 1.0 else len(list_intersect(sa, sb)) / len(list_distinct(list_concat(sa, sb)))
  end jac from j)
 select id_a, id_b, round(d, 3) distance_m from q where d <= {O.relaxed_distance_m} and not (same and (coalesce(ga <> gb, false) or jac <
  {O.amenity_jaccard}))"""
)
def q_operator_pairs(spark, sf_dir):
    """Pairs of one operator within the relaxed distance that are not distinct units."""
    rows = listings(spark, sf_dir)
    any_name = Options(relaxed_name=-1.0)
    pairs = blocking.operator_candidates(rows, identity.operator_ids(rows), any_name)
    return pairs.select(F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"), F.round("distance_m", 3).alias("distance_m"))


_DAYS = ("2026-01-01", "2026-03-01", "2026-02-01")


@query(L + f""", s as (select *, case k % 3 when 0 then '{_DAYS[0]}' when 1 then '{_DAYS[1]}' else '{_DAYS[2]}' end captured from l)
select captured, id, latitude, longitude from s where captured = (select max(captured) from s)""")
def q_latest_snapshot(spark, sf_dir):
    """The rows of the last of several snapshots of the listings, found by name."""
    base = new_path(spark, "snapshots")
    kind = F.col("k") % 3
    captured = F.when(kind == 0, _DAYS[0]).when(kind == 1, _DAYS[1]).otherwise(_DAYS[2])
    views.listings(spark, sf_dir).withColumn("captured", captured).write.partitionBy("captured").parquet(base)
    found = tables.latest_snapshot(spark, f"{base}/captured=*")
    return spark.read.parquet(found).select(F.lit(found.rsplit("=", 1)[-1]).alias("captured"), "id", "latitude", "longitude")


_EVENTS = """with e as (select user_id, event_id, event_type, case when event_id % 3 = 0 then null else round(value, 2) end price from events)"""


@query(_EVENTS + " select user_id, arg_max(event_type, event_id) event_type, arg_max(price, event_id) filter (price is not null) price from e group by 1")
def q_stream_upsert(spark, sf_dir):
    """Events that land in three files, upserted by a stream one file at a time."""
    base = new_path(spark, "stream")
    price = F.when(F.col("event_id") % 3 != 0, F.round("value", 2)).alias("price")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type", price)
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    third = (high - low) // 3 + 1
    for part in range(3):
        own = events.where(F.col("event_id").between(low + part * third, low + (part + 1) * third - 1))
        own.coalesce(1).write.mode("append").parquet(f"{base}/landed")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landed")
    ingest.upsert_into(rows, f"{base}/table", f"{base}/checkpoint", ["user_id"], "event_id", ["event_type"], []).awaitTermination()
    return spark.read.parquet(f"{base}/table/v=2")


@query(_EVENTS + " select user_id, arg_max(event_type, event_id) event_type, arg_max(price, event_id) filter (price is not null) price from e group by 1")
def q_stream_state(spark, sf_dir):
    """Events that land out of order, upserted by a stream that keeps each user's row as state."""
    base = new_path(spark, "stream")
    price = F.when(F.col("event_id") % 3 != 0, F.round("value", 2)).alias("price")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type", price)
    events.repartition(4, "event_id").write.parquet(f"{base}/landed")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/landed")
    changed = keyed.changes(rows, ["user_id"], "event_id", ["event_type"])
    keyed.write_changes(changed, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return keyed.current(spark, f"{base}/table", ["user_id"])
