"""Tables with a row for each listing are not gathered on the driver to be broadcast, however small their files are."""

import random
from dataclasses import replace

from pyspark.sql import functions as F

from gleanrow.functions import storage
from gleanrow.functions.options import Options
from gleanrow.operators import clustering, fusion, identity
from gleanrow.plans import curate as plan
from gleanrow.plans import views
from gleanrow.sources import tables

from .test_crowds import groups_of, plain, stacked
from .test_linkage import frame


def broadcasts(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin")


def spied(monkeypatch, *modules):
    """Names of stored tables, and the broadcasts that Spark plans for each by the sizes of files."""
    seen = []

    def spy(df, name):
        seen.append((name, broadcasts(df)))
        return storage.stored(df, name)

    for module in modules:
        monkeypatch.setattr(module, "stored", spy)
    return seen


def test_curate_does_not_broadcast_listings(spark, monkeypatch):
    rows = frame(spark, stacked(random.Random(8), 120)).drop("amenities").withColumns({"amenities_json": F.lit('["tv"]'), "radius_m": F.lit(152.0),
        "raw_json": F.lit('{"location":{"address":"1 Old Square"}}'), "scraped_at": F.lit("2026-05-01").cast("timestamp")})
    rows = storage.stored(rows, "landed")
    geocodes = storage.stored(spark.createDataFrame([("1 old square", 44.431, 26.101)], "address_norm string, latitude double, longitude double"), "geocodes")
    seen = spied(monkeypatch, plan, identity, clustering, fusion)
    done = plan.curate(rows, geocodes, tables.historical_observations(rows))
    assert {"operators", "groups", "observations"} <= {name for name, _ in seen}
    assert dict(seen)["observations"] == 0 and dict(seen)["groups"] == 0
    assert done.listings.count() == 120 and done.observations.where("source = 'geocoded'").count() == 60


def test_parts_of_the_listings_view_are_not_broadcast(spark, tmp_path):
    spark.range(40).select(F.col("id").alias("c_custkey"), F.lit(5.0).alias("c_acctbal")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(4).select(F.col("id").alias("s_suppkey"), F.lit(5.0).alias("s_acctbal")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(50).select(F.col("id").alias("p_partkey"), F.lit("A").alias("p_name"), F.lit("B").alias("p_type")).write.parquet(f"{tmp_path}/part.parquet")
    df = views.listings(spark, str(tmp_path))
    assert broadcasts(df) == 0 and df.count() == 44


def test_one_pair_stands_for_those_of_two_groups(spark, monkeypatch):
    """The rounds hand on one open pair of two groups, with the groups of one pass over all pairs; also where no rule is the narrower."""
    rows = stacked(random.Random(10), 260)
    df = storage.stored(frame(spark, rows), "rows")
    for o in (Options(), replace(Options(), strict_name=60.0, relaxed_name=75.0)):
        ops = identity.operator_ids(df)
        pairs = [tuple(r) for r in clustering.candidates(df, ops, o).collect()]
        want = sorted((ids, by) for ids, by in clustering.cluster(plain(rows), pairs, o))
        ends = []

        def spy(table, name, ends=ends):
            out = storage.stored(table, name)
            if name == "ends":
                ends.append(out)
            return out

        monkeypatch.setattr(clustering, "stored", spy)
        assert groups_of(clustering.property_groups(df, ops, replace(o, component_pairs=10, equal_rows=10**9))) == want
        first = ends[1]  # of the second round: groups have more rows than one
        two = first.select(F.least("home_a", "home_b").alias("x"), F.greatest("home_a", "home_b").alias("y"), "tier")
        assert first.count() > 0 and two.count() <= two.distinct().count()
        monkeypatch.undo()
