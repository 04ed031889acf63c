import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gleanrow.functions.options import Options
from gleanrow.operators import calibration, fusion, geocode, grid, report, upsert
from gleanrow.plans.curate import curate
from gleanrow.sources import tables

OBS = "key string, listing_id string, platform string, latitude double, longitude double, sigma_m double, source string, seq long"


def observed(spark, rows):
    return spark.createDataFrame([("g", f"l{i}", "airbnb", lat, lng, s, "scraped", i) for i, (lat, lng, s) in enumerate(rows)], OBS)


def fused(spark, rows, o=Options()):
    return fusion.fuse(observed(spark, rows), o=o).first()


def test_fusion(spark):
    assert fused(spark, [(44.43, 26.1, 100.0)] * 2)["sigma_m"] == pytest.approx(100 / math.sqrt(2))
    assert fused(spark, [(44.43, 26.1, 15.0)] * 8)["sigma_m"] == 10.0
    assert fused(spark, [(44.43, 26.1, 15.0)] * 8, Options(min_sigma=0.0))["sigma_m"] < 6
    assert fused(spark, [(44.43, 26.1, 15.0), (44.43, 26.1, 25.0)])["sigma_m"] == pytest.approx(12.86, abs=0.01)
    far = fused(spark, [(44.43, 26.1, 20.0), (44.45, 26.1, 50.0), (44.4301, 26.1, 50.0)])
    assert 44.43 < far["latitude"] < 44.4301 and far["dominant_id"] == "l0"
    tied = fused(spark, [(44.4301, 26.1, 20.0), (44.43, 26.1, 20.0)])
    assert tied["dominant_id"] == "l0" and tied["latitude"] == pytest.approx(44.43005)
    assert fused(spark, [(44.43, 26.1, 0.0), (44.43, 26.1, None)]) is None


def test_calibration(spark):
    pairs = lambda n, d: spark.createDataFrame([(d, 100.0)] * n + [(5000.0, 100.0), (None, 100.0), (1.0, None)],
        "distance_m double, sigma_b double")
    bad = calibration.sigma_buckets(pairs(30, 400.0)).first()
    assert (bad["n"], bad["warned"]) == (30, True) and bad["ratio"] > 1.4
    assert calibration.sigma_buckets(pairs(5, 400.0)).first()["warned"] is False
    assert calibration.sigma_buckets(pairs(40, 100.0)).first()["warned"] is False


def test_offsets(spark):
    cols = "group_id string, id string, platform string, latitude double, longitude double, geo_latitude double, geo_longitude double, sigma_m double"
    rows = [("g", "a", "booking", 44.5, 26.1, 44.43, 26.1, 50.0), ("g", "b", "airbnb", 44.431, 26.1, None, None, 100.0),
        ("g", "c", "airbnb", 44.432, 26.1, None, None, 100.0), ("h", "d", "airbnb", 44.4, 26.1, None, None, 100.0)]
    got = {r["id"]: (r["offset_m"], r["offset_source"]) for r in calibration.offsets(spark.createDataFrame(rows, cols)).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] == got["c"] == (pytest.approx(166.8, abs=0.2), "geocoded")


def test_upserts(spark):
    cols = "id long, name string, price double, lat double"
    old = spark.createDataFrame([(1, "old", 10.0, 1.0), (2, "keep", None, 2.0)], cols)
    new = spark.createDataFrame([(1, None, None, 9.0), (3, "new", 5.0, 3.0)], cols)
    got = sorted(map(tuple, upsert.upsert_last_non_null(old, new, ["id"], ["name"], ["lat"]).collect()))
    assert got == [(1, None, 10.0, 1.0), (2, "keep", None, 2.0), (3, "new", 5.0, 3.0)]
    assert tuple(upsert.write_counts(old, new, ["id"]).first()) == (1, 1)
    kinds = "id long, kind string, price double"
    e = upsert.enrich_first_non_null(
        spark.createDataFrame([(1, None, None), (2, "Unknown", 1.0), (3, "Private", 2.0), (4, None, 3.0)], kinds),
        spark.createDataFrame([(1, "Unknown", 7.0), (2, "Professional", 8.0), (3, "Unknown", 9.0), (9, "x", 1.0)], kinds), ["id"],
        soft={"kind": "Unknown"},
    )
    assert sorted(map(tuple, e.collect())) == [(1, "Unknown", 7.0), (2, "Professional", 1.0), (3, "Private", 2.0), (4, None, 3.0)]
    feed = spark.createDataFrame([(1, "a", 1.0, 1), (1, "b", None, 2)], "id long, name string, price double, seq long")
    assert tuple(upsert.latest_non_null(feed, ["id"], "seq", ["name"]).first()) == (1, "b", 1.0)


def test_progress_runs_and_cache(spark):
    cells = spark.createDataFrame([("c1", "booking"), ("c2", "booking")], "cell_id string, platform string")
    progress = upsert.init_progress(spark.createDataFrame([("c1", "booking", "completed")],
        "cell_id string, platform string, status string"), cells)
    assert sorted(map(tuple, progress.collect())) == [("c1", "booking", "completed"), ("c2", "booking", "pending")]
    assert [r["cell_id"] for r in report.cells_by_status(progress, "booking", "pending").collect()] == ["c2"]
    runs = spark.createDataFrame([(1, None, "running", 5, None), (2, None, "running", 1, None)],
        "run_id long, completed_at string, status string, total_listings long, listings_dropped long")
    ends = spark.createDataFrame([(1, "now", None, 3)], "run_id long, completed_at string, total_listings long, listings_dropped long")
    assert tuple(upsert.finish_runs(runs, ends).where("run_id = 1").first()) == (1, "now", "completed", 5, 3)
    cache = spark.createDataFrame([("a", "ok", 1.0, 2.0, None, 1, datetime(2026, 1, 1)),
        ("b", "failed", None, None, None, 2, datetime(2026, 1, 1)), ("c", "failed", None, None, None, 5, datetime(2026, 1, 1)),
        ("d", "not_found", None, None, None, 1, datetime(2026, 1, 1))], geocode.CACHE)
    asked = spark.createDataFrame([(1, "A"), (2, " b "), (3, "c"), (4, "d"), (5, "e")], "id long, address string")
    looked = geocode.lookup(asked, cache)
    assert [r["outcome"] for r in looked.orderBy("id").collect()] == ["hit", "miss", "exhausted", "negative", "miss"]
    answers = spark.createDataFrame([("b", 3.0, 4.0, "house", False)],
        "address_norm string, latitude double, longitude double, quality string, failed boolean")
    fresh = geocode.resolve(looked, answers, F.lit("2026-02-01").cast("timestamp"))
    after = {r["address_norm"]: (r["status"], r["attempts"], r["latitude"]) for r in geocode.update_cache(cache, fresh).collect()}
    assert after == {"a": ("ok", 1, 1.0), "b": ("ok", 3, 3.0), "c": ("failed", 5, None), "d": ("not_found", 1, None),
        "e": ("not_found", 1, None)}
    assert geocode.purge(cache).count() == 1


def test_grid(spark):
    cells = grid.generate(spark, 44.33, 25.92, 44.58, 26.25)
    assert cells.count() == 140 and grid.children(cells).count() == 560
    first = cells.orderBy("row", "col").first()
    assert (first["bbox"]["sw_lat"], first["bbox"]["ne_lng"]) == (44.33, pytest.approx(25.945))
    points = spark.createDataFrame([(44.331, 25.921)] * 40 + [(44.5, 26.2)], "latitude double, longitude double")
    visited = grid.refine(points, 44.33, 25.92, 0.025, 7, 20)
    assert sorted((r["level"], r["result_count"]) for r in visited.collect()) == [(7, 1), (7, 40), (8, 40), (9, 40), (10, 40)]
    assert report.sample_cells(cells.select("cell_id"), 0.1, 1).count() == 14


def listing(i, platform, lat, phone=None, radius=None, raw=None, name="flat"):
    return (i, platform, name, lat, 26.1, None, phone, None, None, None, None, None, None, raw, radius, datetime(2026, 5, 1))


LISTING = "id string, platform string, name string, latitude double, longitude double, registration string, phone string, email string, bedrooms int, beds int, bathrooms double, max_guests int, amenities_json string, raw_json string, radius_m double, scraped_at timestamp"
TWIN = dict(phone="0721234567")
RAW = '{"location":{"address":"Strada A 3","city":"T"}}'


def test_curation(spark):
    geocodes = spark.createDataFrame([("strada a 3, t", 44.4305, 26.1)], "address_norm string, latitude double, longitude double")
    run = lambda rows, g=None, h=None: {r["id"]: r for r in curate(spark.createDataFrame(rows, LISTING), g,
        h).listings.collect()}
    # a precise twin lends its position
    got = run([listing("a", "booking", 44.43, raw=RAW, **TWIN), listing("b", "airbnb", 44.4302, **TWIN)], geocodes)
    assert got["b"]["location_source"] == "transferred_from_twin" and got["a"]["location_source"] == "geocoded_address"
    assert got["a"]["latitude_best"] == got["b"]["latitude_best"] and got["a"]["location_precision"] == "exact" and got["a"]["offset_source"] == "geocoded"
    # an exact pin stays
    got = run([listing("a", "booking", 44.43, raw=RAW, **TWIN), listing("b", "airbnb", 44.4302, radius=0.0, **TWIN)], geocodes)
    assert got["b"]["latitude_best"] == pytest.approx(44.4302) and got["b"]["location_source"] == "platform_coord" and got["b"]["platform_precision"] == "exact"
    # 8 km apart: no transfer
    got = run([listing("a", "booking", 44.43, **TWIN), listing("b", "airbnb", 44.5, **TWIN)])
    assert got["a"]["latitude_best"] == pytest.approx(44.43) and got["b"]["latitude_best"] == pytest.approx(44.5)
    # a geocode too far away is dropped
    got = run([listing("a", "booking", 44.5, raw=RAW)], geocodes)
    assert got["a"]["location_source"] == "platform_coord" and got["a"]["geo_latitude"] is None
    # history sharpens a position
    old = spark.createDataFrame([("b", "airbnb", 44.4302, 26.1, date(2025, 1, 1)), ("gone", "airbnb", 44.0, 26.1, date(2025, 1, 1))],
        "id string, platform string, latitude double, longitude double, scraped_at date")
    got = run([listing("b", "airbnb", 44.43)], None, tables.historical_observations(old))
    assert got["b"]["est_accuracy_m"] == 70.7


def test_boxes_leave_out_no_conflict(spark):
    """Conflicts by boxes first are those of all pairs, around the limit, at the poles and across the date line."""
    rng = random.Random(2)
    rows = []
    for k in range(300):
        lat, lng = rng.choice([(rng.uniform(-80, 80), rng.uniform(-180, 180)), (89.99, rng.uniform(-180, 180)), (10.0, 179.999)])
        for i in range(rng.randrange(2, 7)):
            far = rng.choice([0.001, 0.004, 0.0062, 0.02])
            point = (lat + rng.uniform(-far, far), (lng + rng.uniform(-far, far) + 180) % 360 - 180)
            rows.append((f"k{k}", rng.choice(["booking", "airbnb"]), min(90.0, point[0]), point[1]))
    df = spark.createDataFrame(rows, "key string, platform string, latitude double, longitude double")
    every = fusion.max_disagreement(df).where("max_distance_m > 1000")
    got = fusion.conflicts(df)
    assert 50 < every.count() < 250
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.collect()))
