"""Hexagons: nearest centres, integer parents, covers, and counts that add up."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gleanrow.operators import hexgrid

FRAME = hexgrid.Frame(44.43, 26.1)


def metres(a, b):
    return math.hypot((a[0] - b[0]) * hexgrid.DEGREE_M, (a[1] - b[1]) * FRAME.east_m)


def points(n=400, seed=3):
    rng = random.Random(seed)
    return [(44.3 + 0.3 * rng.random(), 25.9 + 0.4 * rng.random()) for _ in range(n)]


def test_a_point_is_in_its_cell_at_all_levels(spark):
    rows = spark.createDataFrame(points(), "lat double, lng double")
    line = rows.select("lat", "lng", F.explode(hexgrid.lineage(FRAME, F.col("lat"), F.col("lng"), 5, 11)).alias("c"))
    got = line.collect()
    assert len(got) == 400 * 7
    nearest = {(r.lat, r.lng): r.c.cell for r in got if r.c.level == 11}
    for r in got:
        at = FRAME.centre(r.c.cell.q, r.c.cell.r, r.c.level)
        reach = 1 if r.c.level == 11 else hexgrid.REACH
        assert metres(at, (r.lat, r.lng)) <= reach * FRAME.radius(r.c.level) * (1 + 1e-9)
    for (lat, lng), c in nearest.items():
        own = metres(FRAME.centre(c.q, c.r, 11), (lat, lng))
        assert all(own <= metres(FRAME.centre(c.q + i, c.r + j, 11), (lat, lng)) + 1e-6 for i in (-1, 0, 1) for j in (-1, 0, 1))


def test_children_have_one_parent_and_make_it_up(spark):
    cells = spark.range(41 * 41).select(F.struct((F.floor(F.col("id") / 41) - 20).alias("q"), (F.col("id") % 41 - 20).alias("r")).alias("p"))
    each = cells.select("p", F.explode(hexgrid.children(F.col("p"))).alias("c"))
    assert each.where(hexgrid.parent(F.col("c")) != F.col("p")).count() == 0
    assert each.select("c").distinct().count() == 7 * 41 * 41
    assert FRAME.radius(7) == pytest.approx(math.sqrt(7) * FRAME.radius(8))


def test_cover_holds_every_point_and_only_cells_that_meet_the_box(spark):
    south, west, north, east = 44.3, 25.9, 44.6, 26.3
    cells = hexgrid.cover(spark, FRAME, south, west, north, east, 8)
    have = {(r["cell"]["q"], r["cell"]["r"]): r for r in cells.collect()}
    rows = spark.createDataFrame(points(3000), "lat double, lng double").select("lat", "lng", FRAME.cell(F.col("lat"), F.col("lng"), 8).alias("c"))
    for r in rows.collect():
        box = have[(r.c.q, r.c.r)].bbox
        assert box.sw_lat <= r.lat <= box.ne_lat and box.sw_lng <= r.lng <= box.ne_lng
    for r in have.values():
        near = (min(max(r.center_lat, south), north), min(max(r.center_lng, west), east))
        assert metres(near, (r.center_lat, r.center_lng)) <= FRAME.radius(8) * (1 + 1e-9) and len(r.boundary) == 6
    area = (north - south) * hexgrid.DEGREE_M * (east - west) * FRAME.east_m
    assert len(have) > area / (3 * math.sqrt(3) / 2 * FRAME.radius(8) ** 2)


def test_refinement_adds_up(spark):
    crowd = [(44.43 + i * 1e-6, 26.1) for i in range(500)]
    rows = spark.createDataFrame(points(200) + crowd + crowd[:1] * 50 + [(None, 1.0), (44.4, None)], "latitude double, longitude double")
    got = {r.cell_id: r for r in hexgrid.refine(rows, FRAME, 7, 100).collect()}
    assert sum(r.result_count for r in got.values() if r.level == 7) == 750
    assert max(r.level for r in got.values()) == 10
    for r in got.values():
        below = [c.result_count for c in got.values() if c.parent_id == r.cell_id]
        assert sum(below) == (r.result_count if r.result_count >= 90 and r.level < 10 else 0)
    assert hexgrid.refine(rows.limit(0), FRAME, 7, 100).count() == 0
