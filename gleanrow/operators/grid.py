"""A quadtree grid: cells that cover a box, hierarchical children, refinement of crowded cells.

No hexagonal index is available here, so cells are squares of a quadtree with ids
``level/row/col``: they cover the box, have 4 children each, and are refined level by level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.options import Options


def cell_id(level: Column, row: Column, col: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), row.cast("string"), col.cast("string"))


def _with_geometry(cells: DataFrame, south: float, west: float, step: float, base: int) -> DataFrame:
    """cells (level, row, col) with id, boundary, bbox (from the boundary's extremes) and centre."""
    size = F.lit(step) / F.pow(F.lit(2.0), F.col("level") - base)
    lat, lng = south + F.col("row") * size, west + F.col("col") * size
    corner = lambda a, b: F.struct(a.alias("lat"), b.alias("lng"))
    boundary = F.array(corner(lat, lng), corner(lat, lng + size), corner(lat + size, lng + size), corner(lat + size, lng))
    out = cells.withColumn("cell_id", cell_id(F.col("level"), F.col("row"), F.col("col"))).withColumn("boundary", boundary)
    lats, lngs = F.transform("boundary", lambda p: p["lat"]), F.transform("boundary", lambda p: p["lng"])
    bbox = F.struct(F.array_max(lats).alias("ne_lat"), F.array_max(lngs).alias("ne_lng"), F.array_min(lats).alias("sw_lat"),
        F.array_min(lngs).alias("sw_lng"))
    return out.withColumn("bbox", bbox).withColumn("center_lat", lat + size / 2).withColumn("center_lng", lng + size / 2)


def generate(spark: SparkSession, south: float, west: float, north: float, east: float, step: float = 0.025, base: int = 7) -> DataFrame:
    """Cells of the base level whose squares cover the box."""
    from math import ceil

    rows, cols = ceil(round((north - south) / step, 9)), ceil(round((east - west) / step, 9))
    cells = spark.range(rows * cols).select(F.lit(base).alias("level"), F.floor(F.col("id") / cols).alias("row"),
        (F.col("id") % cols).alias("col"))
    return _with_geometry(cells, south, west, step, base)


def children(cells: DataFrame) -> DataFrame:
    """level, row, col of the 4 children of each cell, with parent_id."""
    quads = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))
    out = cells.select("level", "row", "col", cell_id(F.col("level"), F.col("row"), F.col("col")).alias("parent_id"),
        F.explode(quads).alias("q"))
    return out.select((F.col("level") + 1).alias("level"), (F.col("row") * 2 + F.col("q.i")).alias("row"),
        (F.col("col") * 2 + F.col("q.j")).alias("col"), "parent_id")


def should_refine(result_count: Column, cap: int, threshold: float) -> Column:
    return result_count >= cap * threshold


def cell_of(lat: Column, lng: Column, south: float, west: float, step: float, base: int, level: Column) -> tuple[Column, Column]:
    """(row, col) of a point at a level."""
    size = F.lit(step) / F.pow(F.lit(2.0), level - base)
    return F.floor((lat - south) / size), F.floor((lng - west) / size)


def refine(points: DataFrame, south: float, west: float, step: float, base: int, cap: int, o: Options = Options()) -> DataFrame:
    """level, row, col, result_count of every cell that is visited: the base level, then the children of crowded cells.

    points: latitude, longitude. One aggregation per level; only points in crowded cells go on.
    """
    at, out = points.select("latitude", "longitude"), None
    for level in range(base, o.max_resolution + 1):
        row, col = cell_of(F.col("latitude"), F.col("longitude"), south, west, step, base, F.lit(level))
        here = at.withColumn("level", F.lit(level)).withColumn("row", row).withColumn("col", col)
        counts = here.groupBy("level", "row", "col").agg(F.count("*").alias("result_count"))
        out = counts if out is None else out.unionByName(counts)
        crowded = counts.where(should_refine(F.col("result_count"), cap, o.refine_threshold)).select("row", "col")
        at = here.join(crowded, ["row", "col"], "left_semi").select("latitude", "longitude")
    return out
