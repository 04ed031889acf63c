"""A hexagonal grid of levels: seven cells of a level make one of the level above.

Cells are axial coordinates (q, r) of a triangular lattice in a plane around an origin (degrees
scaled by the cosine of its latitude, so a frame is good for a region, not for the globe). In the
plane as complex numbers, with z the sixth root of one, the lattice of a level is that of the
level above divided by 2 + z, whose norm is 7: a cell's children are (2 + z) times it and the six
cells around that. Parent and children are integer arithmetic, and each cell has one parent, so
counts of children add up to that of the parent. A point's cell is the nearest at the finest level
that is used, and the ancestors of that cell above; it is at most ``REACH`` times the
circumradius from the centre of each of them.

Edge cases: rows without a coordinate have no cell; a point at equal distance from centres goes
to the one that rounding up gives; an empty table has no cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.options import Options

#: Metres of a degree of latitude, and of the edge of a cell of level 0.
DEGREE_M, EDGE_M = 111_195.0, 1_107_710.0
#: Of the circumradius: 1 / sqrt(7) + 1 / 7 + ... of a lattice step of sqrt(3), rounded up.
REACH = 1.06
_Z = complex(0.5, math.sqrt(3) / 2)


@dataclass(frozen=True)
class Frame:
    """The plane of a region."""

    lat: float
    lng: float

    @property
    def east_m(self) -> float:
        return DEGREE_M * math.cos(math.radians(self.lat))

    def step(self, level: int) -> complex:
        """The lattice step from (0, 0) to (1, 0), in metres."""
        return math.sqrt(3) * EDGE_M / (2 + _Z) ** level

    def radius(self, level: int) -> float:
        return abs(self.step(level)) / math.sqrt(3)

    def corners(self, level: int) -> list[complex]:
        """From the centre, in order."""
        return [self.step(level) / math.sqrt(3) * 1j * _Z**k for k in range(6)]

    def axial_terms(self, level: int) -> tuple[tuple[float, float], tuple[float, float]]:
        """(per degree of latitude, per degree of longitude) of q, and of r."""
        north, east = 1j * DEGREE_M / self.step(level), self.east_m / self.step(level)
        r = [v.imag / _Z.imag for v in (north, east)]
        return (north.real - r[0] / 2, east.real - r[1] / 2), (r[0], r[1])

    def axial(self, lat: Column | float, lng: Column | float, level: int):
        """Fractional q and r."""
        (qa, qb), (ra, rb) = self.axial_terms(level)
        north, east = lat - self.lat, lng - self.lng
        return north * qa + east * qb, north * ra + east * rb

    def cell(self, lat: Column, lng: Column, level: int) -> Column:
        """struct<q, r> of the nearest centre: the coordinate that rounding moved most follows from the others."""
        q, r = self.axial(lat, lng, level)
        s = -q - r
        near = [F.floor(x + 0.5) for x in (q, r, s)]
        moved = [F.abs(n - x) for n, x in zip(near, (q, r, s))]
        fix_q = (moved[0] > moved[1]) & (moved[0] > moved[2])
        fix_r = ~fix_q & (moved[1] > moved[2])
        return F.struct(F.when(fix_q, -near[1] - near[2]).otherwise(near[0]).alias("q"),
            F.when(fix_r, -near[0] - near[2]).otherwise(near[1]).alias("r"))

    def centre(self, q: Column, r: Column, level: int) -> tuple[Column, Column]:
        """Latitude and longitude."""
        one, other = self.step(level), self.step(level) * _Z
        return (self.lat + (q * one.imag + r * other.imag) / DEGREE_M, self.lng + (q * one.real + r * other.real) / self.east_m)


def parent(cell: Column) -> Column:
    """struct<q, r>: the division by 2 + z, in sevenths, to the nearest; all seven children are within three of them."""
    q, r = cell["q"], cell["r"]
    return F.struct(F.floor((3 * q + r + 3) / 7).alias("q"), F.floor((2 * r - q + 3) / 7).alias("r"))


def children(cell: Column) -> Column:
    """array<struct<q, r>> of the seven cells, the middle first."""
    q, r = 2 * cell["q"] - cell["r"], cell["q"] + 3 * cell["r"]
    around = ((0, 0), (1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))
    return F.array(*(F.struct((q + i).alias("q"), (r + j).alias("r")) for i, j in around))


def cell_id(level: Column | int, cell: Column) -> Column:
    return F.concat_ws("/", F.lit(level).cast("string") if isinstance(level, int) else level.cast("string"), cell["q"].cast("string"),
        cell["r"].cast("string"))


def ancestor(cell: Column, steps: int) -> Column:
    for _ in range(steps):
        cell = parent(cell)
    return cell


def lineage(frame: Frame, lat: Column, lng: Column, base: int, finest: int) -> DataFrame | Column:
    """array<struct<level, cell, parent>> of a point from the finest level up to base, whose parent is of level base - 1.

    Null where a coordinate is. Let bindings, so that each division is done once.
    """
    cells = F.array(frame.cell(lat, lng, finest))
    for _ in range(finest - base + 1):
        cells = F.transform(F.array(cells), lambda known: F.concat(known, F.array(parent(F.element_at(known, -1)))))[0]
    levels = finest - base + 1
    pairs = F.zip_with(F.slice(cells, 1, levels), F.slice(cells, 2, levels), lambda c, up: F.struct(c.alias("cell"), up.alias("parent")))
    out = F.transform(pairs, lambda p, i: F.struct((finest - i).alias("level"), p["cell"].alias("cell"), p["parent"].alias("parent")))
    return F.when(lat.isNotNull() & lng.isNotNull(), out)


def _meets(frame: Frame, level: int, south: float, west: float, north: float, east: float) -> Column:
    """Whether the hexagon with lat, lng as centre meets the box: two convex figures with a centre, so an axis parts them or they meet."""
    dx, dy = (F.col("center_lng") - (west + east) / 2) * frame.east_m, (F.col("center_lat") - (south + north) / 2) * DEGREE_M
    half = ((east - west) / 2 * frame.east_m, (north - south) / 2 * DEGREE_M)
    corners = frame.corners(level)
    normals = [(corners[k] + corners[k + 1]) / abs(corners[k] + corners[k + 1]) for k in range(3)]
    out = F.lit(True)
    for n in (complex(1, 0), complex(0, 1), *normals):
        own = max((c * n.conjugate()).real for c in corners)
        out = out & (F.abs(dx * n.real + dy * n.imag) <= own + half[0] * abs(n.real) + half[1] * abs(n.imag))
    return out


def cover(spark: SparkSession, frame: Frame, south: float, west: float, north: float, east: float, level: int = 7) -> DataFrame:
    """The cells of a level whose hexagons meet the box, with their shape."""
    ends = [frame.axial(a, b, level) for a in (south, north) for b in (west, east)]
    low = [math.floor(min(e[i] for e in ends)) - 1 for i in (0, 1)]
    wide = [math.ceil(max(e[i] for e in ends)) + 2 - low[i] for i in (0, 1)]
    cell = F.struct((F.floor(F.col("id") / wide[1]) + low[0]).alias("q"), (F.col("id") % wide[1] + low[1]).alias("r"))
    cells = with_shape(spark.range(wide[0] * wide[1]).select(cell.alias("cell")), frame, level)
    return cells.where(_meets(frame, level, south, west, north, east))


def with_shape(cells: DataFrame, frame: Frame, level: int) -> DataFrame:
    """cells (cell) with level, cell_id, parent_id, centre, the six corners of boundary, and a bbox that holds all points of the cell."""
    lat, lng = frame.centre(F.col("cell.q"), F.col("cell.r"), level)
    out = cells.select("cell", F.lit(level).alias("level"), cell_id(level, F.col("cell")).alias("cell_id"),
        cell_id(level - 1, parent(F.col("cell"))).alias("parent_id"), lat.alias("center_lat"), lng.alias("center_lng"))
    corner = lambda c: F.struct((F.col("center_lat") + c.imag / DEGREE_M).alias("lat"),
        (F.col("center_lng") + c.real / frame.east_m).alias("lng"))
    reach = REACH * frame.radius(level)
    up, side = reach / DEGREE_M, reach / frame.east_m
    bbox = F.struct((F.col("center_lat") + up).alias("ne_lat"), (F.col("center_lng") + side).alias("ne_lng"),
        (F.col("center_lat") - up).alias("sw_lat"), (F.col("center_lng") - side).alias("sw_lng"))
    return out.withColumn("boundary", F.array(*(corner(c) for c in frame.corners(level)))).withColumn("bbox", bbox)


def refine(points: DataFrame, frame: Frame, base: int, cap: int, o: Options = Options()) -> DataFrame:
    """level, cell_id, parent_id, result_count of every cell that is visited: the base level, then the children of crowded cells.

    points: latitude, longitude. They are counted once, by the finest cell; the counts of all levels are
    sums of those, and a parent's count is the sum over its seven children, so no level reads the points again.
    """
    finest = o.max_resolution
    cells = points.select(lineage(frame, F.col("latitude"), F.col("longitude"), base, finest).alias("line"))
    fine = cells.where("line is not null").groupBy("line").agg(F.count("*").alias("n"))
    each = fine.select(F.explode("line").alias("c"), "n").groupBy("c").agg(F.sum("n").alias("result_count"))
    siblings = Window.partitionBy("c.level", "c.parent")
    above = F.sum("result_count").over(siblings) >= cap * o.refine_threshold
    visited = each.withColumn("visited", (F.col("c.level") == base) | above).where("visited")
    return visited.select("c.level", cell_id(F.col("c.level"), F.col("c.cell")).alias("cell_id"),
        cell_id(F.col("c.level") - 1, F.col("c.parent")).alias("parent_id"), "result_count")
