"""Spatial joins over a grid of cells (J2-J5, J9, J11, J12): equi-join on cells, then exact distances."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pisteflow.functions import geo
from pisteflow.operators import kernels
from pisteflow.plans.lineage import discard, materialize

#: Least height of a cell in degrees. A geometry is in all cells that its widened box meets; cells are
#: never smaller than what boxes are widened by, so a point has nine at most.
CELL = 0.01
#: Cells of one geometry at this size at most; a larger one uses coarser cells.
LEVELS, CELLS = (1, 16, 256), 64
_M_PER_DEGREE = 110574.0
#: A degree along the equator is slightly longer than this.
_M_PER_DEGREE_EAST = 111319.0
#: A nearest neighbour further than this is looked for in rings, each RING times as wide as the one before.
RINGS_FROM_M, RING = 2000.0, 4


def _levels(widen_m: float) -> tuple[int, ...]:
    """Cell sizes, in units of CELL, for boxes that are widened by so many metres."""
    least = max(1, math.ceil(widen_m / _M_PER_DEGREE / CELL))
    return tuple(least * v for v in LEVELS)


def _level_cells(box: Column, widen_m: float, level: int) -> Column:
    size = CELL * level
    dy = widen_m / _M_PER_DEGREE
    y0, y1 = F.floor((box["south"] - dy) / size), F.floor((box["north"] + dy) / size)
    # The width of a cell is fixed for its row, so both sides agree: 1 / cos of the row's latitude.
    row = F.sequence(y0, y1)

    def of_row(y: Column) -> Column:
        far = F.least(F.greatest(F.abs(y * size), F.abs((y + 1) * size)), F.lit(89.0))
        width = F.lit(size) / F.cos(F.radians(F.least(F.abs(y * size), F.lit(89.0))))
        dx = F.lit(widen_m / 111320.0) / F.cos(F.radians(far))
        n = F.ceil(F.lit(360.0) / width)
        x0, x1 = F.floor((box["west"] - dx + 180) / width), F.floor((box["east"] + dx + 180) / width)
        return F.transform(F.sequence(x0, x1), lambda x: F.struct(F.lit(level).alias("level"), F.pmod(x, n).alias("x"), y.alias("y")))

    return F.array_distinct(F.flatten(F.transform(row, of_row)))


def _level(box: Column, levels: tuple[int, ...]) -> Column:
    """Finest level on which the box has few cells."""
    out = F.lit(levels[-1])
    for level in reversed(levels[:-1]):
        size = CELL * level
        many = ((box["north"] - box["south"]) / size + 1) * ((box["east"] - box["west"]) / size + 1)
        out = F.when(many <= CELLS, F.lit(level)).otherwise(out)
    return out


def candidates(left: DataFrame, right: DataFrame, widen_m: float = 0.0, left_key: str = "lkey", right_key: str = "rkey", carry: bool = False) -> DataFrame:
    """(left_key, right_key) of geometries whose widened boxes meet, each pair once.

    Frames have their key and a geometry; carry adds the geometries as lg and rg. Each geometry lies
    on the level of its size; the levels of a pair meet on the coarser one, so both sides are also
    placed on every coarser level, with a mark of where they are at home; a pair joins on a level
    where one of both is at home. Of several cells that a pair shares the least one gives the pair,
    so nothing has to be made distinct. A cell with very many rows is a skewed key, which AQE splits,
    as neither side is aggregated.
    """
    levels = _levels(widen_m)

    def placed(df: DataFrame, key: str, widen: float, name: str) -> DataFrame:
        box = geo.bbox(F.col("geometry"))
        kept = [F.col("geometry").alias(f"{name}g")] if carry else []
        first = df.where(F.col("geometry.parts")[0][0][0] <= 180).select(key, *kept, box.alias("b"))
        first = first.withColumn("home", _level(F.col("b"), levels))
        each = F.flatten(F.array(*(F.when(F.col("home") <= v, _level_cells(F.col("b"), widen, v)).otherwise(F.array().cast("array<struct<level:int,x:bigint,y:bigint>>")) for v in levels)))
        listed = first.withColumn("cells", each)
        # Where a side has one cell on each level a pair meets once in any case.
        own = F.when(F.size("cells") > sum(F.when(F.col("home") <= v, 1).otherwise(0) for v in levels), F.col("cells"))
        return listed.select(key, *(f"{name}g" for _ in kept), F.col("b").alias(f"b{name}"), F.col("home").alias(f"h{name}"), own.alias(f"c{name}"), F.explode("cells").alias("c")).select("*", "c.*").drop("c")

    joined = placed(left, left_key, widen_m, "l").join(placed(right, right_key, 0.0, "r"), ["level", "x", "y"]).where(F.col("level") == F.greatest("hl", "hr"))
    dy = widen_m / _M_PER_DEGREE
    dx = F.lit(widen_m / 111320.0) / F.cos(F.radians(F.least(F.greatest(F.abs(F.col("bl.south")), F.abs(F.col("bl.north"))) + dy, F.lit(89.0))))
    near = (F.col("bl.south") - dy <= F.col("br.north")) & (F.col("br.south") <= F.col("bl.north") + dy)
    # The two boxes may lie on both sides of the antimeridian.
    gap = lambda shift: (F.col("bl.west") - dx <= F.col("br.east") + shift) & (F.col("br.west") + shift <= F.col("bl.east") + dx)
    here = F.struct(F.col("level").alias("level"), F.col("x").alias("x"), F.col("y").alias("y"))
    shared = F.array_min(F.filter(F.array_intersect("cl", "cr"), lambda c: c["level"] == F.col("level")))
    once = F.when(F.col("cl").isNotNull() & F.col("cr").isNotNull(), shared == here).otherwise(F.lit(True))
    return joined.where(near & (gap(0) | gap(360) | gap(-360)) & once).select(left_key, right_key, *(("lg", "rg") if carry else ()))


def _with_geometries(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    a = left.select(left_key, F.col("geometry").alias("lg"))
    b = right.select(right_key, F.col("geometry").alias("rg"))
    return pairs.join(a, left_key).join(b, right_key)


def point_metres(p: Column | tuple[Column, Column], q: Column | tuple[Column, Column]) -> Column:
    """G8 of two positions: distance in the local frame of their mean latitude, as in the kernels."""
    e2 = kernels.ECCENTRICITY2
    lat = F.radians((p[1] + q[1]) / 2)
    w = 1 - F.lit(e2) * F.sin(lat) * F.sin(lat)
    kx = F.lit(math.radians(1) * kernels.SEMI_MAJOR_M) / F.sqrt(w) * F.cos(lat)
    ky = F.lit(math.radians(1) * kernels.SEMI_MAJOR_M * (1 - e2)) / F.pow(w, F.lit(1.5))
    dx, dy = (p[0] - q[0]) * kx, (p[1] - q[1]) * ky
    return F.sqrt(dx * dx + dy * dy)


def _none(df: DataFrame) -> bool:
    """Whether the plan alone tells that there are no rows, as where every geometry is made as a point."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() == 0


def _spots(df: DataFrame, x: str, y: str, *keep: str) -> DataFrame:
    """Positions of points as two columns; placeholders are left out."""
    p = F.col("geometry.parts")[0][0]
    return df.where(F.col("geometry.type") == "Point").select(*keep, p[0].alias(x), p[1].alias(y)).where(F.col(x) <= 180)


def _measured(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Rows of left (__lx, __ly, ...) and right (__rx, __ry, ...) at most so far apart, with metres.

    Cells are as high as the distance is far, and a whole number of them goes round each row. A right position
    is in one cell and a left one in all that its reach meets, so each pair is found once.
    """
    dy = metres / _M_PER_DEGREE
    size = max(CELL, dy)
    around = lambda row: F.greatest(F.floor(F.lit(360.0) * F.cos(F.radians(F.least(F.abs(row * size), F.lit(89.0)))) / size), F.lit(1))
    at = lambda x: F.floor((x + 180) * F.col("__n") / 360)
    far = F.abs("__ly") + dy
    dx = F.when(far < 89.9, F.lit(metres / _M_PER_DEGREE_EAST) / F.cos(F.radians(far))).otherwise(F.lit(360.0))
    rows = left.withColumn("__dx", dx).withColumn("__row", F.explode(F.sequence(F.floor((F.col("__ly") - dy) / size), F.floor((F.col("__ly") + dy) / size)))).withColumn("__n", around(F.col("__row")))
    first, last = at(F.col("__lx") - F.col("__dx")), at(F.col("__lx") + F.col("__dx"))
    cells = rows.withColumn("__c", F.explode(F.sequence(first, F.least(last, first + F.col("__n") - 1)))).withColumn("__c", F.pmod("__c", "__n")).drop("__dx", "__n")
    own = right.withColumn("__row", F.floor(F.col("__ry") / size)).withColumn("__n", around(F.col("__row"))).withColumn("__c", F.pmod(at(F.col("__rx")), F.col("__n"))).drop("__n")
    together = cells.join(own, ["__row", "__c"]).where(F.abs(F.col("__ly") - F.col("__ry")) <= dy).drop("__row", "__c")
    measured = point_metres((F.col("__lx"), F.col("__ly")), (F.col("__rx"), F.col("__ry")))
    return together.withColumn("metres", measured).where(F.col("metres") <= metres)


def within_distance(left: DataFrame, right: DataFrame, metres: float, left_key: str = "lkey", right_key: str = "rkey", decimals: int | None = None) -> DataFrame:
    """(left_key, right_key, metres) of pairs at most so far apart; found distances may be rounded.

    Two points are measured natively, each position of the left side once, whatever number of rows
    lies there; only pairs with another shape are found for the kernel.
    """
    said = F.col("metres") if decimals is None else F.round("metres", decimals).alias("metres")
    point = F.col("geometry.type") == "Point"
    here = _spots(left, "__lx", "__ly", left_key)
    pairs = _measured(here.select("__lx", "__ly").distinct(), _spots(right, "__rx", "__ry", right_key), metres).select("__lx", "__ly", right_key, said)
    # Few rows may make very many pairs here, so neither side is broadcast.
    out = here.join(pairs.hint("merge"), ["__lx", "__ly"]).select(left_key, right_key, "metres")
    for a, b in ((left.where(point), right.where(~point)), (left.where(~point), right)):
        if not (_none(a) or _none(b)):
            met = candidates(a, b, metres, left_key, right_key, carry=True).withColumn("metres", kernels.distance(F.col("lg"), F.col("rg")))
            out = out.union(met.where(F.col("metres") <= metres).select(left_key, right_key, said))
    return out


def contained(areas: DataFrame, objects: DataFrame, left_key: str = "lkey", right_key: str = "rkey", buffer_m: float = 0.0) -> DataFrame:
    """(area, object) where the polygon, maybe widened, covers the object."""
    polygons = materialize(areas.where(geo.is_polygon(F.col("geometry"))), "polygons")
    pairs = _with_geometries(candidates(polygons, objects, buffer_m, left_key, right_key), polygons, objects, left_key, right_key)
    inside = kernels.covers(F.col("lg"), F.col("rg"))
    if not buffer_m:
        return pairs.where(inside).select(left_key, right_key)
    # With a buffer all positions have to be within it.
    pts = F.transform(geo.positions(F.col("rg")), lambda p: F.struct(F.lit("Point").alias("type"), F.array(F.array(p)).alias("parts"), F.array(F.lit(0)).alias("poly")))
    each = pairs.select(left_key, right_key, "lg", F.explode(pts).alias("p"))
    far = each.withColumn("metres", kernels.distance(F.col("lg"), F.col("p"))).groupBy(left_key, right_key).agg(F.max("metres").alias("metres"))
    return far.where(F.col("metres") <= buffer_m).select(left_key, right_key)


def intersecting(left: DataFrame, right: DataFrame, left_key: str = "lkey", right_key: str = "rkey") -> DataFrame:
    """J5."""
    pairs = _with_geometries(candidates(left, right, 0.0, left_key, right_key), left, right, left_key, right_key)
    return pairs.where(kernels.meets(F.col("lg"), F.col("rg"))).select(left_key, right_key)


def _nearest_spots(points: DataFrame, others: DataFrame, metres: float, left_key: str, right_key: str) -> DataFrame:
    """J9 of points alone: rows at one position share a neighbour, and of those at another the least key counts."""
    here = _spots(points, "__lx", "__ly", left_key)
    there = materialize(_spots(others, "__rx", "__ry", right_key).groupBy("__rx", "__ry").agg(F.min(right_key).alias("__k")), "targets")
    left, rings = materialize(here.select("__lx", "__ly").distinct(), "not-yet"), []
    reach = metres
    while reach > RINGS_FROM_M:
        reach /= RING
    while True:
        near = _measured(left, there, min(reach, metres))
        best = near.groupBy("__lx", "__ly").agg(F.min(F.struct(F.round("metres", 6).alias("m"), F.col("__k").alias("k"), "metres")).alias("b"))
        if reach >= metres:
            rings.append(best)
            break
        # What lies within rounding of a ring's edge is left to the next one, so that ties are seen whole.
        found = materialize(best.where(F.col("b.metres") < reach - 1e-5), "nearest")
        rings.append(found)
        following = materialize(left.join(found.select("__lx", "__ly"), ["__lx", "__ly"], "left_anti"), "not-yet")
        discard(left)
        left, reach = following, reach * RING
        if left.isEmpty():
            break
    spots = functools.reduce(DataFrame.union, rings)
    # A key that is at several positions has the nearest neighbour of all.
    of_key = here.join(spots, ["__lx", "__ly"]).groupBy(left_key).agg(F.min("b").alias("b"))
    return of_key.select(left_key, F.col("b.k").alias(right_key), F.col("b.metres").alias("metres"))


def nearest(points: DataFrame, lines: DataFrame, metres: float, prefer: Column | None = None, left_key: str = "lkey", right_key: str = "rkey") -> DataFrame:
    """For each point the nearest line within a distance; ties go to preferred, then to lower keys.

    A large distance is searched in rings from near to far: who has found a neighbour is done. Where
    both sides are made as points, positions are searched instead of rows.
    """
    other = F.col("geometry.type") != "Point"
    if prefer is None and _none(points.where(other)) and _none(lines.where(other)):
        return _nearest_spots(points, lines, metres, left_key, right_key)
    own = [c for c in points.columns if c not in (left_key, "geometry")], [c for c in lines.columns if c not in (right_key, "geometry")]

    def within(some: DataFrame, reach: float) -> DataFrame:
        found = within_distance(some, lines, reach, left_key, right_key)
        if prefer is not None:
            found = found.join(points.select(left_key, *own[0]), left_key).join(lines.select(right_key, *own[1]), right_key).withColumn("__p", F.when(prefer, 0).otherwise(1))
        else:
            found = found.withColumn("__p", F.lit(0))
        best = found.groupBy(left_key).agg(F.min(F.struct(F.round("metres", 6).alias("m"), "__p", F.col(right_key).alias("k"), "metres")).alias("b"))
        return best.select(left_key, F.col("b.k").alias(right_key), F.col("b.metres").alias("metres"))

    reach = metres
    while reach > RINGS_FROM_M:
        reach /= RING
    out, left = None, points
    while reach < metres:
        # What lies within rounding of a ring's edge is left to the next one, so that ties are seen whole.
        found = materialize(within(left, reach).where(F.col("metres") < reach * (1 - 1e-9)), "nearest")
        out = found if out is None else out.union(found)
        following = materialize(left.join(found.select(left_key), left_key, "left_anti"), "not-yet")
        if left is not points:
            discard(left)
        left, reach = following, reach * RING
    last = within(left, metres)
    return last if out is None else out.union(last)


def nearest_rank(points: DataFrame, others: DataFrame, k: int, metres: float, left_key: str = "lkey", right_key: str = "rkey") -> DataFrame:
    """The k nearest within a distance, ranked."""
    order = W.partitionBy(left_key).orderBy("metres", right_key)
    return within_distance(points, others, metres, left_key, right_key).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def degrees_for(metres: float, lat: float) -> float:
    """Degrees of longitude that so many metres span at a latitude."""
    return metres / (111320.0 * math.cos(math.radians(min(abs(lat), 89.0))))
