"""Nested statistics of ski areas (A1-A6, A20), as grouped aggregates over exploded memberships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions import geo, reduce


def object_stats(objects: DataFrame) -> DataFrame:
    """A4: distance_km, change, lowest and highest elevation; only 3-D lines have elevations.

    Zero elevations count as missing, as they do in every reducer here.
    """
    z = F.transform(geo.positions(F.col("geometry")), geo.elevation)
    three = (F.col("geometry.type") == "LineString") & F.forall(z, lambda v: v.isNotNull())
    staged = objects.withColumn("__z", F.when(three, z))
    return staged.withColumns(
        {
            "distance_km": geo.length_km(F.col("geometry")),
            "change": F.element_at("__z", -1) - F.element_at("__z", 1),
            "lowest": reduce.nonzero(F.array_min("__z")),
            "highest": reduce.nonzero(F.array_max("__z")),
        }
    ).drop("__z")


def _sums() -> list[Column]:
    """A5."""
    return [
        F.count("*").alias("count"),
        F.sum("distance_km").alias("lengthInKm"),
        F.min("lowest").alias("minElevation"),
        F.max("highest").alias("maxElevation"),
        F.sum(F.abs(reduce.nonzero(F.col("change")))).alias("combinedElevationChange"),
    ]


def is_run(kind: Column) -> Column:
    """A21."""
    return kind == "run"


def is_lift(kind: Column) -> Column:
    """A21."""
    return kind == "lift"


def run_statistics(runs: DataFrame) -> DataFrame:
    """A2: (ski_area, activity, difficulty, sums); polygons are left out, a run counts in each activity.

    runs: ski_area, geometry, activities, difficulty, snowmaking and snowfarming.
    """
    lines = object_stats(runs.where(F.col("geometry.type") != "Polygon"))
    each = lines.select("ski_area", F.explode(F.filter("activities", lambda a: a.isin("downhill", "nordic"))).alias("activity"), F.coalesce("difficulty", F.lit("other")).alias("difficulty"), "distance_km", "change", "lowest", "highest", "snowmaking", "snowfarming")
    snow = [F.sum(F.when(F.col(c), F.col("distance_km")).otherwise(0.0)).alias(f"{c}LengthInKm") for c in ("snowmaking", "snowfarming")]
    return each.groupBy("ski_area", "activity", "difficulty").agg(*_sums(), *snow)


def lift_statistics(lifts: DataFrame) -> DataFrame:
    """A3: (ski_area, lift_type, sums)."""
    return object_stats(lifts).groupBy("ski_area", F.coalesce("lift_type", F.lit("other")).alias("lift_type")).agg(*_sums())


def ski_area_statistics(members: DataFrame) -> DataFrame:
    """A1: (ski_area, statistics) with maps by activity and difficulty, and by lift type.

    members: one row for each object of an area, with ski_area and the object's columns.
    """
    runs, lifts = run_statistics(members.where(is_run(F.col("type")))), lift_statistics(members.where(is_lift(F.col("type"))))
    nested = runs.groupBy("ski_area", "activity").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("difficulty", F.struct("count", "lengthInKm", "snowmakingLengthInKm", "snowfarmingLengthInKm", "minElevation", "maxElevation", "combinedElevationChange"))))).alias("byDifficulty"),
        F.min("minElevation").alias("lo"),
        F.max("maxElevation").alias("hi"),
    )
    of_runs = nested.groupBy("ski_area").agg(F.map_from_entries(F.collect_list(F.struct("activity", F.struct("byDifficulty")))).alias("byActivity"), F.min("lo").alias("runMin"), F.max("hi").alias("runMax"))
    of_lifts = lifts.groupBy("ski_area").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("lift_type", F.struct("count", "lengthInKm", "minElevation", "maxElevation", "combinedElevationChange"))))).alias("byType"),
        F.min("minElevation").alias("liftMin"),
        F.max("maxElevation").alias("liftMax"),
    )
    both = of_runs.join(of_lifts, "ski_area", "full")
    run_side = F.struct("byActivity", F.col("runMin").alias("minElevation"), F.col("runMax").alias("maxElevation"))
    lift_side = F.struct("byType", F.col("liftMin").alias("minElevation"), F.col("liftMax").alias("maxElevation"))
    low, high = reduce.served_min(F.col("runMin"), F.col("liftMin")), reduce.served_max(F.col("runMax"), F.col("liftMax"))
    return both.select("ski_area", F.struct(run_side.alias("runs"), lift_side.alias("lifts"), low.alias("minElevation"), high.alias("maxElevation")).alias("statistics"))
