"""Satellite snow cover (V1-V27, S31-S32, A6, A19): weekly pixel series to daily histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions.jsnum import js_round
from pisteflow.operators.kernels import pixels

#: No measurement of an old or of a recent week, and any other failure.
MISSING_OLD, MISSING_RECENT, FAILED = 301, 400, 401
OLD_DAYS, WEEKS = 30, 53
SERIES = "tile string, row int, col int, data array<struct<year:int,data:array<array<int>>>>"


def is_valid(value: Column) -> Column:
    """V9."""
    return value.between(0, 100)


def week_date(year: Column, week: Column, persistence: Column) -> Column:
    """V6: the day measured: week 1 begins on January 1, less the days that clouds persisted."""
    known = week.between(1, WEEKS) & persistence.between(0, 365)
    return F.when(known, F.date_add(F.make_date(year, F.lit(1), F.lit(1)), ((week - 1) * 7 - persistence).cast("int")))


def week_index(date: Column) -> Column:
    """Weeks since January 1, from 0."""
    return F.floor((F.dayofyear(date) - 1) / 7).cast("int")


def weekly_dates(start: Column, end: Column) -> Column:
    """V14."""
    return F.sequence(start, end, F.expr("interval 7 days"))


def long_form(series: DataFrame) -> DataFrame:
    """(tile, row, col, year, week, snow, persistence) of nested weekly series; week from 1."""
    years = series.select("tile", "row", "col", F.explode("data").alias("y"))
    weeks = years.select("tile", "row", "col", F.col("y.year").alias("year"), F.posexplode("y.data").alias("i", "w"))
    return weeks.select("tile", "row", "col", "year", (F.col("i") + 1).alias("week"), F.get("w", 0).alias("snow"), F.coalesce(F.get("w", 1), F.lit(0)).alias("persistence"))


def pixel_days(weeks: DataFrame) -> DataFrame:
    """V7: (tile, row, col, year, day, snow): of a day's measurements that of least persistence.

    Ties keep the earlier week. Values above 100 are no measurement.
    """
    dated = weeks.where(is_valid(F.col("snow"))).withColumn("date", week_date(F.col("year"), F.col("week"), F.col("persistence"))).where("date is not null")
    best = dated.groupBy("tile", "row", "col", "date").agg(F.min_by("snow", F.struct("persistence", "year", "week")).alias("snow"))
    return best.select("tile", "row", "col", F.year("date").alias("year"), F.dayofyear("date").alias("day"), "snow")


def history(area_pixels: DataFrame, days: DataFrame, by: list[str]) -> DataFrame:
    """V8: (by, year, day, snow, valid_percent): mean snow of an area's pixels on a day.

    valid_percent: of the area's pixels with any measurement, the share that has one on the day.
    """
    seen = area_pixels.join(days, ["tile", "row", "col"]).where(F.col("year").between(1900, 2100))
    total = seen.select(*by, "tile", "row", "col").distinct().groupBy(*by).agg(F.count("*").alias("pixels"))
    per = seen.groupBy(*by, "year", "day").agg(F.avg("snow").alias("mean"), F.count("*").alias("n"))
    return per.join(total, by).select(*by, "year", "day", js_round(F.col("mean")).cast("int").alias("snow"), js_round(F.col("n") * 100 / F.col("pixels")).cast("int").alias("valid_percent"))


def nested_history(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, history): years in order, each with its days array<array<int>>."""
    years = rows.groupBy(*by, "year").agg(F.transform(F.array_sort(F.collect_list(F.struct("day", "snow", "valid_percent"))), lambda d: F.array(d["day"], d["snow"], d["valid_percent"])).alias("days"))
    return years.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("year", "days"))).alias("history"))


def run_pixels(runs: DataFrame, key: str = "id") -> DataFrame:
    """(key, tile, row, col) of the pixels that runs meet."""
    return runs.select(key, F.explode(pixels(F.col("geometry"))).alias("p")).select(key, "p.*").distinct()


def area_statistics(members: DataFrame, run_px: DataFrame, days: DataFrame) -> DataFrame:
    """Histories of each area, overall (activity null) and by activity (none: other).

    members: (ski_area, key, activities) of runs.
    """
    kinds = F.when(F.size("activities") > 0, F.col("activities")).otherwise(F.array(F.lit("other")))
    each = members.select("ski_area", "key", F.explode(F.concat(F.array(F.lit("overall")), kinds)).alias("activity"))
    area = each.join(run_px.withColumnRenamed("id", "key") if "id" in run_px.columns else run_px, "key").select("ski_area", "activity", "tile", "row", "col").distinct()
    return history(area, days, ["ski_area", "activity"])


def missing_weeks(wanted: DataFrame, have: DataFrame, start: str, end: str) -> DataFrame:
    """(tile, row, col, date) of weekly dates without a value.

    The dates step by seven days from the start, also across a year's end.
    """
    dates = F.explode(weekly_dates(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("date")
    asked = wanted.select("tile", "row", "col", dates).withColumns({"year": F.year("date"), "week": week_index(F.col("date")) + 1})
    known = have.where("snow is not null").select("tile", "row", "col", "year", "week")
    return asked.join(known, ["tile", "row", "col", "year", "week"], "left_anti").select("tile", "row", "col", "date")


def missing_summary(missing: DataFrame) -> DataFrame:
    """(tiles, pixels, missing_weeks)."""
    return missing.agg(F.countDistinct("tile").alias("tiles"), F.countDistinct("tile", "row", "col").alias("pixels"), F.count("*").alias("missing_weeks"))


def extract(raster: DataFrame, asked: DataFrame, today: str) -> DataFrame:
    """(tile, row, col, date, snow, persistence) of asked pixels from raster rows.

    Dates without a raster get a code by their age; pixels out of a raster's bounds are null.
    """
    there = raster.select("tile", "date").distinct().withColumn("there", F.lit(True))
    values = raster.select("tile", "row", "col", "date", F.col("value").alias("snow"), F.coalesce("persistence", F.lit(0)).alias("persistence"))
    joined = asked.join(there, ["tile", "date"], "left").join(values, ["tile", "row", "col", "date"], "left")
    old = F.datediff(F.to_date(F.lit(today)), "date") > OLD_DAYS
    code = F.when(F.col("there").isNull(), F.when(old, MISSING_OLD).otherwise(MISSING_RECENT)).otherwise(F.col("snow"))
    return joined.select("tile", "row", "col", "date", code.cast("int").alias("snow"), F.coalesce("persistence", F.lit(0)).alias("persistence"))


def to_series(weeks: DataFrame) -> DataFrame:
    """Nested series of long rows; weeks without a row are [null, 0]."""
    per = weeks.groupBy("tile", "row", "col", "year").agg(F.map_from_entries(F.collect_list(F.struct("week", F.array("snow", "persistence")))).alias("m"))
    data = F.transform(F.sequence(F.lit(1), F.lit(WEEKS)), lambda w: F.coalesce(F.try_element_at("m", w), F.array(F.lit(None).cast("int"), F.lit(0))))
    years = per.select("tile", "row", "col", F.struct("year", data.alias("data")).alias("y"))
    return years.groupBy("tile", "row", "col").agg(F.array_sort(F.collect_list("y")).alias("data"))


def upsert_weeks(base: DataFrame, new: DataFrame) -> DataFrame:
    """New weeks replace stored ones."""
    from pisteflow.operators.relational import upsert

    return upsert(base, new, ["tile", "row", "col", "year", "week"])


def existing_pixels(series: DataFrame) -> DataFrame:
    """V26."""
    return series.select("tile", "row", "col").distinct()


def without_codes(weeks: DataFrame) -> DataFrame:
    """Codes of weeks that may still come are dropped, so that they are asked for again."""
    return weeks.where(F.col("snow").isNull() | ~F.col("snow").isin(MISSING_RECENT, FAILED))


def file_pattern(tile: Column, date: Column) -> Column:
    """S31."""
    return F.format_string("VNP10A1F.A%04d%03d.%s", F.year(date), F.dayofyear(date), tile)


def needed(policy: str, wanted: DataFrame, series: DataFrame) -> DataFrame:
    """Pixels to fetch: none, those stored already, or all wanted."""
    if policy == "none":
        return wanted.limit(0)
    return existing_pixels(series) if policy == "incremental" else wanted
