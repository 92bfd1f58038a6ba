"""The row algebra (P1-P16) as DataFrame functions; each keeps the plan open to Catalyst."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def map_rows(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """P1."""
    return df.withColumns(columns)


def map_batches(df: DataFrame, f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None, schema: str | None = None) -> DataFrame:
    """A batch function, in order within a partition; none passes rows through."""
    return df if f is None else df.mapInPandas(f, schema or df.schema)


def tap(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Measure rows as they pass."""
    seen = Observation(name)
    return df.observe(seen, *(metrics or (F.count(F.lit(1)).alias("rows"),))), seen


def and_finally(df: DataFrame, f: Callable[[Iterator], None]) -> None:
    """A sink for each partition."""
    df.foreachPartition(f)


def flat_map(df: DataFrame, value: Column, name: str) -> DataFrame:
    """P5: rows whose value isn't null."""
    return df.withColumn(name, value).where(F.col(name).isNotNull())


def flat_map_array(df: DataFrame, values: Column, name: str) -> DataFrame:
    """A row for each value."""
    return df.withColumn(name, F.explode(values))


def keep(df: DataFrame, predicate: Column) -> DataFrame:
    """P7, P13."""
    return df.where(predicate)


def accumulate(df: DataFrame, keys: list[str], f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A fold over each group; there is no fold over everything."""
    if not keys:
        raise ValueError("a fold needs keys to be dealt out by")
    return df.groupBy(*keys).applyInPandas(f, schema)


def pass_through(df: DataFrame) -> DataFrame:
    """P10."""
    return df


def merge(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def local_ids(df: DataFrame, order: list[str] | None = None, name: str = "local_id") -> DataFrame:
    """Unique text ids; consecutive only where an order is asked for, as that takes one task."""
    if order is None:
        return df.withColumn(name, F.monotonically_increasing_id().cast("string"))
    return df.withColumn(name, (F.row_number().over(W.orderBy(*order)) - 1).cast("string"))


def summary(prefix: str = "") -> Column:
    """What a feature says about its ski area."""
    c = lambda n: F.col(f"{prefix}{n}")
    return F.struct(F.struct(c("id").alias("id"), c("name").alias("name"), c("activities").alias("activities"), F.lit("skiArea").alias("type"), c("status").alias("status")).alias("properties"), c("geometry").alias("geometry"))


def object_to_feature(objects: DataFrame) -> DataFrame:
    """Without the columns that clustering keeps."""
    return objects.drop("source", "is_polygon", "is_basis", "in_polygon", "in_site", "viirs_pixels", "station_ids")
