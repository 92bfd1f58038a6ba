"""Streaming variants: caches fed from a stream, and event-time statistics with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pisteflow.sources.cache import Cache


def windowed(df: DataFrame, ts: str, keys: list[str], width: str, late: str, *metrics: Column) -> DataFrame:
    """Sums by key and event-time window; rows later than the watermark are dropped."""
    return df.withWatermark(ts, late).groupBy(*keys, F.window(ts, width)).agg(*(metrics or (F.count("*").alias("n"),)))


def first_seen(df: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """Each key once within the watermark, as the first row that has it."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def into_cache(df: DataFrame, cache: Cache, now_ms: Callable[[], int], checkpoint: str) -> StreamingQuery:
    """K13 on a stream: every batch of key and value is upserted; a batch taken twice changes nothing."""
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: cache.set_many(batch, now_ms())).start()
