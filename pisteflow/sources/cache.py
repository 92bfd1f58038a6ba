"""Keyed caches with a time to live, as Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pisteflow.operators.relational import cache_cleanup, lookup, upsert


class Cache:
    """A table of key, value and timestamp under a path; two versions alternate so readers stay valid."""

    def __init__(self, spark: SparkSession, path: str, value_type: str, ttl_ms: int | None = None):
        self.spark, self.path, self.ttl_ms = spark, path.rstrip("/"), ttl_ms
        self.schema = f"key string, value {value_type}, timestamp bigint"

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _current(self) -> str | None:
        for name in ("a", "b"):
            fs, p = self._fs(f"{self.path}/{name}/_SUCCESS")
            if fs.exists(p):
                return name
        return None

    def read(self) -> DataFrame:
        """A stored table of another type raises."""
        current = self._current()
        if current is None:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.parquet(f"{self.path}/{current}")
        empty = self.spark.createDataFrame([], self.schema)
        if stored.schema.simpleString() != empty.schema.simpleString():
            raise TypeError(f"{self.path} holds {stored.schema.simpleString()}")
        return stored

    def _replace(self, df: DataFrame) -> None:
        current = self._current()
        df.write.mode("overwrite").parquet(f"{self.path}/{'b' if current == 'a' else 'a'}")
        if current:
            fs, p = self._fs(f"{self.path}/{current}")
            fs.delete(p, True)

    def get_many(self, df: DataFrame, key: str, now_ms: int) -> DataFrame:
        return lookup(df, self.read(), key, now_ms, self.ttl_ms)

    def set_many(self, entries: DataFrame, now_ms: int) -> None:
        """Of several values of a key one is kept; stored ones are replaced."""
        new = entries.select("key", "value").withColumn("timestamp", F.lit(now_ms).cast("bigint"))
        self._replace(upsert(self.read(), new, ["key"]))

    def cleanup(self, now_ms: int) -> None:
        if self.ttl_ms is not None:
            self._replace(cache_cleanup(self.read(), now_ms, self.ttl_ms))

    def size(self) -> int:
        return self.read().count()

    def clear(self) -> None:
        fs, p = self._fs(self.path)
        fs.delete(p, True)
