"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; where that is unset, an own one in local mode.

    On a cluster a folder of this machine would be another one on every executor, so there it raises.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="pisteflow-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write a frame to the shared folder and return a scan of it.

    Unlike an RDD checkpoint this computes the frame once, keeps columns prunable and predicates
    pushable, and a lost executor costs nothing but the task in hand.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pisteflow/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pisteflow_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_pisteflow_path", None)
    if path:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def whole_structs(spark: SparkSession):
    """While tables are written here, struct columns aren't taken apart between operators.

    The optimizer's aliasing of nested fields can lose one of them where a struct is filtered on
    one field and exploded by another.
    """
    keys = ("spark.sql.optimizer.expression.nestedPruning.enabled", "spark.sql.optimizer.nestedSchemaPruning.enabled")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "false")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
