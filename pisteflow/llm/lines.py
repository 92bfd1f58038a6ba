"""Line deduplication over levelled sorted runs (operator 3).

A LineStore keeps runs of (line hash, documents it was found in), each bucketed and sorted by
hash, on levels. A batch of documents is reduced to its own hashes and counts, merge-anti-joined
with the runs (hashes that a run has already settled are dropped) and added as a run of level 0.
When a level has FANOUT runs they are merged into one run of the next level, summing counts. Runs
are bucketed alike with one sorted file a bucket, and are read in that order, so that merges neither
shuffle nor sort what is stored.

Defined results: null or empty text is one empty line, and lines without a key never go; long
texts are split whole; a line counts once a document however often it recurs there; repeated rows
count as documents of their own; an empty table gives an empty table; extra columns of any name pass
through and input columns named like an output column are replaced. Keys are compared by 128-bit hash.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pisteflow.llm.columns import shielded
from pisteflow.plans.lineage import discard, materialize, shared_dir

WHITE_CHARS = " \t\n\x0b\x0c\r"
#: Runs on a level before they are merged into the next.
FANOUT = 2
#: Up to so many settled hashes (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_HASHES = 500_000
OUTPUTS = ("n_lines", "n_dropped", "kept_text")
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.trim(line, F.lit(WHITE_CHARS))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(3), key).alias("h2"))


def document_counts(df: DataFrame, text_col: str, *groups: Column) -> DataFrame:
    """(groups, h1, h2, n): in how many rows of df each non-empty line key is found."""
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col(text_col)), line_key), lambda k: k != ""))
    one = df.select(*groups, F.explode(keys).alias("key"))
    names = [c for c in one.columns if c != "key"]
    return one.select(*names, _hashes(F.col("key")).alias("h")).groupBy(*names, "h.h1", "h.h2").agg(F.count("*").alias("n"))


@contextmanager
def _stored_order(spark: SparkSession) -> Iterator[None]:
    """Bucketed scans of one file a bucket are taken to be sorted as they were written."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LineStore:
    """Levels of runs in the shared folder; counts of a hash add up over all runs."""

    def __init__(self, spark: SparkSession, settled_at: int, buckets: int):
        self.spark, self.settled_at, self.buckets = spark, settled_at, buckets
        self.path = f"{shared_dir(spark)}/pisteflow/lines-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []

    def _write(self, counts: DataFrame) -> str:
        name = f"run_{uuid.uuid4().hex}"
        with _stored_order(self.spark):
            dealt = counts.select(*HASH, "n").repartition(self.buckets, *HASH)
            dealt.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.path}/{name}").saveAsTable(name)
        return name

    def _drop(self, run: str) -> None:
        """The table, and its files, which an external table would leave."""
        self.spark.sql(f"DROP TABLE {run}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self) -> None:
        """All runs."""
        for run in (r for level in self.levels for r in level):
            self._drop(run)
        self.levels = []

    def add(self, counts: DataFrame) -> None:
        """Add a batch: (h1, h2, n) with one row a hash."""
        for run in (r for level in self.levels for r in level):
            settled = self.spark.table(run).where(F.col("n") >= self.settled_at)
            counts = counts.join(settled, HASH, "left_anti")
        self._put(0, self._write(counts))
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= FANOUT:
                self._merge(k)

    def _put(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _merge(self, level: int) -> None:
        runs, self.levels[level] = self.levels[level], []
        merged = self.spark.table(runs[0])
        for run in runs[1:]:
            other = self.spark.table(run).withColumnRenamed("n", "m")
            merged = merged.join(other, HASH, "full").select(*HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        self._put(level + 1, self._write(merged))
        for run in runs:
            self._drop(run)

    def compact(self) -> DataFrame:
        """All counts as one run."""
        runs = [r for level in self.levels for r in level]
        if len(runs) > 1:
            self.levels = [runs]
            self._merge(0)
            runs = self.levels[1]
        return self.spark.table(runs[0])


def dedup_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_docs: int = 10, batches: int = 4) -> DataFrame:
    """Every row with n_lines, n_dropped and kept_text: lines found in min_docs rows or more are gone everywhere.

    batches: into how many batches, by hash of the id, rows are dealt before they go to the store.
    """
    spark = df.sparkSession
    base, restored = shielded(df, (text_col, id_col), OUTPUTS)
    dealt = F.pmod(F.xxhash64(id_col), F.lit(batches)).cast("int").alias("batch")
    counts = materialize(document_counts(base, text_col, dealt), "line-counts")
    buckets = max(4, min(4096, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    store = LineStore(spark, min_docs, buckets)
    for k in range(batches):
        store.add(counts.where(F.col("batch") == k).select(*HASH, "n"))
    settled = materialize(store.compact().where(F.col("n") >= min_docs).select(*HASH), "settled")
    store.drop()
    discard(counts)
    settled = F.broadcast(settled) if settled.count() <= BROADCAST_HASHES else settled

    # A row is told by its id and its text's hash, so equal rows are decided once and alike.
    told = {"__id": F.col(id_col), "__text": F.xxhash64(F.coalesce(text_col, F.lit("")))}
    placed = base.select(*(c.alias(n) for n, c in told.items()), F.posexplode(F.transform(_lines(F.col(text_col)), line_key)).alias("at", "key")).where("key <> ''")
    hits = placed.select("__id", "__text", "at", _hashes(F.col("key")).alias("h")).select("__id", "__text", "at", "h.h1", "h.h2").join(settled, HASH, "left_semi")
    gone = hits.groupBy("__id", "__text").agg(F.collect_set("at").alias("__gone")).withColumnsRenamed({"__id": "__gid", "__text": "__gtext"})
    rows = base.withColumns(told)
    joined = rows.join(gone, rows["__id"].eqNullSafe(gone["__gid"]) & (rows["__text"] == gone["__gtext"]), "left")

    def cut(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
        text = F.when(F.col("__gone").isNull(), F.coalesce(text_col, F.lit(""))).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
        return F.struct(F.size(lines).cast("long").alias("n_lines"), text.alias("kept_text"))

    made = joined.withColumn("__made", F.transform(F.array(_lines(F.col(text_col))), cut)[0])
    return restored(made.select(*base.columns, "__made.n_lines", F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"), "__made.kept_text"))
