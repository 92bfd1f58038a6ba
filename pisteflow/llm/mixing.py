"""Mixing sources to target weights by weighted fair queueing (operator 9), DataFrame functions only.

A source's documents are shuffled by the md5 of their id. Each of their copies (a document may be
taken twice) gets a virtual finish time: the source's cumulative words, that copy included, over
the source's weight. All copies are then ordered by finish time and the order is cut where the
total budget is reached.

Running sums are spread: ordered rows are dealt to many buckets, bucket sums give each bucket its
offset, and only within a bucket is there a window. A source with a third of all rows is thus as
many tasks as its share needs.

Defined results: null text has size 0; the null source is a source, last in order; a source
without words has target 0; rows with equal id, source and size share one finish time and one
decision, and are one row of the running sums; an empty table gives an empty mix; extra columns of any
name pass through mix(), and an input column finish_time is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pisteflow.llm.columns import shielded
from pisteflow.plans.lineage import materialize

#: Sources are weighted by their place in code point order, in this repeating cycle.
WEIGHTS = (3, 1, 2)
#: Words of the mix, as a share of all words; and how often a document may be taken.
BUDGET, MAX_COPIES = 1.5, 2
#: Rows aimed at in a bucket of a running sum, and buckets whose sums are summed up in one window.
BUCKET_ROWS, SPAN = 2000, 4096
#: Up to so many sources are broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def running_sum(df: DataFrame, groups: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of value over the rows of the group up to this one, its peers included.

    bucket: an integer column that never falls as order grows, within a group.
    """
    # Two levels: a bucket's offset within its span of buckets, and the span's own.
    sums = df.groupBy(*groups, bucket).agg(F.sum(value).alias("__sum")).withColumn("__span", F.floor(F.col(bucket) / SPAN))
    before = lambda part, by: W.partitionBy(*part).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    spans = sums.groupBy(*groups, "__span").agg(F.sum("__sum").alias("__total"))
    spans = spans.select(*groups, "__span", F.coalesce(F.sum("__total").over(before(groups, "__span")), F.lit(0)).alias("__base"))
    inside = F.coalesce(F.sum("__sum").over(before([*groups, "__span"], bucket)), F.lit(0)).alias("__inside")
    offsets = sums.select(*groups, bucket, "__span", inside).join(spans, [*groups, "__span"]).select(*groups, bucket, (F.col("__inside") + F.col("__base")).alias("__offset"))
    within = W.partitionBy(*groups, bucket).orderBy(*order).rangeBetween(W.unboundedPreceding, W.currentRow)
    if len(order) > 1:
        within = W.partitionBy(*groups, bucket).orderBy(F.struct(*order)).rangeBetween(W.unboundedPreceding, W.currentRow)
    inner = df.withColumn(out, F.sum(value).over(within))
    return inner.join(offsets, [*groups, bucket]).withColumn(out, F.col(out) + F.col("__offset")).drop("__offset")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row a source: place, source, weight, source_size, target, level and budget.

    The level is the virtual time at which the targets add up to the budget: a source has reached
    weight x time by then, or MAX_COPIES times its size. Sorted by when each source runs out, the
    level is the first time that its own source doesn't run out before.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*map(F.lit, WEIGHTS))
    per = per.withColumn("place", place).withColumn("weight", F.get(cycle, F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS)))))
    per = per.withColumn("__most", F.col("source_size") * MAX_COPIES).withColumn("__out", F.col("__most") / F.col("weight"))
    order = W.orderBy("__out", "place")
    everything = W.partitionBy(F.lit(0))
    per = per.withColumns(
        {
            "__done": F.coalesce(F.sum("__most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "__open": F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)),
            "budget": F.sum("source_size").over(everything) * BUDGET,
        }
    ).withColumn("__time", (F.col("budget") - F.col("__done")) / F.col("__open"))
    level = F.coalesce(F.min(F.when(F.col("__time") <= F.col("__out"), F.struct("__out", "place", "__time"))).over(everything)["__time"], F.max("__out").over(everything))
    per = per.withColumn("level", level).withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("__most").cast("double")))
    return per.select("place", "source", "weight", "source_size", "target", "level", "budget")


def decisions(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row a document: id, source, size, source_size, target, copies, taken and finish_times.

    finish_times lists the virtual finish times of the copies taken.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = materialize(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")), "sizes")
    # Rows alike in id, source and size are one from here on, so many null ids are no hot key.
    alike = materialize(sizes.groupBy("id", "source", "size").agg(F.sum("size").alias("words")), "alike")
    rows = alike.count()
    per = materialize(source_targets(sizes), "sources")
    n_sources = per.count()
    sources = F.broadcast(per) if n_sources <= BROADCAST_SOURCES else per

    n_buckets = max(1, rows // BUCKET_ROWS)
    shuffled = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    known = alike.join(sources, alike["source"].eqNullSafe(per["source"])).select(alike["id"], alike["source"], "size", "words", "source_size", "target", "place", "weight", "level", "budget", shuffled.alias("__key"))
    known = known.withColumn("__bucket", (F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * n_buckets / (1 << 32)).cast("int"))
    summed = running_sum(known, ["place"], "__bucket", ["__key", "id", "size"], "words", "__upto")

    copies = summed.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(MAX_COPIES - 1))))
    finish = (F.col("__upto") + F.col("__copy") * F.col("source_size")) / F.col("weight")
    # Copies that finish later than any that the level cuts through can't be reached by the budget.
    reach = per.select(F.max("level").alias("l")).first()["l"] or 0.0
    largest = sizes.agg(F.max("size").alias("m")).first()["m"] or 0
    last = reach + largest / min(WEIGHTS)
    timed = copies.withColumn("finish_time", finish).where(F.col("finish_time") <= last)
    n_slices = max(1, 2 * rows // BUCKET_ROWS)
    timed = timed.withColumn("__slice", F.floor(F.col("finish_time") * (n_slices / last if last else 0.0)).cast("int"))
    ordered = running_sum(timed, [], "__slice", ["finish_time", "place", "__copy", "__key", "id", "size"], "words", "__total")
    kept = ordered.where(F.col("__total") <= F.col("budget"))
    chosen = kept.groupBy("id", "source", "size").agg(F.array_sort(F.collect_set("finish_time")).alias("finish_times"))
    left = sizes.join(sources, sizes["source"].eqNullSafe(per["source"])).select(sizes["id"], sizes["source"], "size", "source_size", "target")
    same = left["id"].eqNullSafe(chosen["id"]) & left["source"].eqNullSafe(chosen["source"]) & (left["size"] == chosen["size"])
    n = F.coalesce(F.size("finish_times"), F.lit(0)).cast("long")
    return left.join(chosen, same, "left").select(left["id"].alias(id_col), left["source"].alias(source_col), left["size"], "source_size", "target", F.when(F.col("finish_times").isNull(), 0).otherwise(n).cast("long").alias("copies"), F.coalesce("finish_times", F.array().cast("array<double>")).alias("finish_times")).withColumn("taken", F.col("size") * F.col("copies"))


def mix(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", partitions: int | None = None) -> DataFrame:
    """The mixed documents, repeats included, with finish_time, range-sorted by it."""
    base, restored = shielded(df, (text_col, id_col, source_col), ("finish_time",))
    chosen = decisions(base, text_col, id_col, source_col).where("copies > 0")
    chosen = chosen.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("size").alias("__size"), F.col("finish_times").alias("__times")).distinct()
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = base.withColumn("__n", size)
    same = sized[id_col].eqNullSafe(chosen["__id"]) & sized[source_col].eqNullSafe(chosen["__source"]) & (F.col("__n") == F.col("__size"))
    taken = sized.join(chosen, same).select(*(base[c] for c in base.columns), F.explode("__times").alias("finish_time"))
    ordered = taken.repartitionByRange(partitions, "finish_time", id_col) if partitions else taken.repartitionByRange("finish_time", id_col)
    return restored(ordered.sortWithinPartitions("finish_time", id_col))
