"""Exact deduplication (operator 4), in DataFrame functions only.

Pass 1 counts cells of a blocked Bloom filter: a text's hash picks a 64-bit word and three of its
bits, and the cells hit twice or more are or-ed into words. What it shuffles are a cell's two numbers,
16 bytes a row: filters of single tasks would be more, as each is as large as the whole filter.
Pass 2 probes the words, which are broadcast in blocks: a row whose three bits are all set may be
repeated, and only such rows shuffle to be grouped by the digest of their normalised text. All other
rows pass straight through.

The filter has a word for four rows, up to FILTER_WORDS. Beyond four times as many rows it fills up
and more rows shuffle in vain, all of them at worst; the plan and the result stay the same.

Defined results: null text counts as empty; long texts are digested whole; of equal texts the one
with the most code points stays, then the smallest id (null ids last), then the first row read, so
one of wholly repeated rows stays; an empty table gives an empty table; extra columns of
any name pass through and input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.llm.columns import shielded
from pisteflow.plans.lineage import materialize

#: Words of the filter at most: 8 bytes each, so 128 MB are broadcast at most. BLOCK of them are one row.
FILTER_WORDS, BLOCK = 1 << 24, 256
WHITE = r"[\x20\x09-\x0D]+"
OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def _cell(df: DataFrame, n_words: int) -> DataFrame:
    """Adds the word and the bits of it that the hash column __h picks."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("__h", 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return df.withColumns(
        {
            "__word": F.shiftrightunsigned("__h", 20).bitwiseAND(F.lit(n_words - 1)),
            "__bits": bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)),
        }
    )


def _filter(hashes: DataFrame, n_words: int) -> DataFrame:
    """(block, words): all words of the filter of what is possibly repeated; hashes: column __h."""
    twice = _cell(hashes, n_words).groupBy("__word", "__bits").agg(F.count("*").alias("n")).where("n > 1")
    none = hashes.sparkSession.range(n_words).select(F.col("id").alias("__word"), F.lit(0).cast("long").alias("__bits"))
    words = twice.select("__word", "__bits").union(none).groupBy("__word").agg(F.expr("bit_or(__bits)").alias("__set"))
    block = F.shiftrightunsigned("__word", BLOCK.bit_length() - 1).alias("__block")
    listed = words.groupBy(block).agg(F.array_sort(F.collect_list(F.struct("__word", "__set"))).alias("w"))
    return listed.select("__block", F.transform("w", lambda x: x["__set"]).alias("__words"))


def exact_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", rows: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Every row, with keep_id, group_size, kept and text_sha256.

    rows: about how many rows there are, to size the filter (counted when not given). keep: input
    columns to carry (all by default).
    """
    inner, _ = shielded(df, (text_col, id_col), OUTPUTS)
    given = dict(zip((c for c in df.columns if c not in OUTPUTS), inner.columns, strict=True))
    carried = {c: s for c, s in given.items() if keep is None or c in keep}
    columns = list(carried.values())
    rows = df.count() if rows is None else rows
    n_words = min(FILTER_WORDS, 1 << max(10, (max(rows, 1) // 4).bit_length()))
    plain = normalised(F.col(text_col))
    words = materialize(_filter(inner.select(F.xxhash64(plain).alias("__h")), n_words), "words")

    own = [F.xxhash64(plain).alias("__h"), F.sha2(plain, 256).alias("text_sha256"), F.length(F.coalesce(text_col, F.lit(""))).alias("__length"), F.col(id_col).alias("__id")]
    seen = _cell(inner.select(*columns, *own), n_words).withColumn("__block", F.shiftrightunsigned("__word", BLOCK.bit_length() - 1))
    set_bits = F.get("__words", F.col("__word").bitwiseAND(F.lit(BLOCK - 1)).cast("int"))
    probed = seen.join(F.broadcast(words), "__block").withColumn("__maybe", set_bits.bitwiseAND(F.col("__bits")) == F.col("__bits")).drop("__words")

    alone = probed.where(~F.col("__maybe")).select(*columns, F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    # Written out, possible repeats have row numbers that stay, and groups are a plain side of the
    # join, so that one large group's rows can be split.
    numbered = probed.where("__maybe").select(*columns, "__id", "__length", "text_sha256", F.monotonically_increasing_id().alias("__row"))
    candidates = materialize(numbered, "candidates")
    order = F.struct((-F.col("__length")).alias("l"), F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col("__row").alias("r"))
    groups = materialize(candidates.groupBy("text_sha256").agg(F.min(order).alias("__keep"), F.count("*").alias("group_size")), "groups")
    decided = candidates.join(groups, "text_sha256").select(*columns, F.col("__keep.i").alias("keep_id"), "group_size", (F.col("__keep.r") == F.col("__row")).alias("kept"), "text_sha256")
    both = alone.union(decided)
    return both.select(*(F.col(s).alias(c) for c, s in carried.items()), *OUTPUTS)
