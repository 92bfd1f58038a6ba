"""Sets of row numbers as one bit a row, to pick rows without moving them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pisteflow.plans.lineage import materialize

#: 64-bit words of a block; a block is one row of the broadcast.
WORDS = 256
#: Blocks that are broadcast at most: 256 MB, for 2 ** 31 rows; beyond that rows are joined by shuffle.
BLOCKS = 1 << 17


def _block(row: str):
    return F.shiftrightunsigned(row, 6 + WORDS.bit_length() - 1)


def bits_of(rows: DataFrame) -> DataFrame:
    """(block, words) of the row numbers in column row: a bit for each number of a block."""
    one = rows.select(F.shiftrightunsigned("row", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("row").bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    words = one.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits"))
    slot = F.col("word").bitwiseAND(F.lit(WORDS - 1)).cast("int")
    blocks = words.groupBy(F.shiftrightunsigned("word", WORDS.bit_length() - 1).alias("__block")).agg(F.map_from_entries(F.collect_list(F.struct(slot, "bits"))).alias("m"))
    none = F.lit(0).cast("long")
    return blocks.select("__block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: F.coalesce(F.try_element_at("m", k), none)).alias("__words"))


def pick(df: DataFrame, rows: DataFrame, row_col: str, among: bool = True) -> DataFrame:
    """The rows of df whose number is (or is not) in column row of rows, which has no repeats or nulls."""
    bits = materialize(bits_of(rows), "row-bits")
    if bits.count() > BLOCKS:
        return df.join(rows.select(F.col("row").alias("__picked")), F.col(row_col) == F.col("__picked"), "left_semi" if among else "left_anti")
    word = F.get("__words", F.shiftrightunsigned(row_col, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int"))
    bit = F.call_function("shiftrightunsigned", word, F.col(row_col).bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    found = F.coalesce(bit, F.lit(0)) == F.lit(1 if among else 0)
    return df.withColumn("__block", _block(row_col)).join(F.broadcast(bits), "__block", "inner" if among else "left").where(found).select(*(F.col(f"`{c}`") for c in df.columns))
