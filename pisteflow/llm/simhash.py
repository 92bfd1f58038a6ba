"""SimHash near-duplicates (operator 10).

A fingerprint has a bit for each of 64 majority votes over the hashes of word shingles. Distinct
fingerprints are packed into tiles, each of one cell: the population counts of the two halves.
Halves that differ by a and b in population count are a + b bits apart at least, so tile pairs
whose counts differ beyond the radius are skipped; the others are compared exactly, by exclusive
or and bit counts. Of a tile pair's links a spanning forest is kept, which joins the same
fingerprints; the links of all pairs then make the components.

The comparison is exact and so is quadratic in distinct fingerprints, less what tiles skip.

Defined results: null and empty texts have fingerprint zero, linked like any other; long texts
are fingerprinted whole; equal fingerprints are one node whatever their number; a component of
null ids only has a null component id; an empty table gives an empty table; extra columns pass
through and input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.llm import textkernels as tk
from pisteflow.operators.graph import connected_components
from pisteflow.plans.lineage import materialize

#: Fingerprints aimed at in a tile; a cell with more is split by hash, into PARTS tiles at most. A tile is
#: sent to those of 2 * radius * (radius + 1) + 1 cells at most, so what is shuffled grows in proportion
#: to the fingerprints, and only comparing grows as their square.
TILE, PARTS = 2048, 8
#: Rows of a tile compared at once with the other tile.
STRIPE = 128
SEED = 42


def fingerprint_run(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    """Fingerprints (uint64) of the texts of one run."""
    data = tk.lowered(data)
    white = tk.is_white(data)
    starts, ends, first = tk.word_spans(data, offsets, white)
    keep = ~white
    before = starts[starts > 0] - 1
    keep[before[white[before]]] = True  # one separator in front of a word
    place = np.cumsum(keep)
    text = np.where(white, np.uint8(32), data)[keep].tobytes()
    starts, ends = place[starts] - 1, place[ends - 1]
    n = np.diff(first)
    shingles = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    total = int(shingles.sum())
    row = np.repeat(np.arange(len(n)), shingles)
    at = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(shingles, out=at[1:])
    head = np.arange(total) - at[row] + first[row]
    tail = np.minimum(head + words - 1, first[row + 1] - 1)
    digest, seed = xxhash.xxh64_intdigest, SEED
    h = np.fromiter((digest(text[s:e], seed) for s, e in zip(starts[head].tolist(), ends[tail].tolist(), strict=True)), dtype=np.uint64, count=total)
    out = np.zeros(len(n), dtype=np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = np.stack([bits[a:b].sum(axis=0, dtype=np.int32) for a, b in zip(at[some].tolist(), at[some + 1].tolist(), strict=True)])
        major = (2 * votes > shingles[some, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(df: DataFrame, text_col: str = "text", words: int = 4, out_col: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """Adds the fingerprint (long) of every whole text, without a shuffle."""
    keep = [c for c in (df.columns if keep is None else keep) if c != out_col]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out_col, T.LongType(), False)])
    at = "__simhash_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint_run(data, offsets, words) for _, _, data, offsets in tk.runs(batch.column(at))]
            made = np.concatenate(got) if got else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(made.view(np.int64))], names=[*keep, out_col])

    return df.select(*(F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(keep)), df[text_col].alias(at)).mapInArrow(run, schema)


def forest(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles, or within one, thinned so that they still join the same rows."""
    a, b = [], []
    for s in range(0, len(left), STRIPE):
        near = np.bitwise_count(left[s : s + STRIPE, None] ^ right[None, :]) <= radius
        if same:
            near &= np.arange(len(right))[None, :] > np.arange(s, min(s + STRIPE, len(left)))[:, None]
        if not near.any():
            continue
        # A column joins the first row that it is linked to; later rows of the stripe join that
        # row through a column that they share.
        i, j = np.nonzero(near)
        if len(i) > 2 * STRIPE:
            for row in range(near.shape[0]):
                cols = np.flatnonzero(near[row])
                if not len(cols):
                    continue
                owner = near[:row, cols].any(axis=0)
                fresh = cols[~owner]
                a.append(np.full(len(fresh), s + row))
                b.append(fresh)
                if owner.any():
                    shared = cols[owner]
                    above = near[:row, shared].argmax(axis=0)
                    _, one = np.unique(above, return_index=True)
                    a.append(np.full(len(one), s + row))
                    b.append(shared[one])
        else:
            a.append(i + s)
            b.append(j)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(src, dst) links that join what all pairs within the radius join; distinct: column fp."""
    spark = distinct.sparkSession
    half = lambda c: (F.bit_count(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_count(F.shiftrightunsigned(c, 32)))
    low, high = half("fp")
    cells = distinct.select("fp", low.cast("int").alias("low"), high.cast("int").alias("high"))
    # One row a cell, 33 x 33 at most.
    sizes = cells.groupBy("low", "high").agg(F.least(F.ceil(F.count("*") / tile), F.lit(PARTS)).cast("int").alias("parts"))
    split = cells.join(F.broadcast(sizes), ["low", "high"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = materialize(split.groupBy("low", "high", "part", "parts").agg(F.collect_list("fp").alias("fps")), "tiles")
    # Each unordered pair of near cells once: the other cell is the same one or a later one.
    steps = [(dl, dh) for dl in range(0, radius + 1) for dh in range(-radius, radius + 1) if dl + abs(dh) <= radius and (dl > 0 or dh >= 0)]
    near = F.explode(F.array(*(F.struct(F.lit(x).alias("dl"), F.lit(y).alias("dh")) for x, y in steps)))
    left = tiles.select("low", "high", "part", F.col("fps").alias("left"), near.alias("to")).select((F.col("low") + F.col("to.dl")).alias("low"), (F.col("high") + F.col("to.dh")).alias("high"), F.col("part").alias("own"), "left", ((F.col("to.dl") == 0) & (F.col("to.dh") == 0)).alias("home"))
    left = left.join(F.broadcast(sizes), ["low", "high"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").where("not home or part >= own")
    right = tiles.select("low", "high", "part", F.col("fps").alias("right"))
    # Comparing costs far more than its bytes tell, so the tile pairs are dealt out by count.
    n = min(10_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), tiles.count() // 4))
    dealt = [n, "low", "high", "part"]
    pairs = left.repartition(*dealt).join(right.repartition(*dealt), ["low", "high", "part"]).select("left", "right", (F.col("home") & (F.col("part") == F.col("own"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst = [], []
            for k in range(batch.num_rows):
                one = lambda c: np.asarray(batch.column(c)[k].values).view(np.uint64)  # noqa: B023, E731
                x, y = one("left"), one("right")
                i, j = forest(x, y, batch.column("same")[k].as_py(), radius)
                src.append(x[i])
                dst.append(y[j])
            if src:
                put = lambda v: pa.array(np.concatenate(v).view(np.int64))
                yield pa.RecordBatch.from_arrays([put(src), put(dst)], names=["src", "dst"])

    return pairs.mapInArrow(run, "src long, dst long")


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 4, radius: int = 4) -> DataFrame:
    """One row a document: id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest id that links of at most radius differing bits reach.
    """
    prints = materialize(fingerprints(df, text_col, words, "fp", [id_col]), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    found = connected_components(materialize(links(distinct, radius), "links"))
    grouped = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    of_root = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = grouped.select("fp", "root").join(of_root, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of df that stay when one document of each component does: the one of smallest id.

    Rows are told apart by number, so ids may be null (these come last) or repeated.
    """
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    chosen = near_duplicates(numbered, text_col, "__row", words, radius)
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("__row").alias("row"))
    placed = chosen.join(numbered.select("__row", order.alias("place")), "__row")
    stay = placed.groupBy("component_id").agg(F.min("place").alias("least")).select(F.col("least.row").alias("__row"))
    return numbered.join(stay, "__row", "left_semi").select(df.columns)
