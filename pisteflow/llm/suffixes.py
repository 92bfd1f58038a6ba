"""Repeated byte strings by column-wise suffix sorting (operator 2).

Every string of the wanted length has an anchor: the position of the smallest hash of a short
gram in it, the leftmost on ties. Equal strings have equal anchor hashes at equal places, so a
text is cut into segments: maximal runs of string starts that share an anchor. Segments group by
anchor hash, and only within a group can strings be equal.

1. Segments that are alike are one class; a class of two or more is repeated throughout, which a
   count of its hash shows without moving text.
2. One text of each class that shares its anchor with another class goes to column-wise
   construction: segments of a group are aligned at the anchor, and from the last column to the
   first one symbol of every segment is put in front, which re-sorts the collection by suffix
   (the order of its Burrows-Wheeler transform) and updates the common prefixes of neighbours.
   A string is repeated where a common prefix with a neighbour reaches the wanted length.
3. Groups of very many classes are split: each segment's starts are dealt into blocks by their
   distance from the anchor, and a block is grouped by the bytes that all its strings share. Blocks
   get smaller until groups are small; those of one start are equal strings, which are only
   counted. So no group has to fit in a task, and a segment is never expanded into all its strings.

Texts are judged as UTF-8 bytes; where equality is decided by hash, it is by 128 bits
(an anchor's and a segment's, or a string's own).

Defined results: null is the empty text; texts shorter than the length lose nothing; long texts
are cut in blocks; repeated rows repeat each other wholly; an empty table gives an empty table;
extra columns of any name pass through and input columns named like an output column are replaced;
ids are of any type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.llm import textkernels as tk
from pisteflow.llm.columns import shielded
from pisteflow.plans.lineage import discard, materialize

GRAM = 24
#: Classes of one group that are still sorted together; a larger group is split into blocks of
#: these many starts, in turn.
GROUP_CLASSES = 2048
BLOCKS = (16, 4, 1)
#: Bytes that are cut at once; a longer text is cut in blocks that overlap by the length.
BLOCK = 1 << 20
OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept", "spans")


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width consecutive values."""
    out, size = h, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, anchor, first and last string start of each segment of one text."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    parts = []
    for start in range(0, len(data) - length + 1, BLOCK):
        block = data[start : start + BLOCK + length - 1]
        width = length - GRAM + 1
        h = tk.window_hashes(block, GRAM)
        least = _window_min(h, width)
        # The anchor of string s: the next position from s on whose hash is the minimum.
        at = np.flatnonzero(_is_candidate(h, least, width))
        # From the left, a candidate serves strings up to itself until a smaller one comes in.
        s = np.arange(len(least))
        anchor = at[np.searchsorted(at, s)]
        wrong = h[anchor] != least
        while wrong.any():
            step = np.searchsorted(at, anchor[wrong]) + 1
            anchor[wrong] = at[step]
            wrong[wrong] = h[anchor[wrong]] != least[wrong]
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.concatenate((first[1:], [len(least)])) - 1
        a = anchor[first]
        parts.append((h[a], a + start, first + start, last + start))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _is_candidate(h: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the minimum of some string that holds them."""
    # Position p lies in strings p-width+1 .. p; it can be an anchor if their largest minimum is its hash.
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    most = ~_window_min(~padded, width)
    return most[: len(h)] == h


def repeated_starts(texts: list[bytes], group: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, which of its string starts first..last are repeated in its group.

    texts[i] begins at first[i] and ends with the string that starts at last[i]; anchor[i] lies in
    it. All are positions in the text that the segment is cut from.
    """
    n = len(texts)
    left = anchor - first  # columns before the anchor
    width = np.array([len(t) for t in texts])
    ends = width - left  # columns from the anchor on
    lo, hi = -int(left.max(initial=0)), int(ends.max(initial=0))
    body = np.frombuffer(b"".join(texts), np.uint8)
    base = np.concatenate(([0], np.cumsum(width)))[:-1] + left  # of column 0
    found = [np.zeros(0, bool)] * n
    hit = np.zeros((n, int(left.max(initial=0)) + 1), bool)
    # Segments in suffix order within their group, and each one's common prefix with the one above.
    order = np.argsort(group, kind="stable")
    prefix = np.zeros(n, np.int32)
    for column in range(hi - 1, lo - 1, -1):
        here = (column < ends[order]) & (column >= -left[order])
        if not here.any():
            continue
        # Rows without a symbol in this column keep their place in front, behind an end mark.
        symbol = np.zeros(n, np.int64)
        symbol[here] = body[base[order[here]] + column].astype(np.int64) + 1
        key = group[order] * 257 + symbol
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        alike = np.zeros(n, bool)
        alike[1:] = (key[1:] == key[:-1]) & (symbol[turn][1:] > 0)
        new = np.zeros(n, np.int32)
        pairs = np.flatnonzero(alike)
        if len(pairs):
            # What two rows had in common before is the least prefix on the way between them.
            span = np.empty(2 * len(pairs), np.int64)
            span[0::2], span[1::2] = turn[pairs - 1] + 1, turn[pairs] + 1
            padded = np.concatenate((prefix, [0, 0])).astype(np.int32)
            new[pairs] = np.minimum.reduceat(padded, span)[0::2] + 1
        order, prefix = order[turn], new
        if column <= 0:
            reach = prefix >= length
            reach[:-1] |= reach[1:]
            rows = order[reach]
            ok = (column >= -left[rows]) & (column <= (last - anchor)[rows])
            hit[rows[ok], (column + left[rows])[ok]] = True
    for i in range(n):
        found[i] = hit[i, : last[i] - first[i] + 1]
    return found


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


_SEGMENT = "anchor_hash long, content long, row_id long, row_hash long, anchor int, first int, last int"
CLASS = ["anchor_hash", "content"]
ROW = ["row_id", "row_hash"]


def _cut(df: DataFrame, text_col: str, told: list, length: int) -> DataFrame:
    """The segments of every text; content is a hash of a segment's bytes and of where its anchor is."""
    names = [c.split()[0] for c in _SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for base in range(0, batch.num_rows, 1000):
                part = batch.slice(base, 1000)
                rows, out = [], [[] for _ in range(5)]
                for k, text in enumerate(part.column("text")):
                    raw = (text.as_py() or "").encode()
                    key, anchor, first, last = segments(np.frombuffer(raw, np.uint8), length)
                    if len(key):
                        content = [digest(raw[a:b], seed=c) for a, b, c in zip(first.tolist(), (last + length).tolist(), (anchor - first).tolist(), strict=True)]
                        for column, v in zip(out, (key.view(np.int64), np.array(content, np.uint64).view(np.int64), anchor.astype(np.int32), first.astype(np.int32), last.astype(np.int32)), strict=True):
                            column.append(v)
                        rows.append(np.full(len(key), k))
                if rows:
                    r = pa.array(np.concatenate(rows))
                    a, c, *places = (pa.array(np.concatenate(v)) for v in out)
                    yield pa.RecordBatch.from_arrays([a, c, part.column("row_id").take(r), part.column("row_hash").take(r), *places], names=names)

    return df.select(*told, F.col(text_col).alias("text")).mapInArrow(run, _SEGMENT)


def _fetch(df: DataFrame, text_col: str, told: list, asked: DataFrame, length: int) -> DataFrame:
    """asked with the bytes of each segment, cut from the text of its row; rows alike in a task are cut once."""
    fields = [f for f in asked.schema.fields if f.name not in ROW]
    names = [f.name for f in fields]
    per = asked.groupBy(*ROW).agg(F.collect_list(F.struct(*names)).alias("segs")).withColumnsRenamed({"row_id": "i", "row_hash": "h"})
    rows = df.select(*told, F.col(text_col).alias("text"))
    held = rows.join(per, rows["row_id"].eqNullSafe(per["i"]) & (rows["row_hash"] == per["h"])).select("text", "segs", *ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int | None, int]] = set()
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ROW), strict=True))
            new = []
            for r in rows:
                new.append(r not in seen)
                seen.add(r)
            batch = batch.filter(pa.array(new, pa.bool_()))
            for base in range(0, batch.num_rows, 500):
                part = batch.slice(base, 500)
                segs = part.column("segs").flatten()
                f = {c: segs.field(c) for c in names}
                n = np.diff(part.column("segs").offsets.to_numpy())
                texts = (t for t, k in zip(part.column("text"), n, strict=True) for t in [t.as_py().encode()] for _ in range(k))
                cut = [raw[a : b + length] for raw, a, b in zip(texts, f["first"].to_pylist(), f["last"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*f.values(), pa.array(cut, pa.binary())], names=[*names, "cut"])

    return held.mapInArrow(run, T.StructType([*fields, T.StructField("cut", T.BinaryType())]))


PIECE = "key long, content long, anchor_hash long, class long, origin int, anchor int, first int, last int, cut binary"
FOUND = "anchor_hash long, class long, lo int, hi int"


def _sort_groups(frames: Iterator[pd.DataFrame], length: int, at_once: int = 4096) -> Iterator[pd.DataFrame]:
    """Column-wise construction of all groups of a task, some at a time; rows come group by group."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        group = pd.factorize(frame["key"])[0].astype(np.int64)
        anchor, first, last = (frame[c].to_numpy(np.int64) for c in ("anchor", "first", "last"))
        spans = [_runs(mask) for mask in repeated_starts(frame["cut"].tolist(), group, anchor, first, last, length)]
        row = np.repeat(np.arange(len(frame)), [len(a) for a, _ in spans])
        out = frame[["anchor_hash", "class"]].iloc[row].reset_index(drop=True)
        base = (first - frame["origin"].to_numpy(np.int64))[row]
        out["lo"], out["hi"] = ((base + np.concatenate([x[k] for x in spans])).astype(np.int32) for k in (0, 1))
        return out

    held = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        while len(held) > at_once:
            # The last group may go on in the next batch; groups are cut where one begins.
            starts = np.flatnonzero(held["key"].diff().ne(0).to_numpy())
            stop = starts[np.searchsorted(starts, at_once, side="right") - 1] or (starts[1] if len(starts) > 1 else 0)
            if not stop:
                break
            yield build(held.iloc[:stop].reset_index(drop=True))
            held = held.iloc[stop:].reset_index(drop=True)
    if held is not None and len(held):
        yield build(held)


def _split(frames: Iterator[pd.DataFrame], length: int, block: int) -> Iterator[pd.DataFrame]:
    """Each piece as blocks of starts, grouped by what all strings of a block share.

    Blocks lie at fixed distances from the anchor, so equal strings are in blocks of equal keys.
    """
    digest = xxhash.xxh3_64_intdigest
    names = [c.split()[0] for c in PIECE.split(", ")]
    for frame in frames:
        for base in range(0, len(frame), 500):
            rows = []
            for r in frame.iloc[base : base + 500].itertuples(index=False):
                key, _, anchor_hash, of_class, origin, anchor, first, last, cut = r
                start = first
                while start <= last:
                    k = (start - anchor) // block  # which block, from the anchor
                    stop = min(last, anchor + (k + 1) * block - 1)
                    lo, hi = anchor + k * block, anchor + (k + 1) * block - 1  # the whole block
                    core = cut[hi - first : lo + length - first]  # what every string of the block holds
                    text = cut[start - first : stop - first + length]
                    rows.append((digest(core, seed=(key ^ k) & 0xFFFFFFFFFFFFFFFF), digest(text, seed=(start - lo) & 0xFFFF), anchor_hash, of_class, origin, anchor, start, stop, text))
                    start = stop + 1
            out = pd.DataFrame(rows, columns=names)
            for c in ("key", "content"):
                out[c] = np.array(out[c].tolist(), np.uint64).view(np.int64)
            yield out.astype({c: np.int32 for c in ("origin", "anchor", "first", "last")})


def _resolve(pieces: DataFrame, length: int, blocks: tuple[int, ...]) -> DataFrame:
    """(anchor_hash, class, lo, hi): repeated starts of each class, counted from its first; pieces: PIECE and classes."""
    n = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), 24)
    small = pieces.where(F.col("classes") <= GROUP_CLASSES).drop("classes").repartition(n, "key").sortWithinPartitions("key")
    built = small.mapInPandas(lambda f: _sort_groups(f, length), FOUND)
    large = pieces.where(F.col("classes") > GROUP_CLASSES).drop("classes")
    if not blocks or large.isEmpty():
        return built
    parts = materialize(large.mapInPandas(lambda f: _split(f, length, blocks[0]), PIECE), "blocks")
    which = F.struct("anchor_hash", "class", "first")
    counts = materialize(parts.groupBy("key", "content").agg(F.count("*").alias("copies"), F.min(which).alias("one")), "block-counts")
    groups = materialize(counts.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1"), "block-groups")
    copied = counts.where("copies > 1").select("key", "content", "one")
    told = parts.join(copied, ["key", "content"], "left")
    lo, hi = (F.col(c) - F.col("origin") for c in ("first", "last"))
    whole = told.where("one is not null").select("anchor_hash", "class", lo.alias("lo"), hi.alias("hi"))
    # Of copies, which are settled, one goes on as a witness: rows of a key are then as many as its classes.
    witness = told.where(F.col("one").isNull() | (F.col("one") == which)).drop("one")
    more = witness.join(groups, "key")
    return built.union(whole).union(_resolve(materialize(more, "pieces"), length, blocks[1:]) if blocks[1:] else more.where("false").select("anchor_hash", "class", lo.alias("lo"), hi.alias("hi")))


def repeated_spans(df: DataFrame, told: list, text_col: str, length: int) -> DataFrame:
    """(row_id, row_hash, first, last): runs of starts of repeated strings."""
    every = materialize(_cut(df, text_col, told, length), "segments")
    # What is grouped is written out, so that in a join one large group's rows can be split.
    anchors = materialize(every.groupBy("anchor_hash").agg(F.count("*").alias("n")).where("n > 1").select("anchor_hash"), "anchors")
    segs = materialize(every.join(anchors, "anchor_hash", "left_semi"), "shared-segments")
    discard(every)
    discard(anchors)
    classes = materialize(segs.groupBy(*CLASS).agg(F.count("*").alias("copies"), F.min(F.struct(*ROW, "anchor", "first", "last")).alias("one")), "classes")
    groups = materialize(classes.groupBy("anchor_hash").agg(F.count("*").alias("classes")).where("classes > 1"), "groups")
    # One text of each class that is not alone with its anchor.
    asked = classes.join(groups, "anchor_hash").select(*CLASS, "classes", "one.*")
    fetched = _fetch(df, text_col, told, asked, length)
    pieces = materialize(fetched.select(F.col("anchor_hash").alias("key"), "content", "anchor_hash", F.col("content").alias("class"), F.col("first").alias("origin"), "anchor", "first", "last", "cut", "classes"), "pieces")

    partly = _resolve(pieces, length, BLOCKS).groupBy("anchor_hash", F.col("class").alias("content")).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    verdict = classes.select(*CLASS, "copies").join(partly, CLASS, "left").where("copies > 1 or runs is not null")
    verdict = materialize(verdict.select(*CLASS, F.when(F.col("copies") <= 1, F.col("runs")).alias("runs")), "verdict")
    whole = F.array(F.struct(F.lit(0).alias("lo"), (F.col("last") - F.col("first")).alias("hi")))
    marked = segs.join(verdict, CLASS).select(*ROW, "first", F.explode(F.coalesce("runs", whole)).alias("r"))
    spans = materialize(marked.select(*ROW, (F.col("first") + F.col("r.lo")).alias("first"), (F.col("first") + F.col("r.hi")).alias("last")), "spans")
    for done in (segs, classes, groups, pieces, verdict):
        discard(done)
    return spans


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = 200) -> DataFrame:
    """Every row with n_bytes, n_removed, n_spans, kept (binary) and spans (of removed bytes)."""
    base, restored = shielded(df, (text_col, id_col), OUTPUTS)
    # Rows are told by id and text; rows alike in both lose the same bytes.
    whole = isinstance(df.schema[id_col].dataType, T.IntegralType)
    told = [(F.col(id_col).cast("long") if whole else F.xxhash64(id_col)).alias("row_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("row_hash")]
    spans = repeated_spans(base, told, text_col, length)
    per = spans.groupBy("row_id", "row_hash").agg(F.collect_list(F.struct("first", "last")).alias("__starts")).withColumnsRenamed({"row_id": "__i", "row_hash": "__h"})
    rows = base.withColumns({"__row_id": told[0], "__row_hash": told[1]})
    joined = rows.join(per, rows["__row_id"].eqNullSafe(per["__i"]) & (rows["__row_hash"] == per["__h"]), "left")
    keep = base.columns
    schema = T.StructType([*base.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    at = "__suffix_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans_out, kept = [], [], [], []
            for text, starts in zip(batch.column(at), batch.column("__starts"), strict=True):
                raw = (text.as_py() or "").encode()
                found: list[dict[str, int]] = []
                if starts.is_valid:
                    a = starts.values.field("first").to_numpy()
                    b = starts.values.field("last").to_numpy() + length
                    by = np.argsort(a, kind="stable")
                    a, b = a[by], np.maximum.accumulate(b[by])
                    new = np.concatenate(([True], a[1:] > b[:-1]))
                    heads = np.flatnonzero(new)
                    tails = np.concatenate((heads[1:], [len(a)])) - 1
                    found = [{"start": int(x), "end": int(y)} for x, y in zip(a[heads], b[tails], strict=True)]
                cursor, parts = 0, []
                for s in found:
                    parts.append(raw[cursor : s["start"]])
                    cursor = s["end"]
                parts.append(raw[cursor:])
                sizes.append(len(raw))
                removed.append(sum(s["end"] - s["start"] for s in found))
                spans_out.append(found)
                kept.append(b"".join(parts))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            arrays = [*(batch.column(c) for c in keep), *(pa.array(x, pa.int64()) for x in (sizes, removed, [len(s) for s in spans_out])), pa.array(kept, pa.binary()), pa.array(spans_out, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *OUTPUTS])

    return restored(joined.select(*keep, F.col(text_col).alias(at), "__starts").mapInArrow(run, schema))
