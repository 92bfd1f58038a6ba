"""SimHash near-dedup at a Jaccard similarity (operator 10 as the pipeline's third stage).

A text's set holds the 64-bit hashes of its word shingles, and its fingerprint has a bit for each
of BITS majority votes over them. Texts of equal sets are one node. Nodes are dealt into tiles by
size class and population count; tile pairs whose sizes or population counts rule the similarity
out are skipped, the others are compared exactly by exclusive or and bit counts. At a similarity
of 0.8 about 15 % of the bits differ, 39 +- 6 of 256, so RADIUS holds such pairs but for one in
some hundred thousand, and unrelated texts but for one pair in 10^10.

Pairs within the radius are candidates only. Their components are small groups, within which sets
are compared: what is linked has the similarity asked for, exactly. A group of more than a task
should hold is dealt into parts. All parts are compared with a few leaders first; what most of
them are linked to is the core, and then only pairs with a text outside the core are left, part
by part. No group is expanded into pairs.

Defined results: words are split at white space and A-Z are lower case; a text of fewer words than
a shingle is one shingle; null and empty texts are copies of each other; long texts are taken
whole; of a component the row of least id stays (null ids last, then the first row read), so rows
of one id are told apart; an empty table gives an empty table; extra columns of any name pass
through (names that begin with `__` aside).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.llm import textkernels as tk
from pisteflow.llm.rowbits import pick
from pisteflow.operators.graph import connected_components, labels
from pisteflow.plans.lineage import discard, materialize

#: Bits that may differ in the first half of two fingerprints, and in the whole.
BITS, RADIUS = 256, (44, 76)
#: Nodes of a tile, at least, and tiles of a size class, at most: so many times a node is sent.
TILE, TILES = 8192, 24
#: Rows of a tile compared at once with the other tile, and links held before they are thinned.
STRIPE, HELD = 64, 1 << 20
#: Sets, and hashes in them, that one task compares at once.
PART_ROWS, PART_HASHES = 1024, 4_000_000
#: Members that all others of a group of several parts are compared with first.
LEADERS = 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of one run."""
    data = tk.lowered(data)
    white = tk.is_white(data)
    starts, ends, first = tk.word_spans(data, offsets, white)
    keep = ~white
    before = starts[starts > 0] - 1
    keep[before[white[before]]] = True  # one separator in front of a word
    place = np.cumsum(keep)
    text = np.where(white, np.uint8(32), data)[keep]
    starts, ends = place[starts] - 1, place[ends - 1]
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    at = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(n)), count)
    head = np.arange(at[-1]) - at[row] + first[row]
    tail = np.minimum(head + words - 1, first[row + 1] - 1)
    h = tk.span_hashes(text, starts[head], ends[tail]) if len(head) else np.zeros(0, np.uint64)
    return [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def wide_print(h: np.ndarray) -> np.ndarray:
    """The fingerprint of a set of hashes, as BITS / 64 values."""
    votes = np.zeros(BITS, np.int64)
    for base in range(0, len(h), 1 << 16):
        part = h[base : base + (1 << 16)]
        each = np.empty((len(part), BITS // 64), np.uint64)
        for k in range(BITS // 64):
            each[:, k] = tk.mixed(part + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1)))
        votes += np.unpackbits(each.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * votes > len(h), bitorder="little").view(np.uint64)


def size_classes(t: Fraction, most: int = 1 << 31) -> np.ndarray:
    """Least set size of each class; sets two classes apart can't be as similar as t."""
    edges = [0, 1]
    while edges[-1] < most:
        edges.append(edges[-1] * t.denominator // t.numerator + 1)
    return np.array(edges)


def similar_sets(a: np.ndarray, b: np.ndarray, t: Fraction) -> bool:
    if min(len(a), len(b)) * t.denominator < max(len(a), len(b)) * t.numerator:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * t.denominator >= (len(a) + len(b) - both) * t.numerator


def _sets(batch: pa.RecordBatch, column: str, words: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in tk.runs(batch.column(column)):
        yield from shingle_sets(data, offsets, words)


PRINT = [f"p{k}" for k in range(BITS // 64)]
NODE = ["node", "n", "band", "pop", *PRINT]


def _prints(df: DataFrame, text_col: str, id_col: str, words: int, t: Fraction) -> DataFrame:
    """(row, id) and NODE of every row; node is a hash of its whole set."""
    edges = size_classes(t)
    kinds = [T.IntegerType() if c in ("n", "band", "pop") else T.LongType() for c in NODE]
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", df.schema[id_col].dataType), *map(T.StructField, NODE, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, prints = [], [], []
            for h in _sets(batch, "text", words):
                node.append((int(tk.mixed(h + np.uint64(len(h))).sum(dtype=np.uint64)) + len(h)) & (2**64 - 1))
                size.append(len(h))
                prints.append(wide_print(h))
            p = np.array(prints, np.uint64).reshape(len(size), BITS // 64)
            n = np.array(size, np.int32)
            band = (np.searchsorted(edges, n, side="right") - 1).astype(np.int32)
            pop = np.bitwise_count(p[:, : BITS // 128]).sum(axis=1, dtype=np.int32)
            values = [np.array(node, np.uint64).view(np.int64), n, band, pop, *(np.ascontiguousarray(p[:, k]).view(np.int64) for k in range(BITS // 64))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *map(pa.array, values)], names=["row", "id", *NODE])

    return df.select(F.col("__row").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def deal(counts: list[tuple[int, int, int]]) -> tuple[list[tuple], list[tuple]]:
    """Tiles of (size class, population count, nodes) cells, and the tile pairs to compare.

    Returns (band, pop, first tile, tiles) of each cell, and (pair, tile, side) of each tile pair's
    sides. A tile holds neighbouring population counts; a count of very many nodes has several.
    """
    cells, spans = [], []  # spans: (band, least count, largest count) of each tile
    for band in sorted({b for b, _, _ in counts}):
        of = sorted((p, n) for b, p, n in counts if b == band)
        room = max(TILE, -(-sum(n for _, n in of) // TILES))
        free = 0
        for p, n in of:
            parts = -(-n // room)
            if parts == 1 and n <= free:
                spans[-1] = (band, spans[-1][1], p)
                cells.append((band, p, len(spans) - 1, 1))
                free -= n
                continue
            cells.append((band, p, len(spans), parts))
            spans += [(band, p, p)] * parts
            free = room - n if parts == 1 else 0
    at: dict[int, list[int]] = {}
    for k, (band, _, _) in enumerate(spans):
        at.setdefault(band, []).append(k)
    sides, pair = [], 0
    for i, (band, lo, hi) in enumerate(spans):
        for j in [*(j for j in at[band] if j >= i), *at.get(band + 1, [])]:
            _, low, high = spans[j]
            if max(low - hi, lo - high) <= RADIUS[0]:
                sides += [(pair, i, 0)] + [(pair, j, 1)] * (i != j)
                pair += 1
    return cells, sides


def compare(left: np.ndarray, right: np.ndarray | None, n_left: np.ndarray, n_right: np.ndarray | None, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints within RADIUS whose sizes allow the similarity.

    Places of the right tile count on from the left one's; right is None for a tile with itself.
    """
    same = right is None
    by = np.argsort(n_left, kind="stable")
    left, n_left = left[by], n_left[by]
    back = by if same else np.argsort(n_right, kind="stable")
    right, n_right = (left, n_left) if same else (right[back], n_right[back])
    least = n_left.astype(np.int64) * t.numerator  # right sizes times the denominator lie from here
    most = n_left.astype(np.int64) * t.denominator // t.numerator
    half = BITS // 128
    found, held = [], 0
    for s in range(0, len(left), STRIPE):
        e = min(s + STRIPE, len(left))
        lo = s if same else int(np.searchsorted(n_right.astype(np.int64) * t.denominator, least[s]))
        hi = int(np.searchsorted(n_right, most[e - 1], side="right"))
        if lo >= hi:
            continue
        d = np.bitwise_count(left[s:e, 0, None] ^ right[None, lo:hi, 0])
        for k in range(1, half):
            d += np.bitwise_count(left[s:e, k, None] ^ right[None, lo:hi, k])
        i, j = np.divmod(np.flatnonzero(d <= RADIUS[0]), hi - lo)
        i, j = i + s, j + lo
        if same:
            later = j > i
            i, j = i[later], j[later]
        if not len(i):
            continue
        rest = np.bitwise_count(left[i, half:] ^ right[j, half:]).sum(axis=1)
        a, b = n_left[i].astype(np.int64), n_right[j].astype(np.int64)
        ok = (np.bitwise_count(left[i, :half] ^ right[j, :half]).sum(axis=1) + rest <= RADIUS[1]) & (np.minimum(a, b) * t.denominator >= np.maximum(a, b) * t.numerator)
        if ok.any():
            found.append((by[i[ok]], back[j[ok]] + (0 if same else len(left))))
            held += int(ok.sum())
        if held > HELD:
            found = [_thinned(found)]
            held = len(found[0][0])
    return _thinned(found)


def _thinned(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The links, or where there are more than places, one of each place to the least that it is joined to."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    places, least = labels(i, j)
    away = places != least
    return (i, j) if len(i) <= len(places) else (least[away], places[away])


def candidates(nodes: DataFrame, t: Fraction) -> DataFrame:
    """(src, dst) links that join all nodes whose fingerprints are within RADIUS; nodes: NODE."""
    spark = nodes.sparkSession
    # Sets of fewer hashes can only be alike if they are equal, which makes them one node.
    nodes = nodes.where(F.col("n") * (t.denominator - t.numerator) >= t.numerator)
    # One row a cell: some hundred size classes by the population counts of half a fingerprint.
    cells, sides = deal([tuple(r) for r in nodes.groupBy("band", "pop").count().collect()])
    if not cells:
        return spark.createDataFrame([], "src long, dst long")
    of_cell = spark.createDataFrame(cells, "band int, pop int, tile int, parts int")
    of_tile = spark.createDataFrame(sides, "pair int, tile int, side int").groupBy("tile").agg(F.collect_list(F.struct("pair", "side")).alias("to"))
    tiled = nodes.join(F.broadcast(of_cell), ["band", "pop"]).withColumn("tile", F.col("tile") + F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    sent = tiled.join(F.broadcast(of_tile), "tile").select("node", "n", *PRINT, F.explode("to").alias("to")).select("to.pair", "to.side", "node", "n", *PRINT)
    # Comparing costs far more than its bytes tell, so the tile pairs are dealt out by count.
    n = min(10_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + sides[-1][0]))
    dealt = sent.repartition(n, "pair").sortWithinPartitions("pair", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["pair"]):
            side, size, node = (g.column(c).to_numpy() for c in ("side", "n", "node"))
            prints = np.stack([g.column(c).to_numpy().view(np.uint64) for c in PRINT], axis=1)
            cut = int(np.searchsorted(side, 1))
            if cut and cut < len(side):
                i, j = compare(prints[:cut], prints[cut:], size[:cut], size[cut:], t)
            else:
                # A tile with itself; or a side without the other, where there is nothing to find
                # that the tile's own pair doesn't find as well.
                i, j = compare(prints, None, size, None, t)
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["src", "dst"])

    return dealt.mapInArrow(run, "src long, dst long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, over batches sorted by them."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, k: int) -> tuple:
        return tuple(batch.column(c)[k].as_py() for c in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for c in keys:
            v = batch.column(c).to_numpy()
            change |= v[1:] != v[:-1]
        if held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        cuts = np.flatnonzero(change) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Bag:
    """Some sets at once, so that one set is compared with many."""

    def __init__(self, column: pa.ChunkedArray):
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.flat = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
        self.at = offsets - offsets[0]
        self.size = np.diff(self.at)

    def __len__(self) -> int:
        return len(self.size)

    def one(self, k: int) -> np.ndarray:
        return self.flat[self.at[k] : self.at[k + 1]]

    def like(self, x: np.ndarray, among: np.ndarray, t: Fraction) -> np.ndarray:
        """Which of the places among hold sets similar to x."""
        near = among[np.minimum(self.size[among], len(x)) * t.denominator >= np.maximum(self.size[among], len(x)) * t.numerator]
        if not len(near):
            return near
        if len(near) < 4:
            return np.array([k for k in near.tolist() if similar_sets(x, self.one(k), t)], np.int64)
        size = self.size[near]
        ends = np.cumsum(size)
        flat = self.flat[np.arange(ends[-1]) + np.repeat(self.at[near] - (ends - size), size)]
        place = np.minimum(np.searchsorted(x, flat), len(x) - 1)
        both = np.add.reduceat((x[place] == flat).astype(np.int64), ends - size)
        return near[both * t.denominator >= (len(x) + size - both) * t.numerator]


def _walk(bag: Bag, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Links (a spanning forest) of all similar pairs of a bag."""
    left = np.arange(len(bag))
    src, dst = [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            k = queue.pop()
            hit = bag.like(bag.one(k), left, t)
            if len(hit):
                src.append(np.full(len(hit), k))
                dst.append(hit)
                queue += hit.tolist()
                left = np.setdiff1d(left, hit, assume_unique=True)
    none = np.zeros(0, np.int64)
    return (np.concatenate(src), np.concatenate(dst)) if src else (none, none)


def _linked(frame: DataFrame, keys: list[str], order: list[str], find) -> DataFrame:
    """(src, dst) that find (a table and its Bag to places) gives for the groups of keys."""
    n = max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), 24)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, keys):
            node = g.column("node").to_numpy()
            i, j = find(g, Bag(g.column("set")))
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["src", "dst"])

    return frame.repartition(n, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, "src long, dst long")


def _with_leaders(sets: DataFrame, t: Fraction) -> DataFrame:
    """Links of all members of groups of several parts to some of them."""
    least = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node"))["node"] for k in range(LEADERS)]
    leaders = materialize(sets.groupBy("component", "parts").agg(F.array_distinct(F.array(*least)).alias("node")).select("component", "parts", F.explode("node").alias("node")), "leaders")
    held = sets.join(F.broadcast(leaders.select("component", "node")), ["component", "node"], "left_semi")
    sent = held.select("component", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "set", F.lit(0).alias("kind"))
    members = sets.select("component", "part", "node", "set", F.lit(1).alias("kind"))

    def find(g: pa.Table, bag: Bag) -> tuple[np.ndarray, np.ndarray]:
        kind = g.column("kind").to_numpy()
        first = int(np.searchsorted(kind, 1))
        src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(first):
            hit = bag.like(bag.one(k), np.arange(first, len(bag)), t)
            src.append(np.full(len(hit), k))
            dst.append(hit)
        return np.concatenate(src), np.concatenate(dst)

    return _linked(sent.union(members), ["component", "part"], ["kind"], find)


def _outside_core(sets: DataFrame, first: DataFrame, t: Fraction) -> DataFrame:
    """Links between all members of groups of several parts that aren't in its core both.

    first: links found before. The core are the members of the largest class that these make.
    """
    classes = materialize(connected_components(first), "classes")
    named = materialize(sets.select("component", "node", "n").join(classes.withColumnRenamed("component", "class"), "node", "left").withColumn("class", F.coalesce("class", "node")), "named")
    sizes = named.groupBy("component", "class").agg(F.count("*").alias("m"))
    core = sizes.groupBy("component").agg(F.max(F.struct("m", "class"))["class"].alias("core"))
    placed = materialize(named.join(core, "component").select("component", "node", "n", (F.col("class") == F.col("core")).alias("core")), "placed")
    need = F.ceil(F.greatest(F.count("*") / PART_ROWS, F.sum("n") / PART_HASHES)).cast("int").alias("parts")
    parts = materialize(placed.groupBy("component", "core").agg(need).groupBy("component").agg(F.max(F.when(~F.col("core"), F.col("parts"))).alias("outer"), F.max(F.when(F.col("core"), F.col("parts"))).alias("inner")).where("outer is not null"), "core-parts")
    slot = F.pmod(F.xxhash64("node"), F.when(F.col("core"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    dealt = placed.join(parts, "component").withColumn("own", slot + F.when(F.col("core"), F.col("outer")).otherwise(F.lit(0)))
    # Parts outside the core come first; a pair of parts is told by its first and its second part.
    others = F.when(F.col("core"), F.sequence(F.lit(0), F.col("outer") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") + F.coalesce("inner", F.lit(0)) - 1))
    sent = dealt.select("component", "node", "core", "own", F.explode(others).alias("other")).select("component", "node", "core", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own")
    full = sent.join(sets.select("component", "node", "set"), ["component", "node"])

    def find(g: pa.Table, bag: Bag) -> tuple[np.ndarray, np.ndarray]:
        own, one, two = (g.column(c).to_numpy() for c in ("own", "one", "two"))
        src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.flatnonzero(own == one[0])
        right = left if one[0] == two[0] else np.flatnonzero(own == two[0])
        label = np.arange(len(bag))
        for k in left.tolist():
            hit = bag.like(bag.one(k), right[label[right] != label[k]], t)
            if len(hit):
                src.append(np.full(len(hit), k))
                dst.append(hit)
                label[np.isin(label, np.append(label[hit], label[k]))] = label[k]
        return np.concatenate(src), np.concatenate(dst)

    return _linked(full, ["component", "one", "two"], [], find)


def verified(texts: DataFrame, members: DataFrame, words: int, t: Fraction) -> DataFrame:
    """(src, dst) links that join all similar sets of each group; members: component, node, n and row.

    texts: row and text.
    """
    need = F.ceil(F.greatest(F.count("*") / PART_ROWS, F.sum("n") / PART_HASHES)).cast("int")
    parts = members.groupBy("component").agg(need.alias("parts"))
    dealt = members.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    kept = ["component", "node", "n", "part", "parts"]
    dealt = materialize(dealt, "dealt")
    # Other texts than the members' don't move; their bit says so.
    held = pick(texts, dealt, "row").join(dealt, "row").select(*kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(_sets(batch, "text", words))
            at = np.concatenate(([0], np.cumsum([len(v) for v in got]))).astype(np.int32)
            flat = np.concatenate(got) if got else np.zeros(0, np.uint64)
            sets = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), sets], names=[*kept, "set"])

    sets = materialize(held.mapInArrow(run, "component long, node long, n int, part int, parts int, set array<long>"), "sets")
    discard(dealt)
    small = _linked(sets.where("parts = 1").select("component", "node", "set"), ["component"], [], lambda g, bag: _walk(bag, t))
    links = materialize(small, "links")
    large = sets.where("parts > 1")
    if large.isEmpty():
        discard(sets)
        return links
    first = materialize(_with_leaders(large, t), "leader-links")
    rest = materialize(_outside_core(large, first, t), "outer-links")
    discard(sets)
    return links.union(first).union(rest)


def components(texts: DataFrame, prints: DataFrame, words: int, similarity: str) -> DataFrame:
    """(node, component) of the nodes that have a similar one; texts: row and text; prints: of _prints()."""
    t = Fraction(similarity)
    nodes = materialize(prints.groupBy("node").agg(F.min("row").alias("row"), *(F.first(c).alias(c) for c in NODE[1:])), "nodes")
    close = materialize(candidates(nodes, t), "candidates")
    members = materialize(nodes.select("node", "n", "row").join(connected_components(close), "node"), "members")
    for done in (nodes, close):
        discard(done)
    found = connected_components(verified(texts, members, words, t))
    discard(members)
    return found


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 5, similarity: str = "4/5") -> DataFrame:
    """The rows of df that stay when one row of each component of similar texts does."""
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    prints = materialize(_prints(numbered, text_col, id_col, words, Fraction(similarity)), "prints")
    texts = numbered.select(F.col("__row").alias("row"), F.col(text_col).alias("text"))
    found = materialize(components(texts, prints.select("row", *NODE), words, similarity), "components")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    placed = materialize(prints.select("row", "node", order.alias("place")).join(found, "node", "left").select("row", F.coalesce("component", "node").alias("component"), "place"), "placed")
    discard(prints)
    least = materialize(placed.groupBy("component").agg(F.min("place").alias("least"), F.count("*").alias("n")).where("n > 1").select("component", F.col("least.row").alias("stays")), "least")
    gone = materialize(placed.join(least, "component").where("row <> stays").select(F.col("row").alias("__row")), "gone")
    for done in (placed, least, found):
        discard(done)
    return pick(numbered, gone.withColumnRenamed("__row", "row"), "__row", among=False).select(*(F.col(f"`{c}`") for c in df.columns))
