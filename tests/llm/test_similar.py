"""Near copies of the pipeline against all pairs in plain Python."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pisteflow.llm import rowbits, similar

T = Fraction(4, 5)


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def joined(sets):
    """The class of each set, by all pairs."""
    of = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both * 5 >= either * 4 and of[a] != of[b]:
                gone = of[a]
                of = [of[b] if c == gone else c for c in of]
    return of


def stays(rows):
    """Of (id, text) rows, the places of those that stay."""
    of = joined([shingles(t) for _, t in rows])
    best = {}
    for k, (i, _) in enumerate(rows):
        best[of[k]] = min(best.get(of[k], (True, 0, len(rows))), (i is None, i or 0, k))
    return {k for *_, k in best.values()}


def documents():
    """Near copies at similarities about 0.8, a large group, a common passage, copies, null and repeated ids."""
    rnd = random.Random(17)
    some = lambda n: [f"w{rnd.randrange(2000)}" for _ in range(n)]
    rows, passage = [], some(30)
    for base in range(12):
        text = some(rnd.randrange(25, 300))
        for _ in range(4):
            edits = rnd.sample(range(len(text)), max(1, len(text) * rnd.randrange(1, 5) // 200))
            rows.append(" ".join("zz%d" % rnd.randrange(99) if k in edits else x for k, x in enumerate(text)))
    group = some(120)
    rows += [" ".join("q%d" % rnd.randrange(999) if k in (e, e + 40) else x for k, x in enumerate(group)) for e in range(30)]
    rows += [" ".join(some(rnd.randrange(2, 40)) + passage + some(rnd.randrange(2, 40))) for _ in range(30)]
    short = some(9)
    rows += [" ".join(short), " ".join(short[:8]), " ".join(short[:7])]
    rows += ["one two", "ONE  two", "one", None, "", " \n", rows[0].upper(), " ".join(some(40_000))]
    out = [(1000 - k, t) for k, t in enumerate(rows)]
    out += [(None, "no id " + rows[5]), (None, "lone " * 9), (None, "lone " * 8), (7, rows[60] + " x"), (7, rows[60]), (7, rows[60])]
    return out


@pytest.mark.parametrize("part, tile", [(1024, 8192), (7, 16)])
def test_near_copies(spark, monkeypatch, part, tile):
    monkeypatch.setattr(similar, "PART_ROWS", part)
    monkeypatch.setattr(similar, "TILE", tile)
    rows = documents()
    want = stays(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, row string, n long").coalesce(1)
    got = corpus_pipeline.near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.n for r in got.collect()) == sorted(want)
    if part == 7:
        assert corpus_pipeline.near_copies(spark, docs.limit(0), "").count() == 0


def test_radius_holds_similar_sets():
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(1500):
        n = int(rng.integers(4, 60))
        h = rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64)
        own = n // 9  # n - own of n + own are shared: 0.8 or more
        a, b = np.sort(h[:n]), np.sort(np.concatenate((h[: n - own], h[n : n + own])))
        if n < 9:
            b = np.sort(h[: n + 1])
        d = np.bitwise_count(similar.wide_print(a) ^ similar.wide_print(b))
        assert similar.similar_sets(a, b, T)
        missed += d[:2].sum() > similar.RADIUS[0] or d.sum() > similar.RADIUS[1]
    assert missed <= 1


def test_size_classes_two_apart_are_never_similar():
    edges = similar.size_classes(T, 5000)
    for k in range(len(edges) - 2):
        assert (edges[k + 1] - 1) * 5 < edges[k + 2] * 4 or edges[k + 1] - 1 <= 0 or k + 3 > len(edges)
        assert (edges[k + 1] - 1) < edges[k + 2] * T


def test_tiles_are_joined_as_by_all_pairs():
    from pisteflow.operators.graph import labels

    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, (6, 4), dtype=np.uint64)
    prints = base[rng.integers(0, 6, 90)]
    for k in range(90):
        for bit in rng.integers(0, 256, int(rng.integers(0, 60))):
            prints[k, bit // 64] ^= np.uint64(1 << int(bit % 64))
    n = rng.integers(40, 60, 90)
    d = np.bitwise_count(prints[:, None] ^ prints[None])
    near = (d[:, :, :2].sum(axis=2) <= similar.RADIUS[0]) & (d.sum(axis=2) <= similar.RADIUS[1])
    near &= np.minimum(n[:, None], n) * 5 >= np.maximum(n[:, None], n) * 4
    every = np.arange(90)
    for got, allowed in ((similar.compare(prints, None, n, None, T), near), (similar.compare(prints[:50], prints[50:], n[:50], n[50:], T), near & ((every < 50)[:, None] ^ (every < 50)))):
        i, j = np.nonzero(allowed)
        want = labels(np.append(i, every), np.append(j, every))[1]
        assert labels(np.append(got[0], every), np.append(got[1], every))[1].tolist() == want.tolist()


def test_walk_is_all_pairs():
    rnd = random.Random(5)
    base = [rnd.randrange(1 << 60) for _ in range(20)]
    sets = [sorted({x if rnd.random() > 0.06 else rnd.randrange(1 << 60) for x in base}) for _ in range(40)]
    bag = similar.Bag(pa.array(sets, pa.list_(pa.int64())))
    from pisteflow.operators.graph import labels

    i, j = similar._walk(bag, T)
    of = joined([set(s) for s in sets])
    nodes, least = labels(np.append(i, np.arange(40)), np.append(j, np.arange(40)))
    assert all((of[a] == of[b]) == (least[a] == least[b]) for a in range(40) for b in range(40))


@pytest.mark.parametrize("blocks", [1 << 17, 0])
def test_pick(spark, monkeypatch, blocks):
    monkeypatch.setattr(rowbits, "BLOCKS", blocks)
    numbers = [0, 5, 63, 64, 16383, 16384, (7 << 33) + 1, 1 << 40]
    every = spark.createDataFrame([(n + d,) for n in numbers for d in (0, 2)], "k long")
    rows = spark.createDataFrame([(n,) for n in numbers], "row long")
    assert sorted(r.k for r in rowbits.pick(every, rows, "k").collect()) == sorted(numbers)
    assert sorted(r.k for r in rowbits.pick(every, rows, "k", among=False).collect()) == sorted(n + 2 for n in numbers)
    assert rowbits.pick(every, rows.limit(0), "k", among=False).count() == len(numbers) * 2
