"""Operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pisteflow.llm import bpe, exact, langid, licenses, lines, mixing, quality, simhash, suffixes, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, kept string, score string"
WHITE = "[\\x20\\x09-\\x0D]"


def table(spark, rows):
    """Documents with two extra columns whose names clash with outputs."""
    return spark.createDataFrame([(i, t, lang, s, "x", "y") for i, t, lang, s in rows], SCHEMA)


def words(rnd, n, letters="abcdeé"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    passage, long_one = words(rnd, 60), words(rnd, 3000)
    out = [(i, words(rnd, 20) + passage[: rnd.randrange(150, 240)] + words(rnd, 20), "en", rnd.choice(["a", "b", None])) for i in range(24)]
    out += [(30, None, None, "a"), (31, "", "en", "a"), (32, " \n\t ", "en", "b"), (33, long_one, "de", None), (34, "x" * 500, "de", "c"), (35, "Ab c\nab  C\n", "de", "c"), (36, "AB C", "en", "c")]
    out += [out[3], out[3], (40, out[5][1] + "  ", "en", "a"), (None, out[6][1], "en", "a"), (None, "short", None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows).repartition(3)


def key(x):
    return str(x)


# -- 1 --------------------------------------------------------------------------------------------


def _ranks():
    """A little vocabulary: all bytes, then some merges."""
    ranks = {bytes([b]): b for b in range(256)}
    for t in (b"ab", b" a", b"abc", b"de", b" de", b"dede", "é".encode()):
        ranks[t] = len(ranks)
    return ranks


def test_bpe_is_like_the_library_and_decodes(spark, docs, rows):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    got = bpe.encode_decode(docs, _ranks(), P.PATTERN, outputs=("ids", "ids_text", "decoded")).collect()
    assert len(got) == len(rows) and got[0].kept == "x"
    for r in got:
        assert r.ids == own.encode_ordinary(r.text or "") == [int(x) for x in r.ids_text.split()]
        assert bytes(r.decoded) == (r.text or "").encode()
    back = bpe.decode(spark.createDataFrame([([97, 98, 256],), (None,)], "ids array<int>"), _ranks()).collect()
    assert [r.decoded and bytes(r.decoded) for r in back] == [b"abab", None]
    assert bpe.encode_decode(docs.limit(0), _ranks(), P.PATTERN).count() == 0


def test_bpe_with_the_production_ranks(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    long_one = spark.createDataFrame([(-1, "word " * 300_000 + "x" * 30_000), (-2, None)], "doc_id long, text string")
    got = bpe.encode_decode(docs.union(long_one), ranks, P.PATTERN, outputs=("ids", "decoded")).collect()
    assert len(got) > 200 and all(r.ids == own.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode() for r in got)


def test_pieces_and_odd_characters():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    codec = bpe.Codec(_ranks(), P.PATTERN)
    rnd = random.Random(2)
    for _ in range(400):
        text = "".join(chr(rnd.choice([rnd.randrange(1, 0x250), rnd.randrange(0x250, 0x3000), 32, 10, 0x1F600])) for _ in range(50))
        assert [int(x) for x in codec.encode_text(text).split()] == own.encode_ordinary(text)
    assert len(codec.encode_text("a" * 50_000).split()) == len(own.encode_ordinary("a" * 50_000))


def test_perfect_hash():
    keys = {f"k{i}".encode(): i for i in range(3000)}
    h = bpe.MinimalPerfectHash(keys)
    assert sorted(h.values) == list(range(3000)) and all(h.get(k) == v for k, v in keys.items())
    assert h.get(b"none") is None and bpe.MinimalPerfectHash({}).get(b"a") is None


# -- 2 --------------------------------------------------------------------------------------------


def _removed(rows, length):
    count = collections.Counter()
    raw = [(t or "").encode() for _, t, *_ in rows]
    for b in raw:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for (i, *_), b in zip(rows, raw, strict=True):
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                mark[s : s + length] = b"\1" * length
        spans = sum(1 for s in range(len(b)) if mark[s] and not (s and mark[s - 1]))
        out.append((i, len(b), sum(mark), spans, bytes(x for x, m in zip(b, mark, strict=True) if not m)))
    return sorted(out, key=key)


@pytest.mark.parametrize("classes", [2048, 2])
def test_suffix_dedup(docs, rows, monkeypatch, classes):
    monkeypatch.setattr(suffixes, "GROUP_CLASSES", classes)
    monkeypatch.setattr(suffixes, "BLOCK", 300)
    got = suffixes.remove_repeats(docs, length=120)
    assert got.columns == ["doc_id", "text", "lang", "source", "score", "n_bytes", "n_removed", "n_spans", "kept", "spans"]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=key) == _removed(rows, 120)


def test_suffix_dedup_of_the_production_length(spark):
    rnd = random.Random(12)
    passages = [words(rnd, 90) for _ in range(3)]
    rows = [(i, words(rnd, 30) + rnd.choice(passages)[rnd.randrange(60) : rnd.randrange(180, 420)] + words(rnd, 30), "en", "a") for i in range(40)]
    rows += [(90, "ab" * 400, "en", "a"), (91, passages[0] + passages[0], "en", "b"), rows[0]]
    got = suffixes.remove_repeats(table(spark, rows), length=200)
    want = _removed(rows, 200)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=key) == want and sum(w[2] for w in want) > 2000


def test_suffix_dedup_of_nothing(docs):
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


# -- 3 --------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    rnd = random.Random(1)
    pool = ["Home", " home\t", "ÉCOLE", "école", "", "  ", "Menu"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.5 else words(rnd, 3) for _ in range(rnd.randrange(1, 9))), "en", "a") for i in range(40)]
    rows += [(90, None, None, None), (91, "", None, None), (92, "Home\nHome\nx", "en", "a"), (None, "home", None, None), rows[0], rows[0]]
    norm = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(f"^{WHITE}+|{WHITE}+$", "", x))
    seen = collections.Counter(k for _, t, *_ in rows for k in {norm(x) for x in (t or "").split("\n")} - {""})
    want = []
    for i, t, *_ in rows:
        split = (t or "").split("\n")
        stay = [x for x in split if not (norm(x) and seen[norm(x)] >= 5)]
        want.append((i, len(split), len(split) - len(stay), "\n".join(stay)))
    got = lines.dedup_lines(table(spark, rows), min_docs=5)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()), key=key) == sorted(want, key=key)
    assert lines.dedup_lines(table(spark, rows).limit(0)).count() == 0


def test_runs_are_merged_in_stored_order(spark):
    """A merge of stored runs has no exchange of them and no sort."""
    store = lines.LineStore(spark, 5, 4)
    rows = lambda n: spark.range(n).selectExpr("id as h1", "id * 7 as h2", "2L as n")
    names = [store._write(rows(50)), store._write(rows(30))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with lines._stored_order(spark):
            joined = spark.table(names[0]).join(spark.table(names[1]).withColumnRenamed("n", "m"), lines.HASH, "full")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Sort [" not in plan and "Exchange" not in plan
            assert joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    store.levels = [names]
    store.drop()
    assert not [t.name for t in spark.catalog.listTables() if t.name in names]


# -- 4 --------------------------------------------------------------------------------------------


def test_exact_dedup(docs, rows):
    bare = lambda t: re.sub(f"{WHITE}+", "", t or "")
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i))
    got = exact.exact_dedup(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        best = min(groups[bare(r.text)])
        assert (r.keep_id, r.group_size, r.text_sha256) == (best[3], len(groups[bare(r.text)]), hashlib.sha256(bare(r.text).encode()).hexdigest())
    # Of wholly repeated rows, too, one stays.
    assert sum(r.kept for r in got) == len(groups)
    assert exact.exact_dedup(docs.limit(0)).count() == 0


# -- 5 --------------------------------------------------------------------------------------------


def test_license_scan(spark):
    mit = licenses.TEMPLATES["mit"]
    noisy = mit.replace("Software without restriction", "software with no restriction at all").upper()
    rows = [(1, "é intro. " + mit + " tail", "en", "a"), (2, noisy, "en", "a"), (3, "nothing here at all, not even a license", "en", "a"), (4, None, None, None), (5, "", None, None), (6, "Released under the MIT License.\n" * 2, "en", "a"), (7, mit[: len(mit) // 2], "en", "a")]
    got = collections.defaultdict(list)
    for r in licenses.findings(table(spark, rows)).collect():
        got[r.doc_id].append(r)
    assert {k: [r.license for r in v] for k, v in got.items()} == {1: ["mit"], 2: ["mit"], 6: ["mit-line", "mit-line"]}
    one = got[1][0]
    assert one.coverage == 1.0 and rows[0][1][one.span_start : one.span_end].startswith("Permission is hereby") and 0.9 < got[2][0].coverage < 1
    assert [(r.span_start, r.span_end) for r in sorted(got[6], key=lambda r: r.span_start)] == [(0, 30), (32, 62)]
    assert licenses.findings(table(spark, rows).limit(0)).count() == 0


def test_license_scan_against_unbanded_alignment(spark):
    """Edited and partial notices against a plain longest common subsequence of words, without a band or an index."""
    rnd = random.Random(7)
    few = {k: licenses.TEMPLATES[k] for k in ("mit", "isc", "zlib", "unlicense", "bsl-1.0")}
    plain = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    rows = []
    for i in range(60):
        w = few[rnd.choice(list(few))].split()
        for _ in range(rnd.randrange(0, 12)):
            at = rnd.randrange(len(w))
            w[at : at + 1] = rnd.choice([[], [w[at], "foo"], ["bar"]])
        cut = rnd.choice([0, 0, len(w) // 8, len(w) // 3])
        rows.append((i, words(rnd, 12) + " " + " ".join(w[cut:]) + " " + words(rnd, 12), "en", "a"))

    def common(a, b):
        best = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(best[j] + 1 if x == y else max(best[j + 1], new[j]))
            best = new
        return best[-1]

    want = {}
    for i, t, *_ in rows:
        share = {k: common(plain(t), plain(v)) / len(plain(v)) for k, v in few.items()}
        top = max(share, key=share.get)
        if share[top] >= licenses.COVERAGE:
            want[i] = (top, share[top])
    got = {r.doc_id: (r.license, r.coverage) for r in licenses.findings(table(spark, rows), templates=few).collect()}
    assert len(want) > 30 and set(got) <= set(want) and all(got[i][0] == want[i][0] and got[i][1] <= want[i][1] + 1e-9 for i in got)
    assert len(got) >= 0.95 * len(want)
    ties = licenses.findings(table(spark, [(1, few["mit"], "en", "a")] * 3), templates={"b": few["mit"], "a": few["mit"]}).collect()
    assert [(r.doc_id, r.license) for r in ties] == [(1, "a")] * 3


# -- 6 --------------------------------------------------------------------------------------------


def _language(rnd, n, parts):
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4))) for _ in range(n))


def test_language_id(spark):
    rnd = random.Random(3)
    kinds = {"aa": ["tion", "the", "ing", "er"], "bb": ["schaft", "ung", "ß", "keit"], "cc": ["ção", "ña", "os", "el"]}
    rows = [(i, _language(rnd, rnd.randrange(3, 80), kinds[k]), k, "s") for i, k in enumerate(list(kinds) * 40)]
    data = table(spark, rows)
    held = langid.remainder("doc_id", 3) == 1
    model = langid.fit(data.where(~held))
    got = langid.predict(data, model).where(held).collect()
    assert len(got) > 20 and sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got) and not any(r.rejected for r in got)
    odd = table(spark, [(1, None, None, None), (2, "", None, None), (3, "123 !? 5", None, None), (4, "the" * 20000, "aa", "s"), (5, "ひらがな", None, None)])
    out = {r.doc_id: (r.lang_pred, r.rejected) for r in langid.predict(odd, model).collect()}
    assert out[1] == out[2] == out[3] == ("und", True) and out[4] == ("aa", False) and out[5][0] in kinds
    assert langid.predict(data.limit(0), model).count() == 0
    blank = langid.predict(odd, langid.fit(data.limit(0))).collect()
    assert {r.lang_pred for r in blank} == {"und"}


def test_language_id_is_plain_nearest_centroid(spark):
    """Scores against a plain version: dictionaries of n-grams, weights and cosines."""
    import math

    import numpy as np

    rnd = random.Random(4)
    kinds = {"aa": ["tion", "the", "ing"], "bb": ["schaft", "ung", "keit"]}
    rows = [(i, _language(rnd, rnd.randrange(2, 30), kinds[k]), k, "s") for i, k in enumerate(list(kinds) * 30)]
    data = table(spark, rows)
    model = langid.fit(data)

    def grams(t):
        clean = re.sub(r"[^a-z\x80-\U0010ffff]+", " ", t.lower()).encode()
        out = collections.Counter()
        for n in langid.GRAMS:
            for i in range(len(clean) - n + 1):
                h = 0
                for b in clean[i : i + n]:
                    h = (h + b) * 0x9E3779B1 & 0xFFFFFFFF
                    h ^= h >> 15
                out[h % langid.DIMS] += 1
        return out

    texts = [grams(t) for _, t, *_ in rows]
    df = collections.Counter(f for g in texts for f in g)
    idf = {f: math.log((1 + len(rows)) / (1 + n)) + 0.05 for f, n in df.items()}
    for r in langid.predict(data, model).collect():
        v = np.zeros(langid.DIMS)
        for f, n in texts[r.doc_id].items():
            v[f] = math.log1p(n) * idf[f]
        cosine = model.centroids @ (v / np.linalg.norm(v))
        assert abs(cosine.max() - r.score) < 1e-4 and model.langs[model.lang_of[cosine.argmax()]] == r.lang_pred


# -- 7 --------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rnd = random.Random(5)
    bad = ["scumbag", "idiotic", "moronic"]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 6 == 0
        t = words(rnd, 30, "abcdefgh").split() + ([rnd.choice(bad) for _ in range(2)] if toxic else [])
        rnd.shuffle(t)
        rows.append((i, " ".join(t), "en", "s"))
        if i % 3 == 0:
            marks.append((i, int(toxic)))
    data, labels = table(spark, rows), spark.createDataFrame([*marks, (None, 1), (9999, None)], "doc_id long, toxic int")
    learn = langid.remainder("doc_id", 5) != 0
    model = toxicity.fit(data.where(learn), labels.where(learn))
    got = toxicity.score(data, model).where(~learn).collect()
    hit = [r.predicted for r in got if r.doc_id % 6 == 0]
    miss = [r.predicted for r in got if r.doc_id % 6]
    assert sum(hit) >= 0.9 * len(hit) and sum(miss) <= 0.05 * len(miss) and all(0 <= r.score <= 1 for r in got)
    odd = toxicity.score(table(spark, [(1, None, None, None), (2, "", None, None), (3, "idiotic " * 20000, None, None)]), model).collect()
    assert [r.predicted for r in sorted(odd, key=lambda r: r.doc_id)] == [0, 0, 1]
    none = toxicity.fit(data, labels.where("toxic = 7"))
    assert {r.score for r in toxicity.score(data, none).limit(5).collect()} == {0.0}
    assert toxicity.score(data.limit(0), model).count() == 0


def test_toxicity_is_the_corrected_risk(spark):
    """Training lowers the non-negative risk of plain numpy, and scores are a plain sum of weights."""
    import numpy as np

    rng = np.random.default_rng(3)
    xp = (rng.random((200, 5)) < [0.9, 0.8, 0.5, 0.5, 0.5]).astype(np.float32)
    xu = np.concatenate([(rng.random((160, 5)) < [0.9, 0.8, 0.5, 0.5, 0.5]), (rng.random((640, 5)) < [0.1, 0.1, 0.5, 0.5, 0.5])]).astype(np.float32)
    hashes = np.arange(5, dtype=np.uint64)

    def risk(m):
        loss = lambda x, y: (1 / (1 + np.exp(y * (x @ m.weights + m.bias)))).mean()
        return 0.2 * loss(xp, 1) + max(0.0, loss(xu, -1) - 0.2 * loss(xp, -1))

    blank = toxicity.Model(hashes, np.zeros(5), 0.0)
    model = toxicity.train(hashes, xp, xu, 0.2)
    assert risk(model) < 0.4 * risk(blank) and model.weights[:2].min() > abs(model.weights[2:]).max()
    raw = "alpha beta alphabet".encode()  # three words, and one beginning that two of them share
    row, h = toxicity.words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    made = toxicity.Model(np.sort(h), np.arange(len(h), dtype=float), -1.0)
    assert len(h) == 4 and abs(made.scores(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0] - 1 / (1 + np.exp(-(sum(range(4)) - 1)))) < 1e-12


# -- 8 --------------------------------------------------------------------------------------------


def _measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = collections.defaultdict(list)
    for i in range(len(w) - 4):
        seen[tuple(w[i : i + 5])].append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    split = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(split) - len(set(split)), len(covered), len(split)


def test_quality_ledger(spark, rows):
    more = [*rows, (50, "a b c d e f a b c d e x a b c d e f", "en", "a"), (51, "# * x|y\nq\nq\n q", "en", "a"), (52, "a " * 4000, "en", "a")]
    book = quality.ledger(table(spark, more))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) for r in book.collect()), key=key)
    assert got == sorted(((i, *_measures(t)) for i, t, *_ in more), key=key)
    rules = {r.rule: r for r in quality.ablations(book, "v1").collect()}
    kept = book.where(quality.passes("v1")).count()
    for name, cond in quality.RULES.items():
        assert rules[name].n_failed == book.where(cond).count()
        rest = quality.policy_mask(tuple(r for r in quality.RULES if r != name))
        assert rules[name].n_kept_without == kept + rules[name].n_only == book.where(F.col("fail_bits").bitwiseAND(F.lit(rest)) == 0).count()
    assert quality.ledger(table(spark, more).limit(0)).count() == 0


# -- 9 --------------------------------------------------------------------------------------------


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rnd = random.Random(8)
    rows = [(i, words(rnd, rnd.randrange(0, 30)), "en", rnd.choice(["hot", "hot", "hot", "b", "ä", None])) for i in range(300)]
    rows += [(400, None, None, "empty"), rows[0], rows[0]]
    got = mixing.decisions(table(spark, rows)).collect()
    size = collections.Counter()
    for _, t, _, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, level = 1.5 * sum(size.values()), None
    done, open_ = 0, sum(weight.values())
    for s in sorted(order, key=lambda s: 2 * size[s] / weight[s]):
        level = (budget - done) / open_
        if level <= 2 * size[s] / weight[s]:
            break
        done, open_ = done + 2 * size[s], open_ - weight[s]
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - min(weight[r.source] * level, 2 * size[r.source])) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size) and len(r.finish_times) == r.copies
        taken[r.source] += r.taken
    assert len(got) == len(rows) and abs(sum(taken.values()) - budget) <= 90
    assert all(abs(taken[r.source] - r.target) <= 90 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.decisions(table(spark, rows).repartition(5)).collect()))
    mixed = mixing.mix(table(spark, rows))
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(taken.values())
    assert mixing.decisions(table(spark, rows).limit(0)).count() == 0 and mixing.mix(table(spark, rows).limit(0)).count() == 0


# -- 10 -------------------------------------------------------------------------------------------


def _print_of(t):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    votes = [sum(xxhash.xxh64_intdigest(s.encode(), seed=42) >> b & 1 for s in sh) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(sh))


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash(spark, rows, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "STRIPE", 2)
    rnd = random.Random(6)
    base = words(rnd, 400, "abcdefghij").split()
    near = [(200 + i, " ".join(base[:k] + ["zz"] + base[k:]), "en", "a") for i, k in enumerate(rnd.sample(range(400), 30))]
    every = [*rows, *near]
    prints = [_print_of(t) for _, t, *_ in every]
    parent = list(range(len(every)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(every)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for i, (d, *_) in enumerate(every):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    want = sorted(((d, f"{prints[i]:016x}", least.get(root(i))) for i, (d, *_) in enumerate(every)), key=key)
    got = simhash.near_duplicates(table(spark, every))
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    if tile == 3:
        stay = simhash.keep_one(table(spark, every))
        assert {r.doc_id for r in stay.collect()} - {None} == set(least.values())
        assert simhash.near_duplicates(table(spark, every).limit(0)).count() == 0
