"""The whole pipeline, stage by stage, against a plain version in Python on a small table."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from pisteflow.llm import langid
from tests.llm.test_similar import stays

SCHEMA = "doc_id long, text string, lang string, source string"
ENDINGS = {"aa": ["tion", "the", "ing", "ous"], "bb": ["schaft", "ung", "keit", "lich"]}
NAMES = ("doc_id", "text", "lang", "source")


def documents():
    rnd = random.Random(31)

    def text(kind, n):
        return " ".join("".join(rnd.choice("abcdeghilmnoprstu") for _ in range(rnd.randrange(1, 4))) + rnd.choice(ENDINGS[kind]) for _ in range(n))

    def edited(t, at):
        w = t.split()
        return " ".join(w[:at] + ["changed"] + w[at + 1 :])

    kinds = list(ENDINGS)
    rows = [(i, text(kinds[i % 2], rnd.randrange(20, 90)), kinds[i % 2], rnd.choice(["hot", "hot", "b", None])) for i in range(120)]
    rows += [(200 + i, text(kinds[i % 2], 3), kinds[i % 2], "short") for i in range(6)]
    # Copies: alike, longer by white space, with a lesser id, without an id.
    rows += [rows[3], (300, rows[4][1] + " \n", "aa", "b"), (-5, rows[5][1], "bb", None), (None, rows[6][1], "aa", "hot")]
    # Near copies, chained: each is like the one before; one of them has no id.
    for k in range(8):
        base = text(kinds[k % 2], 100)
        chain = [base]
        for at in (20, 50, 80):
            chain.append(edited(chain[-1], at))
        rows += [(400 + 10 * k + j, t, kinds[k % 2], "near") for j, t in enumerate(chain)]
    rows.append((None, edited(rows[7][1], 0), "bb", "hot"))
    # Half changed texts are no near copies; one id for two texts; a very long text.
    half = text("aa", 80).split()
    rows += [(600, " ".join(half), "aa", "b"), (601, " ".join(half[:40] + text("aa", 40).split()), "aa", "b")]
    rows += [(700, text("bb", 40), "bb", "b"), (700, text("bb", 50), "bb", "b"), (701, text("aa", 6000), None, "b")]
    # Without letters, without text, or like no language.
    rows += [(800, None, "aa", "b"), (801, "", None, "b"), (802, "12 34 !!", "bb", None), (803, "xqzj kvwx " * 30, None, "hot"), (None, None, None, None)]
    return rows


def language(rows, model):
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

    texts = [grams(r[1] or "") for r in rows]
    learnt = [g for r, g in zip(rows, texts, strict=True) if r[1] is not None and r[2] is not None and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 != 1]
    df = collections.Counter(f for g in learnt for f in g)
    kept = []
    for r, g in zip(rows, texts, strict=True):
        if not any(c.isalpha() for c in r[1] or ""):
            continue
        v = np.zeros(langid.DIMS)
        for f, n in g.items():
            v[f] = math.log1p(n) * (math.log((1 + len(learnt)) / (1 + df[f])) + 0.05)
        cosine = model.centroids @ (v / np.linalg.norm(v))
        if cosine.max() >= model.least[model.lang_of[cosine.argmax()]] * math.sqrt(min(1, sum(g.values()) / langid.FULL_GRAMS)):
            kept.append(r)
    return kept


def exact_copies(rows):
    best = {}
    for k, r in enumerate(rows):
        bare = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        best[bare] = min(best.get(bare, (1,)), (-len(r[1] or ""), r[0] is None, r[0] or 0, k))
    return [rows[k] for *_, k in best.values()]


def near_copies(rows):
    return [rows[k] for k in stays([r[:2] for r in rows])]


def mixed(rows):
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    total = collections.Counter()
    for r in rows:
        total[r[3]] += size(r)
    place = {s: k for k, s in enumerate(sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [s for s in total if s is None])}
    weight = {s: (3, 1, 2)[k % 3] for s, k in place.items()}
    alike = collections.defaultdict(list)
    for r in rows:
        alike[r[0], r[3], size(r)].append(r)
    upto, copies = collections.Counter(), []
    md5 = lambda i: hashlib.md5(str("" if i is None else i).encode()).hexdigest()
    for (i, s, n), some in sorted(alike.items(), key=lambda g: (md5(g[0][0]), g[0][0] is not None, g[0][0] or 0, g[0][2])):
        upto[s] += n * len(some)
        copies += [((upto[s] + c * total[s]) / weight[s], place[s], c, md5(i), i is not None, i or 0, n, len(copies), some) for c in (0, 1)]
    out, taken = [], 0
    for *_, n, _, some in sorted(copies, key=lambda c: c[:8]):
        taken += n * len(some)
        if taken > 1.5 * sum(total.values()):
            break
        out += some
    return out


def tokens(rows):
    tiktoken = pytest.importorskip("tiktoken")
    from pisteflow.llm import bpe

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    return [(i, lang, s, tuple(own.encode_ordinary(t or "")), True) for i, t, lang, s in rows]


def test_every_stage_is_the_plain_one(spark, tmp_path, monkeypatch):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    between, write = {}, corpus_pipeline.materialize

    def watched(df, name):
        between[name] = write(df, name)
        return between[name]

    monkeypatch.setattr(corpus_pipeline, "materialize", watched)
    final = corpus_pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = langid.fit(docs.where(langid.remainder("doc_id", 3) != 1))

    known = language(rows, model)
    single = exact_copies(known)
    apart = near_copies(single)
    mix = mixed(apart)
    gone = {r[0] for r in rows} - {r[0] for r in known}
    assert {800, 801, 802, 803} <= gone and len(known) - len(single) == 4 and len(single) - len(apart) == 25
    assert 0 < len(mix) < 2 * len(apart) and max(collections.Counter(mix).values()) == 2
    assert [n for n, _ in corpus_pipeline.STAGES][:-1] == list(between)
    for name, want in zip(between, (known, single, apart, mix), strict=True):
        got = [tuple(r[c] for c in NAMES) for r in between[name].collect()]
        assert sorted(map(str, got)) == sorted(map(str, want)), name
    got = [(r.doc_id, r.lang, r.source, tuple(r.ids), r.round_trip) for r in final.collect()]
    assert sorted(map(str, got)) == sorted(map(str, tokens(mix)))
