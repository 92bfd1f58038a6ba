"""Extra columns of any name, odd ids, empty tables and long texts in operators and stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pisteflow.llm import bpe, exact, langid, licenses, lines, mixing, quality, simhash, suffixes, toxicity

NAMES = (
    "starts", "gone", "finish_times", "finish_time", "__n", "score", "rejected", "lang_pred", "predicted", "kept", "keep_id", "group_size", "text_sha256", "spans", "n_lines", "n_dropped", "kept_text",
    "row", "node", "band", "pop", "component", "place", "at", "key", "h", "p", "id", "size", "words", "copies", "fp", "fingerprint", "component_id", "ids", "decoded", "n_bytes", "row_id", "row_hash", "a.b",
)
OWN = ("doc_id", "text", "lang", "source")


def _docs(spark, kind="long"):
    rnd = random.Random(4)
    some = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    texts = [some(rnd.randrange(5, 90)) for _ in range(20)]
    texts += [texts[0], texts[1] + " tail", None, "", "x" * 3000, some(200_000)]
    rows = [(None if k % 7 == 3 else k // 2, t, "en", "ab"[k % 2]) for k, t in enumerate(texts)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("doc_id", F.col("doc_id").cast(kind))
    return df.select("*", *(F.lit(-7).alias(n) for n in NAMES)).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark).cache()


def _operators():
    toy = {bytes([b]): b for b in range(256)}
    import public_tokenizers as P

    return {
        "bpe": lambda d: bpe.encode_decode(d, toy, P.PATTERN, outputs=("ids", "decoded")),
        "suffixes": lambda d: suffixes.remove_repeats(d),
        "lines": lambda d: lines.dedup_lines(d, min_docs=3),
        "exact": lambda d: exact.exact_dedup(d),
        "licenses": lambda d: licenses.findings(d),
        "langid": lambda d: langid.predict(d, langid.fit(d)),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, d.select("doc_id", F.lit(1).alias("toxic")))),
        "quality": lambda d: quality.ledger(d),
        "mixing": lambda d: mixing.mix(d),
        "simhash": lambda d: simhash.near_duplicates(d),
    }


@pytest.mark.parametrize("name", list(_operators()))
def test_operators_keep_extra_columns(docs, name):
    out = _operators()[name](docs)
    untouched = [c for c in out.columns if c in NAMES and out.schema[c].dataType.simpleString() == "int" and c not in ("predicted",)]
    rows = out.collect()
    assert all(r[c] == -7 for r in rows for c in untouched)
    if name in ("suffixes", "lines", "exact", "mixing"):
        assert "a.b" in untouched and "starts" in untouched and "gone" in untouched and "__n" in untouched
    if name not in ("licenses", "mixing"):
        assert len(rows) == docs.count()


@pytest.mark.parametrize("name", ["suffixes", "lines", "exact", "mixing", "langid"])
def test_text_ids(spark, docs, name):
    op = _operators()[name]
    as_text = _docs(spark, "string").withColumn("doc_id", F.concat(F.lit("d-"), "doc_id"))
    assert op(as_text).count() == op(docs).count() or name == "mixing"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, "")
    rows = out.collect()
    if name != "tokens":
        assert out.columns == docs.columns and rows and all(r[n] == -7 for r in rows for n in NAMES)
        if name in ("exact_copies", "near_copies"):
            assert any(r.text and len(r.text) > 500_000 for r in rows) and sum(not r.text for r in rows) == 1
    else:
        assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    empty = stage(spark, docs.limit(0), "")
    assert empty.count() == 0 and empty.columns == out.columns


@pytest.mark.parametrize("name", ["langid", "toxicity"])
def test_layout_does_not_matter(spark, monkeypatch, name):
    monkeypatch.setattr(langid, "SAMPLE_PER_LANG", 40)
    monkeypatch.setattr(toxicity, "UNLABELLED", 60)
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "awful", "nu"]) + str(rnd.randrange(9)) for _ in range(12)), "ab"[i % 2]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int("awful" in t)) for i, t, _ in rows], "doc_id long, toxic int")

    def scores(d):
        out = langid.predict(d, langid.fit(d)) if name == "langid" else toxicity.score(d, toxicity.fit(d, labels))
        return {r.doc_id: r.score for r in out.collect()}

    assert scores(docs.repartition(3)) == scores(docs.repartition(7))
