"""The corpus pipeline over the smallest tables, stage by stage."""

import corpus_pipeline

import __spark_entry__
from pisteflow.llm import langid, quality, queries

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = out.cache()
            assert 0 < docs.count() <= 2 * n
    assert out.where("not round_trip or n_tokens <> size(ids)").count() == 0
    assert out.count() == docs.count()


def test_rejects_texts_without_letters(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.limit(2).selectExpr("doc_id + 100000 as doc_id", "case when doc_id % 2 = 0 then null else '12 34' end as text", "lang", "source", "n_chars")
    kept = corpus_pipeline.language(spark, docs.union(odd), SMALL)
    assert kept.where("doc_id >= 100000").count() == 0 and kept.count() == docs.count()


def test_all_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and langid.UNKNOWN == "und" and "v1" in quality.POLICIES
