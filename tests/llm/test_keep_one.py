"""Null and repeated ids in near deduplication by fingerprints."""

from pisteflow.llm import simhash


def test_null_and_repeated_ids(spark):
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue white black grey")
    docs = spark.createDataFrame([(None, a), (None, a), (7, b), (7, b), (None, c), (3, c)], "doc_id long, text string").coalesce(1)
    assert sorted(((r.doc_id or 0), r.text) for r in simhash.keep_one(docs).collect()) == sorted([(0, a), (7, b), (3, c)])
