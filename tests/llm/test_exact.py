"""The filter of exact deduplication at its bound."""

from pisteflow.llm import exact


def test_full_filter_only_shuffles_more(spark, monkeypatch):
    monkeypatch.setattr(exact, "FILTER_WORDS", 256)
    docs = spark.createDataFrame([(i, f"text {i % 2500}") for i in range(3000)], "doc_id long, text string")
    out = exact.exact_dedup(docs, rows=1 << 40)
    assert out.where("kept").count() == 2500 and out.count() == 3000


def test_only_candidates_shuffle(spark):
    """No exchange holds a row that the filter passes, and the probe is a broadcast."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.createDataFrame([(i, f"text {i % 90}") for i in range(100)], "doc_id long, text string")
        plan = exact.exact_dedup(docs, rows=100_000_000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    alone = plan.split("Union")[1].split("SortMergeJoin")[0].split("BroadcastHashJoin")
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in alone[0] + alone[1].split("BroadcastExchange")[0]
