"""Corpus pipeline: language ID, exact and near deduplication, mixing and tokenising of documents.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; the
result is written as Parquet and read again as the next stage's docs. All stages but the last
return the columns of ``documents``.

Defined results are those of the operators, and alike in all stages: an empty table gives an empty
table; null and empty texts have no language and go with the first stage (a stage given some keeps
them by its own rule); very long texts are taken whole; null and repeated ids are rows like any other,
told apart by number where one of several stays; extra columns of any name, also those of an
operator's outputs, stay as they are until the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pisteflow.llm import bpe, exact, langid, mixing, similar
from pisteflow.llm.columns import shielded
from pisteflow.plans.lineage import materialize


#: Columns that the operators read.
COLUMNS = ("doc_id", "text", "lang", "source")
#: Rows that go to a Python worker at once: texts are long, and each batch is held outside the heap
#: by the executor as well as by its worker.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or far from what their language looks like, go."""
    _small_batches(spark)
    model = langid.fit(docs.where(langid.remainder("doc_id", 3) != 1))
    inner, restored = shielded(docs, COLUMNS)
    return restored(langid.predict(inner, model).where(~F.col("rejected")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest document stays (then least id, null last, then the first row)."""
    inner, restored = shielded(docs, COLUMNS)
    return restored(exact.exact_dedup(inner).where("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts stays whose five-word shingles are 0.8 alike or more.

    Fingerprints in tiles give the candidates, whole sets of shingles decide. Null and empty texts
    are copies of each other; of a component the least id stays, null ids last, then the first row.
    """
    _small_batches(spark)
    return similar.keep_one(docs, words=5, similarity="4/5")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in mixing order, some twice, some not at all; null texts have no words and cost nothing."""
    inner, restored = shielded(docs, COLUMNS)
    return restored(mixing.mix(inner))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; of a null text there are none."""
    _small_batches(spark)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN, outputs=("ids", "decoded"))
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixed", mixed),
    ("tokens", tokens),
]

#: The language stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
