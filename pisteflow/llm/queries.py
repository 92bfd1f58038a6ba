"""Registered queries of the operators in this subpackage, with their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pisteflow.llm import bpe, exact, langid, licenses, lines, mixing, quality, simhash, suffixes, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text; digests of the ids and of the decoded bytes."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = bpe.encode_decode(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, outputs=("ids_text", "decoded"), keep=["doc_id"])
    return out.select(
        "doc_id",
        F.when(F.col("ids_text") == "", F.lit(0)).otherwise(F.length("ids_text") - F.length(F.replace("ids_text", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_tokens"),
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that repeated strings of 200 bytes cover, and a digest of the rest."""
    out = suffixes.remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document whose key is in ten documents or more, and a digest of the rest."""
    out = lines.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of the equal document that stays."""
    return exact.exact_dedup(_documents(spark, sf_dir), keep=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice found in any whole text, with coverage and span."""
    return licenses.findings(_documents(spark, sf_dir).select("doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learnt from the rows that are not held out."""
    docs = _documents(spark, sf_dir)
    held_out = langid.remainder("doc_id", 3) == 1
    model = langid.fit(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from the labels of the rows that are not held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = langid.remainder("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    out = toxicity.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, and the verdict of the current policy."""
    book = quality.ledger(_documents(spark, sf_dir))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"), quality.passes("v1").alias("kept"), "n_lines", "fail_bits",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the weighted mix takes of every document."""
    return mixing.decisions(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_documents(spark, sf_dir), words=4, radius=4)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_simhash": op10_simhash,
}

_WS = "[\\x20\\x09-\\x0D]"

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        x AS (
            SELECT doc_id, i, l[i] AS line,
                translate(regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
        gone AS (SELECT key FROM x WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
        y AS (SELECT *, key IN (SELECT key FROM gone) AS drops FROM x)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drops) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT drops), '')) AS kept_sha256
        FROM y GROUP BY doc_id""",
    "op4_exact_dedup": rf"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                sha256(regexp_replace(coalesce(text, ''), '{_WS}+', '', 'g')) AS text_sha256
            FROM documents),
        g AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op8_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                length(regexp_replace(text, '{_WS}+', '', 'g')) AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM d),
        s AS (
            SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
        r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM s),
        c AS (
            SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
            FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r WHERE n > 1)
            GROUP BY doc_id),
        m AS (
            SELECT doc_id, len(w) AS n_words, word_chars, n_symbols,
                len(l) - len(list_distinct(l)) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines
            FROM w LEFT JOIN c USING (doc_id)),
        b AS (
            SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
                + 4 * (2 * n_symbols > 3 * n_words)::BIGINT + 8 * (word_chars > 30 * n_words)::BIGINT
                + 16 * (n_lines > 3 AND 2 * n_dup_lines > n_lines)::BIGINT AS fail_bits
            FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines, fail_bits
        FROM b""",
    "op9_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::BIGINT AS size,
                md5(coalesce(doc_id::VARCHAR, '')) AS key
            FROM documents),
        p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        q AS (
            SELECT *, [3, 1, 2][1 + (place - 1) % 3] AS weight
            FROM (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM p)),
        o AS (
            SELECT *, 2 * source_size AS most, (2 * source_size)::DOUBLE / weight AS runs_out,
                sum(source_size) OVER () * 1.5::DOUBLE AS budget
            FROM q),
        l AS (
            SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY runs_out, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY runs_out, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t
            FROM o),
        v AS (SELECT *, coalesce((min({'o': runs_out, 'p': place, 't': t}) FILTER (t <= runs_out) OVER ()).t, max(runs_out) OVER ()) AS level FROM l),
        s AS (SELECT *, least(weight * level, most::DOUBLE) AS target FROM v),
        u AS (
            SELECT d.*, s.place, s.weight, s.source_size, s.target, s.budget,
                sum(size) OVER (PARTITION BY s.place ORDER BY key, doc_id, size) AS upto
            FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
        c AS (
            SELECT *, (upto + copy * source_size)::DOUBLE / weight AS finish
            FROM u, (SELECT unnest([0, 1]) AS copy)),
        k AS (SELECT *, sum(size) OVER (ORDER BY finish, place, copy, key, doc_id, size) AS total FROM c)
        SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
            (any_value(size) * count(*) FILTER (total <= budget))::BIGINT AS taken
        FROM k GROUP BY doc_id""",
}
