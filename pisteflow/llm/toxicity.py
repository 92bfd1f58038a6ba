"""Toxicity by non-negative positive-unlabelled learning (operator 7).

A linear model over hashed words is trained in numpy from confirmed toxic texts and unlabelled
texts. The risk is that of positives, plus that of unlabelled texts less the positives' share of
it by the class prior; where that difference is negative on a batch its gradient is turned round,
as it can only come from overfitting.

Learning is bounded: at most POSITIVES and UNLABELLED texts in expectation, drawn by a hash of id
and text, so that the draw doesn't depend on how rows are dealt out. Words in at least MIN_TEXTS of
them can become features; they are counted by the cluster, and only the FEATURES chosen, and which
of them each drawn text has, come to the driver: FEATURES * 2 bytes a text at most, whatever the
texts' length. The class prior is the share of toxic rows among all labelled learning rows.

Defined results: null and empty texts have no words and get the score of the bias alone; long
texts are read whole, a word counting once; equal texts get equal scores; rows alike in id and text
are drawn as one; without positives every
score is 0; an empty table gives an empty table; extra columns pass through and input columns
named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.llm import textkernels as tk
from pisteflow.llm.langid import draw
from pisteflow.plans.lineage import discard, materialize

POSITIVES, UNLABELLED = 3000, 6000
MIN_TEXTS, STEM = 8, 4
#: Features kept: those that positives have most beyond unlabelled texts.
FEATURES = 2048
#: Share of the gradient that is turned round where the negative risk is below zero.
TURNED = 0.1
#: Standard errors by which the frequencies of a feature differ at least.
BEYOND_CHANCE = 4.5
OUTPUTS = ("score", "predicted")


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct word, and word beginning of STEM bytes, of each row.

    Words are runs of letters and digits. A beginning stands for all inflections of a word.
    """
    low = tk.lowered(data)
    other = ~(((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128))
    starts, ends, first = tk.word_spans(low, offsets, other)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    longer = ends - starts > STEM
    stems = tk.span_hashes(low, starts[longer], starts[longer] + STEM) ^ np.uint64(1)
    h = np.concatenate((tk.span_hashes(low, starts, ends), stems))
    row = np.concatenate((row, row[longer]))
    by = np.lexsort((h, row))
    row, h = row[by], h[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, h = words_of(data, offsets)
        n = len(offsets) - 1
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            w = np.where(self.words[at] == h, self.weights[at], 0.0)
            z = np.bincount(row, weights=w, minlength=n) + self.bias
        else:
            z = np.full(n, self.bias)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-z))


def train(words: np.ndarray, xp: np.ndarray, xu: np.ndarray, prior: float, seed: int = 11, epochs: int = 80, batch: int = 512, rate: float = 0.1, decay: float = 1e-6) -> Model:
    """Fit on rows of positives and of unlabelled texts that say which of the words they have (1 or 0)."""
    if not len(xp) or not len(xu):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -1000.0)
    if not len(words):
        return Model(words, np.zeros(0), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    rng = np.random.default_rng(seed)
    w, b = np.zeros(len(words)), 0.0
    m, v, step = np.zeros(len(words) + 1), np.zeros(len(words) + 1), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    rounds = max(1, len(xu) // batch)
    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(xp)), rng.permutation(len(xu))
        for k in range(rounds):
            bu = xu[order_u[k::rounds]]
            bp = xp[order_p[k::rounds]] if len(xp) >= rounds else xp
            zp, zu = bp @ w + b, bu @ w + b
            # Sigmoid loss: 1 / (1 + exp(z)) as positive, 1 / (1 + exp(-z)) as negative.
            sp, su = sigmoid(zp), sigmoid(zu)
            slope_p, slope_u = sp * (1 - sp) / len(bp), su * (1 - su) / len(bu)
            if su.mean() >= prior * sp.mean():
                dp, du = -2 * prior * slope_p, slope_u
            else:
                dp, du = TURNED * prior * slope_p, -TURNED * slope_u
            g = np.append(dp @ bp + du @ bu + decay * w, dp.sum() + du.sum())
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, b = w - change[:-1], b - change[-1]
    return Model(words, w, float(b))


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", toxic_col: str = "toxic") -> Model:
    """Learn from docs (unlabelled) and labels, which says which of them are toxic (1) or not (0).

    Of the labels only the positives' ids and the two counts are used. The drawn ids, POSITIVES at
    most in expectation, are broadcast, so no text is shuffled.
    """
    known = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    n = known.agg(F.count_if(F.col("toxic") == 1).alias("p"), F.count("*").alias("labelled")).first()
    total = docs.count()
    if not n["p"] or not total:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -1000.0)
    drawn = known.where("toxic = 1").where(draw(1, id_col, "toxic") < POSITIVES / n["p"]).select(id_col)
    columns = [F.coalesce(text_col, F.lit("")).alias("text"), draw(2, id_col, text_col).alias("p")]
    confirmed = docs.join(F.broadcast(drawn), id_col).select(F.lit(1).alias("kind"), *columns)
    # A positive may also be drawn as unlabelled text; its label is not used there.
    sample = confirmed.union(docs.select(F.lit(0).alias("kind"), *columns).where(F.col("p") < UNLABELLED / total)).dropDuplicates(["kind", "p"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base in range(0, batch.num_rows, 500):
                part = batch.slice(base, 500)
                found = []
                for _, _, data, offsets in tk.runs(part.column("text")):
                    row, h = words_of(data, offsets)
                    found += np.split(h.view(np.int64), np.searchsorted(row, np.arange(1, len(offsets) - 1)))
                yield pa.RecordBatch.from_arrays([part.column("kind"), part.column("p"), pa.array(found, pa.list_(pa.int64()))], names=["kind", "p", "words"])

    texts = materialize(sample.mapInArrow(run, "kind int, p double, words array<long>"), "drawn-texts")
    size = {r["kind"]: r["n"] for r in texts.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    chosen = _features(texts, size.get(1, 0), size.get(0, 0))

    def known_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            have = [np.flatnonzero(np.isin(chosen, np.asarray(w.values).view(np.uint64))).astype(np.uint16).tobytes() for w in batch.column("words")]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("p"), pa.array(have, pa.binary())], names=["kind", "p", "have"])

    rows = sorted((r["kind"], r["p"], r["have"]) for r in texts.mapInArrow(known_words, "kind int, p double, have binary").collect())
    discard(texts)

    def matrix(kind: int) -> np.ndarray:
        of = [np.frombuffer(r[2], np.uint16) for r in rows if r[0] == kind]
        x = np.zeros((len(of), len(chosen)), np.float32)
        for k, at in enumerate(of):
            x[k, at] = 1
        return x

    return train(chosen, matrix(1), matrix(0), n["p"] / n["labelled"])


def _features(texts: DataFrame, n_p: int, n_u: int) -> np.ndarray:
    """Hashes, sorted, of the FEATURES words that positives have most beyond unlabelled texts."""
    if not n_p or not n_u:
        return np.zeros(0, np.uint64)
    held = texts.select("kind", F.explode("words").alias("h")).groupBy("h").agg(F.count_if(F.col("kind") == 1).alias("p"), F.count_if(F.col("kind") == 0).alias("u")).where(F.col("p") + F.col("u") >= MIN_TEXTS)
    pooled = (F.col("p") + F.col("u")) / float(n_p + n_u)
    unlike = (F.col("p") / float(n_p) - F.col("u") / float(n_u)) / F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-12)) * (1 / n_p + 1 / n_u))
    top = held.select("h", unlike.alias("unlike")).where(F.col("unlike") > BEYOND_CHANCE).orderBy(F.desc("unlike"), "h").limit(FEATURES).toArrow()
    return np.sort(top.column("h").to_numpy().view(np.uint64))


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds score (0 to 1) and predicted, without a shuffle."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in OUTPUTS]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    held = df.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most
    at = "__toxicity_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [held.value.scores(data, offsets) for _, _, data, offsets in tk.runs(batch.column(at))]
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*keep, *OUTPUTS])

    return df.select(*(F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(keep)), df[text_col].alias(at)).mapInArrow(run, schema)
