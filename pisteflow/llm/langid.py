"""Language identification by nearest centroid (operator 6).

A text is a vector of hashed byte n-grams (lower case; what isn't a letter is one space), weighted
by log term frequency and inverse document frequency and scaled to length one. Each language has
several centroids, found by spherical k-means. A text takes the language of the centroid of
highest cosine, and is rejected where that cosine lies far below what the language's own texts
have.

Document frequencies are counted over all learning rows. Centroids and rejection distances are fit
on a sample of SAMPLE_PER_LANG rows of each language, SAMPLE_TOTAL in all. Rows are drawn by a hash of
id and text, so the draw, and with it every prediction, doesn't depend on how the rows are dealt out.

Defined results: null text and text without a letter are `und`, score 0, rejected; a text with a
letter but without an n-gram gets a language with score 0 and isn't rejected; long texts are read
whole; equal texts get equal results; rows alike in id and text are drawn as one; if nothing can be learnt every text is `und`; an empty
table gives an empty table; extra columns pass through and input columns named like an output
column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.llm import textkernels as tk

#: Hashed n-gram features.
DIMS = 1 << 13
GRAMS = (2, 3)
CENTROIDS = 4
#: Bounds of the sample that centroids are fit on, in expectation: of each language, and of all.
SAMPLE_PER_LANG, SAMPLE_TOTAL = 800, 8000
#: A text is rejected under this share of the low cosine (first percentile) of its language. The
#: cosine of a short text is low by nature, so for fewer than FULL_GRAMS n-grams the limit falls
#: with the square root of their number.
REJECT_SHARE, FULL_GRAMS = 0.5, 600
UNKNOWN = "und"
OUTPUTS = ("lang_pred", "score", "rejected")


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with every run of other characters as one space; rows end in a space."""
    data = tk.lowered(data)
    return np.where(((data >= 97) & (data <= 122)) | (data >= 128), data, np.uint8(32))


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x DIMS counts of hashed n-grams."""
    n = len(offsets) - 1
    out = np.zeros((n, DIMS), dtype=np.float32)
    if not len(data):
        return out
    text = _letters(data)
    row = np.repeat(np.arange(n), np.diff(offsets))
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32) | (row[1:] != row[:-1])
    text, row = text[keep].astype(np.uint32), row[keep]
    total = np.zeros(n * DIMS, dtype=np.int64)
    for k in GRAMS:
        if len(text) < k:
            continue
        h = np.zeros(len(text) - k + 1, dtype=np.uint32)
        for i in range(k):
            h = (h + text[i : len(text) - k + 1 + i]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        same = row[k - 1 :] == row[: len(row) - k + 1]
        total += np.bincount((row[: len(h)] * DIMS + (h % DIMS))[same], minlength=n * DIMS)
    return total.reshape(n, DIMS).astype(np.float32)


def _packed(row: np.ndarray) -> bytes:
    """Places and counts of the n-grams that a row has."""
    at = np.flatnonzero(row)
    return at.astype(np.uint16).tobytes() + row[at].astype(np.float32).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    n, out = len(raw) // 6, np.zeros(DIMS, np.float32)
    out[np.frombuffer(raw, np.uint16, n)] = np.frombuffer(raw[2 * n :], np.float32)
    return out


def _blocks(column: pa.Array, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for base in range(0, len(column), rows):
        for _, _, data, offsets in tk.runs(column.slice(base, rows)):
            yield data, offsets


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # centroids x DIMS
    lang_of: np.ndarray  # index into langs for each centroid
    least: np.ndarray  # cosine for each language under which a text is rejected

    def vectors(self, c: np.ndarray) -> np.ndarray:
        x = np.log1p(c) * self.idf
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.maximum(norm, 1e-12)

    def predict(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.langs):
            return np.zeros(len(c), int), np.zeros(len(c))
        cosine = self.vectors(c) @ self.centroids.T
        best = cosine.argmax(axis=1)
        return self.lang_of[best].copy(), cosine[np.arange(len(c)), best].astype(float)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; starts from far apart rows."""
    k = min(k, len(x))
    chosen = [int(rng.integers(len(x)))]
    for _ in range(k - 1):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    c = x[chosen]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def draw(seed: int, id_col: str, text_col: str) -> Column:
    """A number from 0 to 1 for each row, by its id and text: the same however rows are dealt out."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 11) / float(1 << 53)


def fit(learn: DataFrame, text_col: str = "text", lang_col: str = "lang", seed: int = 7, id_col: str = "doc_id") -> Model:
    """Learn from rows with a non-null language."""
    learn = learn.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw(seed, id_col, text_col).alias("p"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for data, offsets in _blocks(batch.column("text")):
                held += (counts(data, offsets) > 0).sum(axis=0)
                rows += len(offsets) - 1
        feature = np.arange(-1, DIMS)
        yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(np.concatenate(([rows], held)))], names=["feature", "n"])

    # One row a feature, DIMS + 1 in all.
    seen = dict(learn.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect())
    total = seen.get(-1, 0)
    df = np.array([seen.get(k, 0) for k in range(DIMS)], dtype=np.float64)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.05)

    sizes = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}
    most = min(SAMPLE_PER_LANG, SAMPLE_TOTAL // max(1, len(sizes)))
    shares = [F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, most / n))]
    sample = learn.where(F.col("p") < F.element_at(F.create_map(*shares), F.col("lang"))).dropDuplicates(["lang", "p"]) if sizes else None

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base in range(0, batch.num_rows, 256):
                part = batch.slice(base, 256)
                vec = [_packed(r) for data, offsets in _blocks(part.column("text")) for r in counts(data, offsets)]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("p"), pa.array(vec, pa.binary())], names=["lang", "p", "vec"])

    rows = [] if sample is None else sorted((r["lang"], r["p"], r["vec"]) for r in sample.mapInArrow(featurise, "lang string, p double, vec binary").collect())
    rng = np.random.default_rng(seed)
    langs = sorted({r[0] for r in rows})
    centroids, lang_of, least = [], [], []
    model = Model(langs, idf, np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    for k, lang in enumerate(langs):
        x = np.stack([_unpacked(r[2]) for r in rows if r[0] == lang])
        v = model.vectors(x)
        c = _kmeans(v, CENTROIDS, rng)
        centroids.append(c)
        lang_of += [k] * len(c)
        least.append(REJECT_SHARE * float(np.quantile((v @ c.T).max(axis=1), 0.01)))
    if langs:
        model = Model(langs, idf, np.concatenate(centroids).astype(np.float32), np.array(lang_of), np.array(least))
    return model


def predict(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds lang_pred, score (cosine, 0 to 1) and rejected, without a shuffle."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in OUTPUTS]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    held = df.sparkSession.sparkContext.broadcast(model)  # languages x CENTROIDS x DIMS floats
    at = "__langid_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        for batch in batches:
            lang, score, limit = [], [], []
            for data, offsets in _blocks(batch.column(at)):
                c = counts(data, offsets)
                k, s = m.predict(c)
                low = tk.lowered(data)
                latin = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122))))[offsets]
                other = np.flatnonzero(latin[1:] == latin[:-1])  # rows without A-Z, a-z: any letter else?
                empty = [i for i in other if not any(ch.isalpha() for ch in data[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace"))]
                k[empty], s[empty] = len(m.langs), 0.0
                lang.append(k if m.langs else np.zeros(len(k), int))
                score.append(np.clip(s, 0.0, 1.0))
                limit.append(np.append(m.least, 2.0)[lang[-1]] * np.where(k == len(m.langs), 1, np.sqrt(np.minimum(1, c.sum(axis=1) / FULL_GRAMS))))
            k = np.concatenate(lang) if lang else np.zeros(0, int)
            s = np.concatenate(score) if score else np.zeros(0)
            rejected = s < np.concatenate(limit) if limit else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(names[k], pa.string()), pa.array(s), pa.array(rejected)], names=[*keep, *OUTPUTS])

    return df.select(*(F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(keep)), df[text_col].alias(at)).mapInArrow(run, schema)


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; it deals rows out for learning and for holding out."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))
