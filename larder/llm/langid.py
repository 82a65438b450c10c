"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters is a blank, and runs of one to three characters are
hashed. Document frequencies come from all training documents. The weights are trained by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of each language; most
stay exactly zero. A temperature fitted on a part that the training did not see calibrates the scores.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import with_sampled_text

SPACE = 1 << 16                     # hashed n-grams
SAMPLE = 1_000                      # documents of a language that a fit may bring to the driver
EPOCHS, RATE, BETA = 3, 0.5, 0.1
L1, L2 = 0.02, 0.01
UNKNOWN = "und"

_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Lower-case letter of each code point of the first plane, else a blank."""
    if not _letters:
        _letters.append(np.array(
            [ord(c.lower()[0]) if c.isalpha() else 32 for c in map(chr, range(SPACE))], np.uint32))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text and their counts; none if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _letter_table()[np.minimum(points, SPACE - 1)]
    if len(points) and points.max() >= SPACE:
        far = points >= SPACE
        low[far] = [p if chr(p).isalpha() else 32 for p in points[far]]
    blank = low == 32
    if blank.all():
        return np.empty(0, np.int64), np.empty(0)
    low = low[~(blank & np.concatenate([[False], blank[:-1]]))]
    x = np.concatenate([[32], low, [32]]).astype(np.uint32)
    one, two = x * _A, (x[:-1] * _B) ^ (x[1:] * _C + _A)
    three = (two[:-1] * _A) ^ (x[2:] * _B + _C)
    counts = sum(np.bincount(((h ^ (h >> np.uint32(15))) * _C) >> np.uint32(16), minlength=SPACE)
                 for h in (one, two, three))
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray        # n-gram x language
    temperature: float

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        at, counts = grams(text)
        return at, _weighted(at, counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        at, x = self.vector(text)
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0
        p = _softmax(x @ self.weights[at] / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / (np.sqrt(x @ x) or 1.0) if len(at) else x


def _softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int) -> np.ndarray:
    """Weights (n-gram x class) after EPOCHS passes of follow-the-regularised-leader."""
    z, n = np.zeros((SPACE, classes)), np.zeros((SPACE, classes))

    def weights(at):
        za, na = z[at], n[at]
        w = -(za - np.sign(za) * L1) / ((BETA + np.sqrt(na)) / RATE + L2)
        return np.where(np.abs(za) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for (at, x), k in zip(rows, y):
            w = weights(at)
            p = _softmax(x @ w)
            p[k] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / RATE
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(SPACE))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the smallest log loss."""
    if not len(y):
        return 1.0

    def loss(t):
        p = _softmax(logits / t)[np.arange(len(y)), y]
        return -np.log(np.maximum(p, 1e-12)).mean()

    return float(min(np.geomspace(0.02, 10, 80), key=loss))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(SPACE + 1, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            df[grams(text)[0]] += 1
            n += 1
    df[SPACE] = n  # the number of documents
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["gram", "n"])


def fit(training: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of rows (doc_id, text, lang). Rows without a lang or id teach nothing.

    Document frequencies count every row. At most `sample` documents of a language, in the order of
    a hash of their ids, reach the driver for the weights; a language is at most so many rows there.
    """
    training = training.where("lang IS NOT NULL")
    counted = training.select(F.col("text").cast("string").alias("text")).mapInArrow(_document_frequencies, "gram bigint, n bigint").groupBy(
        "gram").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(SPACE + 1)
    df[counted["gram"].to_numpy(np.int64)] = counted["n"].to_numpy()
    idf = np.log((1 + df[SPACE]) / (1 + df[:SPACE])) + 1
    # a hash bound from the language's count leaves little more than the sample to rank
    named = training.where("doc_id IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = named.groupBy("lang").count()
    share = (F.lit(sample + 8 * math.sqrt(sample) + 64) / F.col("count"))
    few = named.select("doc_id", "lang").join(sizes, "lang").where(
        (share >= 1) | (F.xxhash64("doc_id") < (F.least(share, F.lit(0.999)) * 2.0 ** 64 - 2.0 ** 63).cast("bigint")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = few.select("doc_id", "lang").distinct().withColumn(
        "place", place).where(F.col("place") <= sample).select("doc_id", "lang")
    rows = with_sampled_text(named, chosen).select("doc_id", "lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [grams(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"),
                 pa.array([a.astype("<u2").tobytes() for a, _ in pairs], pa.binary()),
                 pa.array([c.astype("<u4").tobytes() for _, c in pairs], pa.binary())],
                ["doc_id", "lang", "grams", "counts"])

    got = rows.mapInArrow(features, "doc_id bigint, lang string, grams binary, counts binary").toPandas()
    got = got.sort_values(["doc_id", "lang", "grams"])
    langs = sorted(set(got["lang"]))
    data, y = [], []
    for lang, a, c in zip(got["lang"], got["grams"], got["counts"]):
        at, counts = np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(c, "<u4")
        if len(at):
            data.append((at, _weighted(at, counts, idf)))
            y.append(langs.index(lang))
    if not y:
        return Model([], idf.astype(np.float32), np.zeros((SPACE, 0), np.float32), 1.0)
    # in an order that follows neither id nor language; every fifth calibrates
    order = np.random.default_rng(0).permutation(len(y))
    data, y = [data[i] for i in order], np.array([y[i] for i in order], np.int64)
    seen = np.arange(len(y)) % 5 != 0
    weights = ftrl([d for d, s in zip(data, seen) if s], y[seen], len(langs))
    logits = np.array([x @ weights[at] for (at, x), s in zip(data, seen) if not s]).reshape(-1, len(langs))
    return Model(langs, idf.astype(np.float32), weights.astype(np.float32),
                 temperature(logits, y[~seen]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row, from the whole text alone.

    A null text, or one without a letter, is 'und' with score 0, and so is everything if the model
    has seen no language. Equal scores go to the first language by name. A null doc_id stays null,
    other columns are not read, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s[0] for s in said], pa.string()),
                 pa.array([s[1] for s in said], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")
