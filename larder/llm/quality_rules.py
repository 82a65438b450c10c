"""Quality rules: boosted trees over document statistics, with monotonic constraints.

Trees are grown on histograms of a bounded labelled sample and flattened into arrays of nodes; a
batch of documents is scored by walking all trees at once, one step per level. On constrained
features (textstats.FALLING) a larger value never raises the score. Two fixed rules stand before
the trees: too few words, or too many words in repeated passages.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from larder.llm import textstats
from larder.llm.labelled import training_rows

SAMPLE = 20_000      # labelled documents that a fit may bring to the driver
TREES, DEPTH, RATE = 60, 4, 0.2
BINS, RIDGE, LEAST = 64, 1.0, 5.0  # LEAST: second derivatives in a leaf
KEEP_FROM = 0.3      # probability of good quality
MIN_WORDS, MAX_REPEAT_PCT = 10, 20


@dataclass
class Forest:
    """Nodes of all trees; a leaf points to itself."""
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH if len(self.roots) else 0):
            down = x[rows, self.feature[at]] <= self.limit[at]
            at = np.where(down, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit_forest(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Forest | None:
    """Boosted trees for log loss; signs: -1 falling, 1 rising, 0 free. None without rows."""
    if not len(y):
        return None
    rate = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(rate / (1 - rate)))
    nodes, roots = [], []
    if 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
        margin = np.full(len(y), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            _grow(nodes, codes, edges, p - y, p * (1 - p), np.arange(len(y)), margin, signs,
                  -np.inf, np.inf, DEPTH)
    columns = list(zip(*nodes)) if nodes else [[]] * 5
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Forest(*(np.array(c, k) for c, k in zip(columns, kinds)), np.array(roots, np.int64), start)


def _grow(nodes, codes, edges, g, h, rows, margin, signs, low, high, depth) -> int:
    """Adds the subtree of these rows; low and high bound its leaves. Returns its node."""
    here = len(nodes)
    gs, hs = g[rows].sum(), h[rows].sum()
    value = float(np.clip(-gs / (hs + RIDGE), low, high))
    nodes.append((0, np.inf, here, here, RATE * value))
    best = _split(codes, edges, g[rows], h[rows], rows, signs, low, high) if depth else None
    if best is None:
        margin[rows] += RATE * value
        return here
    f, cut, lv, rv = best
    down = codes[f, rows] <= cut
    middle = (lv + rv) / 2
    # bounds (low, high) of the two sides; a constrained split keeps them apart for good
    sides = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)),
             -1: ((middle, high), (low, middle))}[signs[f]]
    left = _grow(nodes, codes, edges, g, h, rows[down], margin, signs, *sides[0], depth - 1)
    right = _grow(nodes, codes, edges, g, h, rows[~down], margin, signs, *sides[1], depth - 1)
    nodes[here] = (f, float(edges[f][cut]), left, right, 0.0)
    return here


def _split(codes, edges, g, h, rows, signs, low, high):
    """(feature, bin, value left, value right) of the largest gain, if any."""
    gs, hs = g.sum(), h.sum()
    best, found = 1e-6, None
    for f, e in enumerate(edges):
        if not len(e):
            continue
        c = codes[f, rows]
        gl = np.cumsum(np.bincount(c, g, len(e) + 1))[:-1]
        hl = np.cumsum(np.bincount(c, h, len(e) + 1))[:-1]
        lv = np.clip(-gl / (hl + RIDGE), low, high)
        rv = np.clip(-(gs - gl) / (hs - hl + RIDGE), low, high)
        # loss saved by the two (bounded) values against one value for all rows
        gain = -(gl * lv + 0.5 * (hl + RIDGE) * lv ** 2) - (
            (gs - gl) * rv + 0.5 * (hs - hl + RIDGE) * rv ** 2) - 0.5 * gs ** 2 / (hs + RIDGE)
        gain[(hl < LEAST) | (hs - hl < LEAST) | (signs[f] * (rv - lv) < 0)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = gain[k], (f, k, lv[k], rv[k])
    return found


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """The forest of documents (doc_id, text) and labels (doc_id, label 0/1); None without any."""
    signs = [-1 if f in textstats.FALLING else 0 for f in textstats.FEATURES]
    return fit_forest(*training_rows(docs, labels, sample), signs)


def verdicts(texts: list[str | None], forest: Forest | None):
    """Counts, base_failed, score and kept of texts. Without a forest the score is 1."""
    counts, x = textstats.matrix(texts)
    failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PCT * counts[:, 0])
    score = forest.score(x) if forest is not None else np.ones(len(texts))
    return counts, failed, score, ~failed & (score >= KEEP_FROM)


def assess(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    One row per input row, whole texts; a null or empty text has no words and fails. A null doc_id
    stays null, other columns are not read, an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, score, kept = verdicts(batch.column("text").to_pylist(), forest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(failed),
                 pa.array(score), pa.array(kept)],
                ["doc_id", *textstats.COUNTS, "base_failed", "score", "kept"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in textstats.COUNTS)
        + ", base_failed boolean, score double, kept boolean")


def keep(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(verdicts(batch.column(at).to_pylist(), forest)[3]))

    return docs.mapInArrow(run, StructType(docs.schema.fields))
