"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after another, each time with a small step by a shallow tree on
that feature's bins, so that a feature's trees add up to a lookup table. Then the strongest pairs of
features get tables of their own in the same way. A document's score is the sum of its bins'
entries: one array addition per table and batch.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm import textstats
from larder.llm.labelled import training_rows

SAMPLE = 20_000       # labelled documents that a fit may bring to the driver
BINS, COARSE = 32, 8  # bins of a feature alone and within a pair
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 40, 8
RATE, RIDGE = 0.08, 2.0
PREDICT_FROM = 0.3


@dataclass
class Additive:
    """Bin edges and tables; scores are probabilities of label 1."""
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    start: float
    tables: np.ndarray                     # feature x bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)  # one COARSE x COARSE table per pair

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        for f, e in enumerate(self.edges):
            margin += self.tables[f][np.searchsorted(e, x[:, f], "left")]
        wide = {f: np.searchsorted(self.coarse[f], x[:, f], "left") for f in {f for p in self.pairs for f in p}}
        for (a, b), grid in zip(self.pairs, self.grids):
            margin += grid[wide[a], wide[b]]
        return 1 / (1 + np.exp(-margin))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _gain(g, h):
    return g * g / (h + RIDGE)


def _shallow(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree of up to three leaves on a feature's gradient histograms."""
    spans = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, None)
        for s, (a, b) in enumerate(spans):
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            if len(gl):
                gain = _gain(gl, hl) + _gain(g[a:b].sum() - gl, h[a:b].sum() - hl)
                k = int(gain.argmax())
                gain = gain[k] - _gain(g[a:b].sum(), h[a:b].sum())
                best = max(best, (gain, s, a + k + 1), key=lambda t: t[0])
        if best[1] is None:
            break
        a, b = spans.pop(best[1])
        spans += [(a, best[2]), (best[2], b)]
    value = np.zeros(len(g))
    for a, b in spans:
        value[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a grid into four by one bound on each axis."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for c in (gc, hc):
        aa = c[:-1, :-1]
        top, side, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        parts.append((aa, top - aa, side - aa, all_ - top - side + aa))
    gain = sum(_gain(a, b) for a, b in zip(*parts))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    v = [-a[i, j] / (b[i, j] + RIDGE) for a, b in zip(*parts)]
    value = np.empty_like(g)
    value[:i + 1, :j + 1], value[:i + 1, j + 1:], value[i + 1:, :j + 1], value[i + 1:, j + 1:] = v
    return float(gain[i, j]), value


def fit_additive(x: np.ndarray, y: np.ndarray) -> Additive:
    """The model of features and 0/1 labels; with one label or no rows it is a constant."""
    rate = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(rate / (1 - rate)))
    if not 0 < y.sum() < len(y):
        return Additive([], [], start, np.zeros((0, 0)))
    edges, coarse = _edges(x, BINS), _edges(x, COARSE)
    n = x.shape[1]
    codes = [np.searchsorted(edges[f], x[:, f], "left") for f in range(n)]
    wide = [np.searchsorted(coarse[f], x[:, f], "left") for f in range(n)]
    tables, margin = np.zeros((n, BINS)), np.full(len(y), start)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n):
            g, h = slopes()
            step = RATE * _shallow(np.bincount(codes[f], g, BINS), np.bincount(codes[f], h, BINS))
            tables[f] += step
            margin += step[codes[f]]

    def grid(pair):
        cell, (g, h) = wide[pair[0]] * COARSE + wide[pair[1]], slopes()
        return [np.bincount(cell, v, COARSE * COARSE).reshape(COARSE, COARSE) for v in (g, h)]

    # strength: what four quadrants explain of what the single features have left over
    strength = {pair: _quadrants(*grid(pair))[0] for pair in combinations(range(n), 2)}
    pairs = sorted(strength, key=lambda p: (-strength[p], p))[:PAIRS]
    grids = [np.zeros((COARSE, COARSE)) for _ in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, pair in enumerate(pairs):
            step = RATE * _quadrants(*grid(pair))[1]
            grids[k] += step
            margin += step[wide[pair[0]], wide[pair[1]]]
    return Additive(edges, coarse, start, tables, pairs, grids)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """The model of documents (doc_id, text) and labels (doc_id, label 0/1)."""
    return fit_additive(*training_rows(docs, labels, sample))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """doc_id, score and predicted of every row, on whole texts.

    A null or empty text has all statistics 0 and is scored as such. A null doc_id stays null,
    repeated rows get equal scores, other columns are not read, an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(textstats.matrix(batch.column("text").to_pylist())[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= PREDICT_FROM).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id bigint, score double, predicted int")
