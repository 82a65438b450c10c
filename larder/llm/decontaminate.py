"""Benchmark decontamination by spaced seeds.

A window of 12 words is split into four groups of three positions. Each of six masks ignores two of
the groups and hashes the six words of the others, so whichever two words of a window were
substituted, one mask ignores both and the window's hash still meets the benchmark's. Around each
hit all twelve words are compared; an overlap is a window with at most two substitutions. Benchmark
items of 6 to 11 words are matched as a whole with at most one substitution, by two masks of every
other word; shorter ones as a whole, word by word.

Windows of equal words count as one on both sides, so a text or an item that repeats itself costs no
more than its distinct windows.

The benchmark goes to the tasks in blocks of a checked size; training texts are read once per block
and never shuffled.
"""

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.llm.common import mix

SPAN, SUBSTITUTED = 12, 2
TOLERANT = 6               # words of an item that may have a substitution
LEAST_WORDS = 4            # shorter items are reported, but no reason to drop a document
BLOCK_WORDS = 200_000      # words of the benchmark that go to the tasks at once

GROUPS = [[g, g + 4, g + 8] for g in range(4)]  # spread, so that neighbours fall in different groups
MASKS = [sorted(p for k, group in enumerate(GROUPS) if k not in ignored for p in group)
         for ignored in combinations(range(4), SUBSTITUTED)]
BLOOM_BITS = 1 << 23
PAIRS = 1 << 18            # windows compared at a time
_WORD = re.compile(r"\w+")


def _found(text: str) -> list[str]:
    """A text's words in lower case."""
    low = text.lower()
    if len(low) == len(text):
        return _WORD.findall(low)
    return [w.lower() for w in _WORD.findall(text)]  # a letter has a longer lower case


def words(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words in lower case."""
    found = _found(text or "")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _seeds(x: np.ndarray, positions: list[int], span: int, salt: int) -> np.ndarray:
    """Hash of the given positions of every window of `span` words."""
    n = len(x) - span + 1
    h = np.full(max(n, 0), salt, np.uint64)
    for p in positions if n > 0 else ():
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[p:p + n]
    return mix(h)


def masks(n: int) -> list[tuple[list[int], int, int, int]]:
    """(positions, words of the window, salt, words that must agree) of the masks of an item of n words."""
    if n >= SPAN:
        return [(m, SPAN, k, SPAN - SUBSTITUTED) for k, m in enumerate(MASKS)]
    if n >= TOLERANT:
        return [(list(range(k, n, 2)), n, 100 + 2 * n + k, n - 1) for k in range(2)]
    return [(list(range(n)), n, 100 + 2 * n, n)]


def _windows(x: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    return x[at[:, None] + np.arange(span)]


class Block:
    """The seeds of some benchmark items, and where they stand."""

    def __init__(self, items: list[tuple[int, str]], least: int = 1):
        self.items = [(i, words(t)) for i, t in items]
        self.items = [(i, w) for i, w in self.items if len(w) >= max(least, 1)]
        self.flat = np.concatenate([w for _, w in self.items]) if self.items else np.empty(0, np.uint64)
        starts = np.cumsum([0, *[len(w) for _, w in self.items]])
        self.seeds = sorted({(tuple(m), *rest) for n in {min(len(w), SPAN) for _, w in self.items} for m, *rest in masks(n)},
                            key=lambda s: s[2])
        hashes, owner, place = [np.empty(0, np.uint64)], [np.empty(0, int)], [np.empty(0, int)]
        for k, (_, w) in enumerate(self.items):
            for positions, span, salt, _ in self.seeds:
                if span == min(len(w), SPAN):
                    at = _distinct(w, np.arange(len(w) - span + 1), span)[0]
                    hashes.append(_seeds(w, positions, span, salt)[at])
                    owner.append(np.full(len(at), k))
                    place.append(starts[k] + at)
        self.hashes, self.owner, self.place = map(np.concatenate, (hashes, owner, place))
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owner, self.place = self.hashes[order], self.owner[order], self.place[order]
        self.bloom = np.zeros(BLOOM_BITS // 8, np.uint8)
        bit = self.hashes & np.uint64(BLOOM_BITS - 1)
        np.bitwise_or.at(self.bloom, bit >> np.uint64(3), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))

    def overlaps(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """item index -> (verified windows, first word, end word) in the text."""
        x = words(text)
        starts: dict[int, list[np.ndarray]] = {}
        for positions, span, salt, least in self.seeds:
            h = _seeds(x, positions, span, salt)
            bit = h & np.uint64(BLOOM_BITS - 1)
            at = np.flatnonzero((self.bloom[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
            if len(at):
                low, high = (np.searchsorted(self.hashes, h[at], side) for side in ("left", "right"))
                at = at[high > low]
            if not len(at):
                continue
            one, own = _distinct(x, at, span)
            for owner, window in self._verified(x, one, h[one], span, least):
                starts.setdefault(owner, []).append((at[np.isin(own, window)], span))
        out = {}
        for owner, parts in starts.items():
            span = parts[0][1]
            first = np.unique(np.concatenate([p for p, _ in parts]))
            out[owner] = len(first), int(first[0]), int(first[-1]) + span
        return out

    def _verified(self, x, at, h, span, least) -> Iterator[tuple[int, np.ndarray]]:
        """Each item with the places in `at` of the windows that agree with one of its own."""
        low, high = (np.searchsorted(self.hashes, h, side) for side in ("left", "right"))
        upto = np.cumsum(high - low)
        good = [np.empty((2, 0), int)]
        for s in range(0, int(upto[-1]), PAIRS):
            pair = np.arange(s, min(s + PAIRS, int(upto[-1])))
            w = np.searchsorted(upto, pair, "right")
            e = high[w] - (upto[w] - pair)
            same = (_windows(self.flat, self.place[e], span) == _windows(x, at[w], span)).sum(axis=1)
            good.append(np.unique(np.stack([self.owner[e], w])[:, same >= least], axis=1))
        owner, window = np.concatenate(good, axis=1)
        for k in np.unique(owner).tolist():
            yield k, window[owner == k]


def _distinct(x: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Of windows of equal words the first, and for each of `at` the place of its own among them."""
    whole = _seeds(x, list(range(span)), span, 1 << 20)[at]
    _, first, own = np.unique(whole, return_index=True, return_inverse=True)
    return at[first], own


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, least: int = 1) -> Iterator[Block]:
    """The items (item_id, text) of `least` words or more in blocks of about block_words; equal items count once."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / 5 / block_words))  # a word is five bytes at least, about
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Block(sorted((r.item_id, r.text) for r in part.collect()), least)


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, n_windows, start, end, item_words of each document and item that overlap.

    start and end are code points in the whole text, around all verified windows. Items without a
    word match nothing, others of any length. Null texts and
    items overlap with nothing, a null doc_id stays null, repeated rows come back repeated; other
    columns are not read, empty tables give no rows. Items with several rows of one item_id are
    several texts of that item.
    """
    names = ["doc_id", "item_id", "n_windows", "start", "end", "item_words"]
    schema = ", ".join(f"{n} bigint" for n in names)
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")

    def found(block):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    hits = shared.value.overlaps(text)
                    if hits:
                        at = _positions(text)
                        out += [(doc, shared.value.items[k][0], n, at[a][0], at[b - 1][1], len(shared.value.items[k][1]))
                                for k, (n, a, b) in hits.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (list(zip(*out)) or [[]] * len(names))], names)

        return rows.mapInArrow(run, schema)

    parts = [found(b) for b in blocks(benchmark, block_words)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _positions(text: str) -> list[tuple[int, int]]:
    """Start and end of each word in a text."""
    low = text.lower()
    return [m.span() for m in _WORD.finditer(low if len(low) == len(text) else text)]


def keep(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs, with all their columns, that overlap with no benchmark item of LEAST_WORDS or more."""
    at = docs.columns.index("text")

    def without(rows, block):
        shared = rows.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(
                    [not shared.value.overlaps(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        return rows.mapInArrow(run, StructType(docs.schema.fields))

    for block in blocks(benchmark, block_words, LEAST_WORDS):
        docs = without(docs, block)
    return docs
