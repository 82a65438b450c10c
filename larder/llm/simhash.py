"""SimHash near-duplicates through an inverted index of fingerprint bytes by their position.

A fingerprint has 64 bits: a bit is 1 if more than half of a text's word shingles, repeats included,
have it set in their hash. Two fingerprints that differ in at most 3 bits differ in at most 3 of
their 8 bytes, so they share 5 or more bytes at the same position. Three of any five positions lie
in one half of the fingerprint, so the index has a list for each value of three bytes of one half,
and every pair to be found meets in one of its 8 lists. In a list the shared bytes of each pair are
tallied, pairs with fewer than 5 are dropped, the others are verified bit by bit.

Equal fingerprints are one class and come to the index once. A list of more than CROWDED classes is
dealt to lists of five positions, which leave 24 bits free: there the neighbours of a fingerprint are
looked up in a bitmap of all 2^24 values, so the work is linear in the list. A list sends a tree of
its links, never its pairs.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import saved
from larder.llm.neardup import NO_ID, components

WORDS, SEED = 3, 42
DIFFERENT = 3                  # bits
SHARED = 8 - DIFFERENT         # bytes that a pair shares at least
CROWDED = 1024                 # longer lists are dealt anew
CHUNK = 1 << 16                # shingles hashed at a time
ROWS = 1 << 16                 # postings that a task looks at together

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
THREES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
FIVES = list(combinations(range(8), SHARED))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a text; A-Z count as a-z.

    With fewer words the whole sequence is one shingle; without words it is 0.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    body, lengths = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts, k = ends - lengths, min(words, len(parts))
    n, ones = len(parts) - k + 1, np.zeros((8, 8), np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at:min(at + CHUNK, n)].tolist(), ends[at + k - 1:].tolist())
        h = np.fromiter((xxhash.xxh64_intdigest(body[a:b], SEED) for a, b in spans), "<u8")
        for place, column in enumerate(h.view(np.uint8).reshape(-1, 8).T):
            ones[place] += np.bincount(column, minlength=256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and print (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, print bigint")


def _mask(places: tuple[int, ...]) -> int:
    """The bits of the bytes at these positions, as a signed long."""
    bits = sum(255 << 8 * p for p in places)
    return bits - (1 << 64) if bits >> 63 else bits


def _listed(prints: DataFrame, masks: F.Column) -> DataFrame:
    """A posting (mask, key, print) for each of a row's masks: the key is the bytes under the mask."""
    return prints.select("print", F.explode(masks).alias("mask")).select(
        "mask", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")


def tally(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs of fingerprints (unsigned) are links: counted by bytes, verified by bits."""
    other = x ^ y
    good = (other.view(np.uint8).reshape(*other.shape, 8) == 0).sum(axis=-1) >= SHARED
    good[good] = np.bitwise_count(other[good]) <= DIFFERENT
    return good


def _tree(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table of links, the first row that it reaches."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            front = np.array([i])
            while len(front):
                root[front] = i
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
    return root


def _neighbours(values: np.ndarray) -> np.ndarray:
    """For each of distinct 24-bit values, the place of the first one that it reaches by steps of at most 3 bits."""
    one = 1 << np.arange(24)
    steps = np.array(sorted({int(np.bitwise_xor.reduce(one[list(c)])) for n in range(1, DIFFERENT + 1)
                             for c in combinations(range(24), n)}), np.int64)
    place = np.full(1 << 24, -1, np.int32)  # of values without a root so far
    place[values] = np.arange(len(values))
    root = np.full(len(values), -1)
    for i in range(len(values)):
        if root[i] >= 0:
            continue
        root[i], place[values[i]], front = i, -1, np.array([i])
        while len(front):
            following = []
            for at in range(0, len(front), 1024):
                near = place[(values[front[at:at + 1024], None] ^ steps).ravel()]
                near = np.unique(near[near >= 0])
                root[near], place[values[near]] = i, -1
                following.append(near)
            front = np.concatenate(following)
    return root


def _run_links(x: np.ndarray, mask: int) -> np.ndarray:
    """The first fingerprint that each of a list reaches by links within the list."""
    if len(x) <= CROWDED:
        return x[_tree(tally(*np.broadcast_arrays(x[:, None], x[None, :])))]
    free = [p for p in range(8) if not mask >> 8 * p & 255]  # three positions
    values = sum(((x >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) << 8 * k for k, p in enumerate(free))
    return x[_neighbours(values)]


def _linked(postings: DataFrame) -> DataFrame:
    """Links (a, b) of fingerprints, one list after the other as they come in a partition."""
    def links(mask, key, x):
        """Of whole lists in order."""
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])]))
        size = np.diff(np.append(first, len(x)))
        two = first[size == 2]
        good = two[tally(x[two], x[two + 1])]
        out = [np.stack([x[good], x[good + 1]])]
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            own = x[at:at + n]
            root = _run_links(own, int(mask[at]))
            out.append(np.stack([root, own])[:, root != own])
        a, b = np.concatenate(out, axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for batch in batches:
            kept.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += len(batch)
            if rows < ROWS:
                continue
            mask, key, x = map(np.concatenate, zip(*kept))
            last = np.flatnonzero((key != key[-1]) | (mask != mask[-1]))
            whole = last[-1] + 1 if len(last) else 0
            if whole:
                yield links(mask[:whole], key[:whole], x[:whole].view(np.uint64))
            kept, rows = [[mask[whole:], key[whole:], x[whole:]]], 0  # the last list may go on
        if kept and len(kept[0][0]) + rows:
            mask, key, x = map(np.concatenate, zip(*kept))
            yield links(mask, key, x.view(np.uint64))

    return postings.repartition("mask", "key").sortWithinPartitions("mask", "key", "print").mapInArrow(
        run, "a bigint, b bigint")


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (print) within reach of each other."""
    spark = prints.sparkSession
    postings = _listed(prints, F.array(*[F.lit(_mask(c)) for c in THREES]))
    many = saved(postings.groupBy("mask", "key").count().where(F.col("count") > crowded).select("mask", "key"), "crowded")
    found = saved(_linked(postings.join(many, ["mask", "key"], "left_anti")), "near")
    if many.isEmpty():
        return found
    wider = spark.createDataFrame([(_mask(c), [_mask(w) for w in FIVES if set(c) < set(w)]) for c in THREES],
                                  "mask bigint, wider array<bigint>")
    again = _listed(postings.join(many, ["mask", "key"], "left_semi").join(F.broadcast(wider), "mask"), F.col("wider"))
    return found.union(saved(_linked(again.distinct()), "near"))


def near_duplicates(docs: DataFrame, words: int = WORDS, crowded: int = CROWDED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest doc_id that links reach. Null, empty and blank texts have the
    fingerprint zero and are linked like any other. Rows that share a doc_id are one document; null
    ids share one, which is smaller than all others and returned as null. Repeated rows come back
    repeated, other columns are not read, an empty table gives no rows.
    """
    rows = saved(fingerprints(docs, words), "prints")
    classes = saved(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    same = rows.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("b")).where("a <> b")
    shared = rows.join(same.select("doc_id", "a"), "doc_id").select("a", F.col("print").alias("b")).distinct()
    found = components(links(classes.select("print"), crowded).union(shared))
    grouped = classes.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print"))
    least = grouped.groupBy("root").agg(F.min("first").alias("component"))
    named = grouped.join(least, "root").select("print", "component")
    return rows.join(named, "print").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.nullif("component", F.lit(NO_ID)).alias("component_id"))
