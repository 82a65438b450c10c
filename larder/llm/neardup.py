"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

A document is its set of distinct word shingles. Its sketch has COORDINATES places that are filled in
rounds: round i throws every element into a hashed place, and a place keeps the smallest value of
the first round that reaches it; the second half of the rounds names one place each, so that every
place is filled for certain. Equal sets are one class. Classes meet in the buckets of BANDS bands,
and a link counts only if the full sets confirm it.

A bucket never lists its pairs. First each member meets two of the bucket: the smallest one and one
chosen by hash. Most groups are one component then. Buckets that are not are joined into groups, and
in a group the documents outside its largest component are compared with all others, in blocks of
bounded size and through the shingles they share, so that only links come out. A pair at the
threshold misses all bands with probability (1 - 0.8^6)^48 < 1e-6.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import mix, saved
from larder.operators.fact import surrogate_key

BANDS, ROWS = 48, 6
COORDINATES = BANDS * ROWS
WORDS, PERCENT = 5, 80
NO_ID = -2 ** 63   # stands for a null doc_id
QUERIES, OTHERS = 128, 512  # about so many documents of either side meet in a block

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 48) - 1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; A-Z count as a-z.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    x = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    k = min(words, len(x))
    n = len(x) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = h * _PRIME + x[j:j + n]
    return np.unique(mix(h))


def sketch(x: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    out = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    at, step = 0, max(1, math.ceil(size * (math.log(size) + 2) / len(x)))
    while at < 2 * size:
        rounds = np.arange(at, min(at + step, 2 * size, max(size, at + 1) if at < size else 2 * size), dtype=np.uint64)
        h = mix(x[None, :] + mix(rounds + np.uint64(1))[:, None])
        if at < size:
            place = ((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        else:
            place = np.broadcast_to((rounds - np.uint64(size))[:, None], h.shape)
        np.minimum.at(out, place.ravel().astype(np.int64), ((rounds << np.uint64(48))[:, None] | (h & _LOW)).ravel())
        at += len(rounds)
        # later rounds have larger values, so a full sketch is final
        if (out != np.iinfo(np.uint64).max).all():
            break
    return out


def bands(x: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a set's sketch."""
    rows = sketch(x).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        h = mix(h * _PRIME + rows[:, r])
    return h


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and keys of the bands of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                pa.array([bands(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, digest string, bands array<bigint>")


def _packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """rep and its compressed text, for the given ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [squeeze.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(texts, pa.binary())], ["rep", "packed"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("rep"),
                       F.col("text").cast("string").alias("text"))
    return rows.join(ids, "rep", "left_semi").mapInArrow(run, "rep bigint, packed binary")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        last = {}

        def full(side, data):  # pairs of one document often follow each other
            if last.get(side, (None,))[0] != data:
                last[side] = data, shingles(expand.decompress(data).decode("utf-8", "surrogatepass"), words)
            return last[side][1]

        for batch in batches:
            good = [similar(full("a", x), full("b", y), percent) for x, y in
                    zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # the smaller id is often the same in many pairs: it is joined last, so that its rows come together
    first = pairs.join(texts.withColumnsRenamed({"rep": "b", "packed": "pb"}), "b")
    return first.join(texts.withColumnsRenamed({"rep": "a", "packed": "pa"}), "a").select(
        "a", "b", "pa", "pb").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of the edges (a, b), root being the smallest node it reaches.

    Large-star and small-star steps in turn: each points neighbours at the smallest one known, until
    a large-star step moves nothing, which is so only for stars. Every step is one aggregation by
    node and one join, and is written.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "large")
        if _print(large) == state:
            return large.select(F.col("u").alias("node"), F.col("v").alias("root"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        state = _print(edges)


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b of rows (x, y)."""
    return rows.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _apart(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Members (key, rep, root) of the buckets that hold more than one component.

    Buckets of two are left out: their one pair has been verified.
    """
    rows = buckets.select("key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep"))
    mixed = rows.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
    return rows.join(mixed.where("lo <> hi AND n > 2").select("key"), "key")


def _across(apart: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """All links (a, b) between different components of the groups that buckets of `apart` form.

    In each group the documents outside the largest component are the queries. Queries and members
    are dealt by hash into parts of about QUERIES and OTHERS, and each pair of parts is one block.
    """
    heads = apart.groupBy("key").agg(F.min("rep").alias("head"))
    grouped = components(apart.join(heads, "key").select(F.col("rep").alias("a"), F.col("head").alias("b")))
    members = saved(apart.select("rep", "root").distinct().join(
        grouped.select(F.col("node").alias("rep"), F.col("root").alias("group")), "rep", "left").withColumn(
        "group", F.coalesce("group", "rep")), "members")
    sizes = members.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("n"))
    placed = members.join(sizes, "group").select(
        "group", "rep", "root", (F.col("root") != F.col("largest")).alias("asks"),
        F.ceil((F.col("n") - F.col("most")) / QUERIES).alias("nq"), F.ceil(F.col("n") / OTHERS).alias("no")).join(
        texts, "rep")
    q, o = F.pmod(F.xxhash64("rep"), F.col("nq")), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("no"))
    asking = placed.where("asks").select("group", q.alias("q"), F.explode(F.sequence(F.lit(0), F.col("no") - 1)).alias("o"),
                                         "rep", "root", "packed", F.lit(True).alias("asks"))
    asked = placed.select("group", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("q"), o.alias("o"),
                          "rep", "root", "packed", F.lit(False).alias("asks"))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        expand = zstandard.ZstdDecompressor()
        block = block.assign(x=[shingles(expand.decompress(p).decode("utf-8", "surrogatepass"), words) for p in block["packed"]])
        ask, others = block[block["asks"]], block[~block["asks"]]
        pairs = _links(ask["x"].tolist(), ask["root"].to_numpy(), others["x"].tolist(), others["root"].to_numpy(), percent)
        a, b = ask["rep"].to_numpy()[pairs[:, 0]], others["rep"].to_numpy()[pairs[:, 1]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return asking.union(asked).groupBy("group", "q", "o").applyInPandas(compare, "a bigint, b bigint")


def _links(ask: list, ask_root: np.ndarray, others: list, root: np.ndarray, percent: int) -> np.ndarray:
    """Index pairs of similar sets with different roots, by counting shared elements."""
    if not ask or not others:
        return np.empty((0, 2), np.int64)
    size = np.array([len(x) for x in others])
    owner = np.repeat(np.arange(len(others)), size)
    elements = np.concatenate(others)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    found = [np.empty((0, 2), np.int64)]
    for i, x in enumerate(ask):
        spans = zip(np.searchsorted(elements, x, "left").tolist(), np.searchsorted(elements, x, "right").tolist())
        shared = np.bincount(np.concatenate([owner[a:b] for a, b in spans]), minlength=len(others))
        good = np.flatnonzero((shared > 0) & (100 * shared >= percent * (len(x) + size - shared)) & (root != ask_root[i]))
        found.append(np.stack([np.full(len(good), i), good], axis=1))
    return np.concatenate(found)


def link(spark: SparkSession, docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """node, root of the classes (by their smallest doc_id) that have links."""
    classes = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # rows that share an id are one document, so their classes are linked
    same = sets.where("digest IS NOT NULL").groupBy("doc_id").agg(
        F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("doc_id")
    shared = saved(sets.join(same, "doc_id").join(classes, "digest").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")), "shared")
    reps = sets.join(classes, (sets.digest == classes.digest) & (sets.doc_id == classes.rep)).select("rep", "bands")
    members = reps.select("rep", F.explode("bands").alias("key"))
    heads = members.groupBy("key").agg(
        F.min("rep").alias("head"), F.max("rep").alias("last"),
        F.min_by("rep", F.xxhash64("rep", "key")).alias("other")).where("head <> last")
    buckets = saved(members.join(heads.select("key", "head", "other"), "key").distinct(), "buckets")
    texts = saved(_packed_texts(docs, buckets.select("rep").distinct()), "texts")
    met = buckets.select(F.col("rep").alias("x"), F.explode(F.array("head", "other")).alias("y"))
    pairs = saved(_pairs(met), "pairs")
    found = components(shared.union(saved(verified(pairs, texts, words, percent), "links")))
    apart = saved(_apart(buckets, found), "apart")
    if apart.isEmpty():
        return found
    links = saved(_across(apart, texts, words, percent), "across")
    if links.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    component_id is the smallest doc_id that links reach, kept says whether it is the row's own.
    Documents without words have no shingles and are linked with nothing. Rows that share a doc_id
    are one document; null ids share one, which is smaller than all others and returned as null.
    Other columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    sets = saved(sketched(docs, words), "sketched")
    found = link(spark, docs, sets, words, percent)
    classes = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("root", "rep").alias("component"))
    out = sets.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    return out.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles",
                      F.nullif("component", F.lit(NO_ID)).alias("component_id"),
                      (F.col("doc_id") == F.col("component")).alias("kept"))


def keep(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near-duplicates, with all columns of docs: that of the smallest doc_id.

    Rows are told apart by doc_id and text, null ids included: of rows that share both, one stays, and
    rows that share an id alone don't remove each other. Rows without words go only if repeated.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("id"))
    repeated = saved(ids.groupBy("id").count().where("count > 1 OR id IS NULL").select("id"), "repeated")
    if repeated.isEmpty():
        decided = near_duplicates(docs, words, percent)
        gone = saved(decided.where("NOT kept").select(F.col("doc_id").alias("_gone")), "gone")
        return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti").select(*docs.columns)
    names = [f"_{k}_{c}" for k, c in enumerate(docs.columns)]
    rows = saved(docs.toDF(*names).withColumns({
        "_read": F.monotonically_increasing_id(), "_id": F.col(names[docs.columns.index("doc_id")]).cast("bigint"),
        "_text": F.sha2(F.col(names[docs.columns.index("text")]).cast("string"), 256)}), "placed")
    pairs = rows.groupBy("_id", "_text").agg(F.min("_read").alias("_read")).select(
        "_read", F.isnull("_id").alias("_none"), "_id", "_text")
    numbered = saved(surrogate_key(docs.sparkSession, pairs, ["_none", "_id", "_text"], "_number"), "numbers")
    once = saved(rows.join(numbered.select("_read", "_number"), "_read"), "once")
    decided = near_duplicates(once.select(F.col("_number").alias("doc_id"), F.col(names[docs.columns.index("text")]).alias("text")),
                              words, percent)
    left = once.join(decided.where("kept").select(F.col("doc_id").alias("_number")), "_number", "left_semi")
    return left.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
