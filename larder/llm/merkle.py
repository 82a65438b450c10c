"""A Merkle manifest of a dataset: a tree per group, a root over the groups, a proof for each row.

A row's place among the leaves of its group is its rank by doc_id, and ranks come from bitmaps: each
task collects the ids it meets as compressed bitmaps of 4096 ids, the bitmaps of a group are merged,
and the rows before each are summed up. A row is joined with the bitmap of its chunk and asks its
popcount directory how many ids are below its own, so the leaves themselves are never sorted.

Leaves are dealt by place to slot arrays of 1024. An array is reduced ten levels in one go and its
top becomes a slot of the next array, until a group has one node. Proofs take the way back: an array
knows the siblings above it and hands each slot its own.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import saved
from larder.operators.fact import surrogate_key

CHUNK_BITS = 12                # ids of a bitmap
SLOT_BITS = 10                 # levels that a slot array reduces
NO_ID_CHUNK = -2 ** 60         # before all chunks: rows without an id
HELD_ROWS = 1 << 18            # ids that a task holds before it hands on bitmaps
HELD_RANKS = 4096              # directories that a task remembers

_COMMON = "bits binary, twice binary, more binary, n bigint"


def hashed(*parts: Column) -> Column:
    """Lower-case hex sha256 of '-' for each null part, else its UTF-8 byte count, ':' and the value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")),
                                        F.lit("-")) for p in parts]), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def packed(low: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted places in a chunk and their numbers of rows: a bitmap or short list; those with more rows than one."""
    size = 1 << CHUNK_BITS
    if len(low) < size // 16:
        bits = b"s" + low.astype("<u2").tobytes()
    else:
        full = np.zeros(size, np.uint8)
        full[low] = 1
        bits = b"b" + np.packbits(full, bitorder="little").tobytes()
    many = counts > 1
    return bits, low[many].astype("<u2").tobytes(), counts[many].astype("<i8").tobytes()


def unpacked(bits: bytes, twice: bytes, more: bytes) -> np.ndarray:
    """The number of rows at each place of a chunk."""
    counts = np.zeros(1 << CHUNK_BITS, np.int64)
    if bits[:1] == b"s":
        counts[np.frombuffer(bits, "<u2", offset=1)] = 1
    else:
        counts[:] = np.unpackbits(np.frombuffer(bits, np.uint8, offset=1), bitorder="little")
    counts[np.frombuffer(twice, "<u2")] = np.frombuffer(more, "<i8")
    return counts


class Ranks:
    """Rows below a place of a chunk: a word's entry in the directory, and the bits before it in the word."""

    def __init__(self, bits: bytes, twice: bytes, more: bytes):
        counts = unpacked(bits, twice, more)
        self.words = np.packbits(counts > 0, bitorder="little").view("<u8")
        self.directory = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.twice = np.frombuffer(twice, "<u2").astype(np.int64)
        self.more = np.concatenate([[0], np.cumsum(np.frombuffer(more, "<i8") - 1)])

    def below(self, low: np.ndarray) -> np.ndarray:
        word, mask = low >> 6, (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
        return (self.directory[word] + np.bitwise_count(self.words[word] & mask)
                + self.more[np.searchsorted(self.twice, low)])

    def tied(self, low: np.ndarray) -> np.ndarray:
        return np.isin(low, self.twice)


def _bitmaps(rows: DataFrame) -> DataFrame:
    """grp, chunk and a compressed bitmap for each chunk that a task has met."""
    def flush(held: pd.DataFrame):
        out = []
        for (group, chunk), low in held.groupby(["grp", "chunk"], dropna=False)["low"]:
            place, counts = np.unique(low.to_numpy(), return_counts=True)
            out.append((None if pd.isna(group) else group, chunk, *packed(place, counts), int(counts.sum())))
        columns = list(zip(*out)) or [[]] * 6
        types = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          ["grp", "chunk", "bits", "twice", "more", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.to_pandas())
            n += len(batch)
            if n >= HELD_ROWS:
                yield flush(pd.concat(held))
                held, n = [], 0
        if n:
            yield flush(pd.concat(held))

    return rows.select("grp", "chunk", "low").mapInArrow(run, f"grp string, chunk bigint, {_COMMON}")


def _merged(bitmaps: DataFrame) -> DataFrame:
    """One bitmap for each (grp, chunk); the places of the tasks' bitmaps are added up."""
    def merge(part: pd.DataFrame) -> pd.DataFrame:
        counts = sum(unpacked(*x) for x in zip(part["bits"], part["twice"], part["more"]))
        low = np.flatnonzero(counts)
        bits, twice, more = packed(low, counts[low])
        return pd.DataFrame([(part["grp"].iloc[0], part["chunk"].iloc[0], bits, twice, more, counts.sum())],
                            columns=["grp", "chunk", "bits", "twice", "more", "n"])

    return bitmaps.groupBy("grp", "chunk").applyInPandas(merge, f"grp string, chunk bigint, {_COMMON}")


def _before(rows: DataFrame, keys: list[str], n: str) -> DataFrame:
    """rows with `before`: the sum of column n over all rows before, in the order of the keys.

    Rows are dealt by ranges and written; only the sums of the ranges go into one window.
    """
    staged = saved(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "ranges")
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = staged.groupBy("_range").agg(F.sum(n).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return staged.withColumn("_own", F.coalesce(F.sum(n).over(within), F.lit(0))).join(
        F.broadcast(sums), "_range").select(*rows.columns, (F.col("_base") + F.col("_own")).alias("before"))


def _same(a: DataFrame, b: DataFrame, name: str) -> Column:
    return a[name].eqNullSafe(b[name])


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their places, and the groups.

    rows: grp, doc_id, leaf, claimed. The leaves: tree (the group's number), pos, doc_id, leaf, claimed.
    The groups: grp, tree, n, numbered by grp, nulls first.
    """
    key = F.coalesce(F.shiftright("doc_id", CHUNK_BITS), F.lit(NO_ID_CHUNK))
    low = F.coalesce(F.col("doc_id").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)), F.lit(0)).cast("int")
    rows = rows.withColumns({"chunk": key, "low": low})
    index = _before(saved(_merged(saved(_bitmaps(rows), "bitmaps")), "index"), ["grp", "chunk"], "n")
    index = saved(index, "directory")
    groups = index.groupBy("grp").agg(F.sum("n").alias("n"), F.min("before").alias("start"))
    groups = saved(surrogate_key(rows.sparkSession, groups, ["grp"], "tree", -1), "groups")
    known = index.join(groups.select(F.col("grp").alias("g"), "tree", "start"), F.col("grp").eqNullSafe(F.col("g"))).select(
        "g", F.col("chunk").alias("c"), "bits", "twice", "more", "tree", (F.col("before") - F.col("start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks: dict[tuple, Ranks] = {}
        for batch in batches:
            tree, base = batch.column("tree").to_numpy(), batch.column("base").to_numpy()
            low = batch.column("low").to_numpy().astype(np.int64)
            pos, tied = np.empty(len(low), np.int64), np.empty(len(low), bool)
            chunks, first, own = np.unique(np.stack([tree, base]), axis=1, return_index=True, return_inverse=True)
            for k, (key, at) in enumerate(zip(map(tuple, chunks.T.tolist()), first.tolist())):
                if key not in ranks:
                    if len(ranks) >= HELD_RANKS:
                        ranks.clear()
                    ranks[key] = Ranks(*[batch.column(c)[at].as_py() for c in ("bits", "twice", "more")])
                mine = np.flatnonzero(own.ravel() == k)
                pos[mine], tied[mine] = key[1] + ranks[key].below(low[mine]), ranks[key].tied(low[mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), pa.array(pos), pa.array(tied), *[batch.column(c) for c in ("doc_id", "leaf", "claimed")]],
                ["tree", "pos", "tied", "doc_id", "leaf", "claimed"])

    # the join may split a chunk with many rows: each of its parts has the bitmap
    asked = rows.join(known, rows["grp"].eqNullSafe(known["g"]) & (rows["chunk"] == known["c"])).select(
        "tree", "base", "bits", "twice", "more", "low", "doc_id", "leaf", "claimed")
    ranked = saved(asked.mapInArrow(
        run, "tree bigint, pos bigint, tied boolean, doc_id bigint, leaf string, claimed string"), "ranked")
    ties = ranked.where("tied")
    if ties.isEmpty():
        return ranked.drop("tied"), groups
    # rows of one id stand by their leaves; copies are told apart by where they were read
    numbered = saved(surrogate_key(rows.sparkSession, ties.withColumn("read", F.monotonically_increasing_id()),
                                   ["tree", "pos", "leaf", "read"], "number"), "ties")
    first = numbered.groupBy("tree", "pos").agg(F.min("number").alias("first"))
    settled = numbered.join(first, ["tree", "pos"]).withColumn("pos", F.col("pos") + F.col("number") - F.col("first"))
    names = ["tree", "pos", "doc_id", "leaf", "claimed"]
    return ranked.where("NOT tied").select(*names).union(settled.select(*names)), groups


def climb(nodes: list[str], levels: int | None) -> list[list[str]]:
    """All levels above the nodes: `levels` of them, or until one is left."""
    tree = [nodes]
    while (levels is None and len(tree[-1]) > 1) or (levels is not None and len(tree) <= levels):
        x = tree[-1]
        tree.append([digest(*x[i:i + 2]) for i in range(0, len(x), 2)])
    return tree


def siblings(tree: list[list[str]], slot: int) -> list[str]:
    """For each level above a slot: the sibling behind its side, l or r; '-' without one."""
    out = []
    for level in tree[:-1]:
        other = slot ^ 1
        out.append(("l" if other < slot else "r") + level[other] if other < len(level) else "-")
        slot >>= 1
    return out


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = digest(step[1:], leaf) if step[0] == "l" else digest(leaf, step[1:])
    return leaf


def _arrays(nodes: DataFrame, sizes: DataFrame, bits: int, *carried: str) -> DataFrame:
    """tree, block, n (nodes of the tree), nodes by slot (and the carried columns by slot)."""
    slot = F.col("pos").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    blocks = nodes.select("tree", F.shiftright("pos", bits).alias("block"),
                          F.struct(slot.alias("slot"), "node", *carried).alias("entry")).groupBy("tree", "block").agg(
        F.collect_list("entry").alias("slots"))
    return blocks.join(sizes, "tree")


def _by_slot(slots: list[dict], column: str) -> list:
    out = [None] * len(slots)
    for x in slots:
        out[x["slot"]] = x[column]
    return out


def _levels(n: int, bits: int) -> int | None:
    return bits if n > 1 << bits else None


def _tops(arrays: DataFrame, bits: int) -> DataFrame:
    """tree, pos, node of each array's top."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [climb(_by_slot(s, "node"), _levels(n, bits))[-1][0]
                    for s, n in zip(batch.column("slots").to_pylist(), batch.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array(tops, pa.string())],
                                             ["tree", "pos", "node"])

    return arrays.select("tree", "block", "n", "slots").mapInArrow(run, "tree bigint, pos bigint, node string")


def _handed_down(arrays: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """tree, pos, path, root of each slot: its siblings in the array, then those above the array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                tree = climb(_by_slot(x["slots"], "node"), _levels(x["n"], bits))
                yield pa.RecordBatch.from_pylist(
                    [{"tree": x["tree"], "pos": (x["block"] << bits) + i, "path": siblings(tree, i) + x["path"],
                      "subroot": x["subroot"], "root": x["root"]} for i in range(len(tree[0]))], schema=_PATHS)

    return arrays.select("tree", "block", "n", "slots").join(
        above.select("tree", F.col("pos").alias("block"), "path", "subroot", "root"), ["tree", "block"]).mapInArrow(
        run, "tree bigint, pos bigint, path array<string>, subroot string, root string")


_PATHS = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("path", pa.list_(pa.string())),
                    ("subroot", pa.string()), ("root", pa.string())])


def _reduced(nodes: DataFrame, sizes: DataFrame, bits: int, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The arrays of each round, and the top (tree, pos 0, node) of each tree."""
    rounds = []
    most = sizes.agg(F.max("n")).first()[0] or 0
    while True:
        arrays = saved(_arrays(nodes, sizes, bits, *(carried if not rounds else ())), "arrays")
        rounds.append(arrays)
        nodes = saved(_tops(arrays, bits), "tops")
        if most <= 1 << bits:
            return rounds, nodes
        most = -(-most >> bits)
        # a tree of one array is done; in the next rounds it is a lone node, which stays as it is
        sizes = sizes.select("tree", F.ceil(F.col("n") / (1 << bits)).alias("n"))


def manifest(rows: DataFrame, slot_bits: int = SLOT_BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, path, folded_root and verified of every row.

    rows: grp, doc_id, leaf, and claimed, the leaf that is checked in its stead (null: the leaf
    itself). A group's leaves ascend by doc_id, null ids first, rows of one id by leaf; every two
    nodes, or a last lone one, become the sha256 of their digests, until one is left: the subroot.
    Subroots by grp, nulls first, give the root in the same way. path has the siblings from the leaf
    to the root, each behind its side ('l' or 'r'; '-': none). folded_root is what claimed and path give.
    Other columns are not read, an empty table gives no rows.
    """
    leaves, groups = placed(rows.select("grp", F.col("doc_id").cast("bigint").alias("doc_id"), "leaf", "claimed"))
    rounds, subroots = _reduced(leaves.withColumnRenamed("leaf", "node"), groups.select("tree", "n"), slot_bits, "doc_id", "claimed")
    crown = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "node")
    above, tops = _reduced(crown, crown.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), slot_bits)
    path = tops.select("tree", "pos", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"),
                       F.col("node").alias("root"))
    for arrays in reversed(above):
        path = _handed_down(arrays, path, slot_bits)
    path = saved(path, "crown").select(F.col("pos").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path", "root").join(
        subroots.select("tree", F.col("node").alias("subroot")), "tree")
    for arrays in reversed(rounds[1:]):
        path = saved(_handed_down(arrays, path, slot_bits), "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                tree = climb(_by_slot(x["slots"], "node"), _levels(x["n"], slot_bits))
                claims, out = _by_slot(x["slots"], "claimed"), []
                for i, doc in enumerate(_by_slot(x["slots"], "doc_id")):
                    steps = siblings(tree, i) + x["path"]
                    end = folded(claims[i] or tree[0][i], steps)
                    out.append((doc, tree[0][i], x["subroot"], x["root"], steps, end, end == x["root"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["doc_id", "leaf", "subroot", "root", "path", "folded_root", "verified"]
    types = [pa.int64(), *[pa.string()] * 3, pa.list_(pa.string()), pa.string(), pa.bool_()]
    return rounds[0].join(path.withColumnRenamed("pos", "block"), ["tree", "block"]).mapInArrow(
        run, "doc_id bigint, leaf string, subroot string, root string, path array<string>, folded_root string, verified boolean")


def proof_sha256(path: Column) -> Column:
    """The sha256 of a path's siblings, one after the other."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.substring(x, 2, 64)), ""), 256)
