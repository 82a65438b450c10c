"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Bounded-space online best fit: a piece goes to the open bin with the least free space that still
holds it. Open bins stand in stacks by free space, and a bitset says which stacks have bins, so the
best fit is the lowest set bit from the piece's length on. At most OPEN_BINS are open: beyond that
the fullest closes first. Pieces are dealt evenly to groups and come in falling length, each group
is packed in one pass over its rows; memory is the open bins, whatever the number of rows.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larder.llm.common import saved
from larder.llm.tokens import encoder

CAPACITY = 1024
OPEN_BINS = 65_536
GROUP_ROWS = 262_144   # pieces that are packed together


class OpenBins:
    """place() returns (bin, offset) of a piece."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.stacks = [[] for _ in range(capacity + 1)]
        self.bits, self.open, self.made = 0, 0, 0

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        found = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        if not 0 <= size <= self.capacity:
            raise ValueError(f"a piece of {size} doesn't fit into {self.capacity}")
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, self.made
            self.made += 1
        left = free - size
        if left:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.stacks[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """All columns of pieces plus sequence_id and offset (replaced, if pieces have such).

    `length` says how much of a sequence a row needs, 0 to capacity. Equal lengths go in the order
    of doc_id and piece, where there are such, so a task that is run again gives the same places.
    An empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    groups = max(1, math.ceil(pieces.count() / group_rows))
    at = pieces.columns.index("length")
    ties = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(size) for size in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"])

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])
    return pieces.repartition(groups).sortWithinPartitions(F.desc("length"), *ties).mapInArrow(run, schema)


def cut(docs: DataFrame, path: str, splits: str, end_id: int, capacity: int = CAPACITY,
        with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of the tokenized documents' pieces.

    A document is its ids and the end id. Only those longer than the capacity are cut: into full
    pieces, but for the first, which takes what is left over. A null or empty text is the end id.
    A null doc_id stays null, repeated rows are packed each; other columns are not read.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, coder = np.array([end_id], "<u4").tobytes(), encoder(path, splits)
        for batch in batches:
            columns = [[] for _ in types]
            owners, pieces, starts, lengths, sums, ids = columns
            for doc, data in zip(batch.column("doc_id").to_pylist(),
                                 coder.encode(batch.column("text").to_pylist())):
                data += end
                n = len(data) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                owners += [doc] * (len(bounds) - 1)
                pieces += range(len(bounds) - 1)
                starts += bounds[:-1]
                for a, b in zip(bounds, bounds[1:]):
                    part = data[4 * a:4 * b]
                    lengths.append(b - a)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t, _ in zip(columns, types, names)], names)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
        + ", ids array<int>" * with_ids)


def pack_documents(docs: DataFrame, path: str, splits: str, end_id: int, capacity: int = CAPACITY,
                   with_ids: bool = False, **bounds) -> DataFrame:
    """The pieces of cut() with their sequence_id and offset.

    Pieces are written once: they are counted before they are packed, and tokenizing is the cost.
    """
    return pack(saved(cut(docs, path, splits, end_id, capacity, with_ids), "pieces"), capacity, **bounds)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, doc_ids and ids of each sequence, from packed pieces with ids.

    A group is one sequence, so it holds at most the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.size(F.flatten("p.ids")).cast("bigint").alias("n_tokens"),
        F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids"))
