"""Token-id files: each document's ids compressed by themselves, with one shared dictionary.

A file set has two Parquet folders. `dictionary` is one row: the zstandard dictionary and its hash.
`blocks` has a row for each run of documents in ascending doc_id order: part (its place in the
order), the dictionary's hash, the documents' ids, token counts and offsets, and the payload, in
which document i is bytes offsets[i] to offsets[i + 1]. So a short document is read by one block's
index and one slice. Ids are stored as little-endian 16-bit integers if the vocabulary allows, else
32-bit. Rows go through Spark's writer, so any store works and a lost executor leaves no half file.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.tokens import encoder

SAMPLE_CHARS = 8_000_000       # of all texts, about, that the dictionary is trained on
SLICE_CHARS = 4_096            # in slices from any place of a text
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 4096
LEVEL = 3

BLOCK = ("part int, block int, first bigint, n_ids bigint, first_doc bigint, last_doc bigint, "
         "dictionary string, width int, doc_ids array<bigint>, n_tokens array<bigint>, "
         "offsets array<bigint>, payload binary")


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def train(docs: DataFrame, path: str, splits: str, width: int, sample_chars: int = SAMPLE_CHARS) -> bytes:
    """A dictionary from slices of the texts, taken by a hash of their place, wherever in a text they stand.

    About sample_chars reach the driver, whatever the size of the table; a slice's chance is the same
    in short and long texts and in repeated rows. It bears on the size of the files, not on ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = encoder(path, splits).encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.frombuffer(d, "<u4").astype(f"<u{width}").tobytes() for d in data], pa.binary())], ["data"])

    texts = docs.select(F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("place")).where("text <> ''")
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / SLICE_CHARS).cast("int"))
    if total > sample_chars:
        bound = int(-2 ** 63 + sample_chars / total * 2 ** 64)
        slices = F.filter(slices, lambda k: F.xxhash64("place", k) < bound)
    chosen = texts.select("text", F.explode(slices).alias("k")).select(
        F.expr(f"substring(text, k * {SLICE_CHARS} + 1, {SLICE_CHARS})").alias("text"))
    samples = sorted(bytes(r.data) for r in chosen.mapInArrow(run, "data binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to train on: the ids themselves serve
        return b"".join(samples)[:DICTIONARY_BYTES]


def write(docs: DataFrame, out: str, path: str, splits: str, end_id: int, vocabulary: int) -> None:
    """Writes the file set of documents (doc_id, text) to the folder `out`.

    A document is its ids and the end id; a null or empty text is the end id. Null doc_ids come
    first, rows that repeat a doc_id come one after another. Other columns are not read.
    """
    spark = docs.sparkSession
    width = 2 if vocabulary <= 1 << 16 else 4
    data = train(docs, path, splits, width)
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, bytearray(data))], "dictionary string, data binary").coalesce(1).write.parquet(
        f"{out}/dictionary")
    shared = spark.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder = TaskContext.get().partitionId(), encoder(path, splits)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        end, block, first = np.array([end_id], "<u4").tobytes(), 0, 0
        ids, counts, offsets, payload = [], [], [0], []

        def row():
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "first": first, "n_ids": sum(counts),
                "first_doc": ids[0], "last_doc": ids[-1], "dictionary": name, "width": width,
                "doc_ids": ids, "n_tokens": counts, "offsets": offsets, "payload": b"".join(payload)}],
                schema=_ARROW)

        for batch in batches:
            for doc, data in zip(batch.column("doc_id").to_pylist(),
                                 coder.encode(batch.column("text").to_pylist())):
                tokens = np.frombuffer(data + end, "<u4")
                small = squeeze.compress(tokens.astype(f"<u{width}").tobytes())
                ids.append(doc)
                counts.append(len(tokens))
                offsets.append(offsets[-1] + len(small))
                payload.append(small)
                if offsets[-1] >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield row()
                    block, first = block + 1, first + sum(counts)
                    ids, counts, offsets, payload = [], [], [0], []
        if ids:
            yield row()

    # equal ids are dealt by their place in the input, so they may fill several parts
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, "doc_id", "place").sortWithinPartitions("doc_id", "place").mapInArrow(
        run, BLOCK).write.option("compression", "none").parquet(f"{out}/blocks")


_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("dictionary", pa.string()),
    ("width", pa.int32()), ("doc_ids", _LONGS), ("n_tokens", _LONGS), ("offsets", _LONGS),
    ("payload", pa.binary())])


def _decoded(blocks: DataFrame, out: str, with_ids: bool, wanted: set | None = None) -> DataFrame:
    """part, doc_id, start in the part, n_tokens, ids_crc32 (and ids) of the blocks' documents."""
    spark = blocks.sparkSession
    known = spark.read.parquet(f"{out}/dictionary").first()
    name, shared = known.dictionary, spark.sparkContext.broadcast(bytes(known.data))
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if hashlib.sha256(shared.value).hexdigest() != name:
            raise ValueError("the dictionary isn't the one that the files were written with")
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))
        for batch in batches:
            for b in batch.to_pylist():
                if b["dictionary"] != name:
                    raise ValueError(f"block of another dictionary: {b['dictionary']}")
                rows, start = [], b["first"]
                for i, (doc, n) in enumerate(zip(b["doc_ids"], b["n_tokens"])):
                    if wanted is None or doc in wanted:
                        raw = expand.decompress(b["payload"][b["offsets"][i]:b["offsets"][i + 1]])
                        tokens = np.frombuffer(raw, f"<u{b['width']}").astype("<u4")
                        rows.append((b["part"], doc, start, len(tokens), zlib.crc32(tokens.tobytes()),
                                     tokens.astype(np.int32) if with_ids else None))
                    start += n
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t, _ in zip(columns, types, names)], names)

    return blocks.mapInArrow(run, "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
                             + ", ids array<int>" * with_ids)


def _blocks(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(f"{out}/blocks")


def read(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document of a file set.

    start counts the ids of all documents before it. A part knows its own counts, so only the
    parts' totals, one row per part, are added up.
    """
    blocks = _blocks(spark, out)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return _decoded(blocks, out, with_ids).join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)


def lookup(spark: SparkSession, out: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the given documents: reads the blocks whose range holds one of them."""
    wanted = set(doc_ids)
    hit = F.lit(False)
    for d in wanted:
        hit = hit | F.lit(d).between(F.col("first_doc"), F.col("last_doc"))
    return _decoded(_blocks(spark, out).where(hit), out, True, wanted).select("doc_id", "ids")
