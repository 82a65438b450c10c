"""Jump consistent hashing: a stable key and the number of shards decide the shard.

No ring or table is kept. When a shard is appended, each key either stays or moves to the new
shard, and the expected share that moves is 1 / (n + 1). Everything here is DataFrame functions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import saved

# the multiplier of the published generator, and the sizes of its words
MULTIPLIER = "2862933555777941757"
TWO_64 = "18446744073709551616"


def jump(key: Column, shards: int) -> Column:
    """The shard of a whole number, taken as unsigned 64 bits; null counts as 0.

    The generator needs products modulo 2^64, which decimals of 38 digits hold exactly.
    """
    unsigned = F.coalesce(key.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    unsigned = F.when(unsigned < 0, unsigned + F.lit(TWO_64).cast("decimal(20,0)")).otherwise(unsigned)
    big = F.lit(TWO_64).cast("decimal(38,0)")

    def advance(k):
        product = k * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        return (product % big).cast("decimal(20,0)")

    def step(state, _):
        top = F.floor(state["k"] / F.lit(2 ** 33).cast("decimal(10,0)")).cast("double")
        ahead = F.floor((state["j"] + 1) * (F.lit(2.0 ** 31) / (top + 1))).cast("bigint")
        moved = F.struct(state["j"].alias("b"), ahead.alias("j"), advance(state["k"]).alias("k"))
        return F.when(state["j"] < shards, moved).otherwise(state)

    start = F.struct(F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"),
                     advance(unsigned.cast("decimal(20,0)")).alias("k"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step,
                       lambda state: state["b"].cast("int"))


def shard(docs: DataFrame, shards: int, chunks: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard of every row.

    size is the text's UTF-8 bytes plus 8 for the id. slot numbers the rows of a shard from 0 in
    the order of doc_id, without gaps; rows that repeat an id get slots next to each other in any
    order. grown_shard is the shard with one more shard. A null id hashes like 0 and comes first, a
    null or empty text has size 8 and crc 0; an empty table gives no rows. Other columns are not
    read. No text is shuffled: only its size and checksum are.

    Slots need no task that sees a whole shard: rows are dealt into ranges of (shard, doc_id), each
    range is numbered by itself, and the counts of earlier ranges are added. Equal ids are spread by
    their place in the input. The ranges are written once, so a rerun task numbers the same rows.
    """
    spark = docs.sparkSession
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("shard", jump(F.col("doc_id"), shards))
    placed = saved(placed, "sharded")
    ranged = saved(placed.repartitionByRange(chunks, "shard", "doc_id", "place")
                   .withColumn("chunk", F.spark_partition_id()), "ranged")
    # ranges are contiguous, so there are at most chunks + shards counts
    counts = ranged.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "place")
    return ranged.join(F.broadcast(starts), ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("first") + F.row_number().over(inside) - 1).alias("slot"),
        jump(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
