"""Feed files that each have a header of their own: spellings, orders and extra columns may differ.

Files are read as lines. The first line of each file names its columns; the accepted spelling of each
meaning is looked up there, and every further line is parsed and picked apart by its own file's
header. All of it is columns and joins, so the same steps serve batches and streams, and any store
that Spark reads.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.session import scratch_dir


def lines(reader, path: str) -> DataFrame:
    """file, block and value of all lines under a path; reader is spark.read or spark.readStream."""
    return reader.format("text").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _names(header: Column) -> Column:
    """The normalized column names of a header line."""
    plain = F.regexp_replace(header, "^﻿", "")
    return F.transform(F.split(plain, ","), lambda c: F.replace(
        F.lower(F.trim(F.regexp_replace(F.trim(c), '^"|"$', ""))), F.lit(" "), F.lit("_")))


def headers(rows: DataFrame) -> DataFrame:
    """file, header (its first line) and names; one row for each file of lines().

    A file's first block is read by one task, in order.
    """
    first = rows.where("block = 0").withColumn("line", F.monotonically_increasing_id()).groupBy("file").agg(
        F.min_by("value", "line").alias("header"))
    return first.withColumn("names", _names(F.col("header")))


def place(names: Column, accepted: Sequence[str]) -> Column:
    """Where the first accepted spelling stands among the names, from 1; null if none does."""
    return F.coalesce(*[F.nullif(F.array_position(names, F.lit(a)).cast("int"), F.lit(0)) for a in accepted])


def picked(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The nine meanings, and extra columns by their normalized name, of the lines of feed files.

    All are text, null where a file has no such column. Blank lines, and further lines equal to
    their file's header, are no rows. A file whose names become the same is an error.
    """
    spark, at = rows.sparkSession, scratch_dir(rows.sparkSession, "headers")
    headers(rows).write.parquet(at)
    known = spark.read.parquet(at)
    clash, width = known.agg(
        F.min(F.when(F.size(F.array_distinct("names")) < F.size("names"), F.col("file"))),
        F.coalesce(F.max(F.size("names")), F.lit(1))).first()
    if clash is not None:
        raise ValueError(f"headers collide after normalization in {clash}")
    wanted = {**fixed.FEED_SYNONYMS, **{c: [c] for c in extra if c not in fixed.FEED_SYNONYMS}}
    known = known.select(F.col("file").alias("of"), "header", *[place(F.col("names"), a).alias(f"at_{m}") for m, a in wanted.items()])
    cells = F.from_csv("value", F.lit(", ".join(f"c{k} STRING" for k in range(width))), {"mode": "PERMISSIVE", "escape": "\""})
    parsed = rows.join(known, F.col("file") == F.col("of")).where(
        (F.col("value") != F.col("header")) & (F.trim("value") != "")).withColumn("cells", cells)
    row = F.array(*[F.col(f"cells.c{k}") for k in range(width)])
    return parsed.select(*[F.try_element_at(row, F.col(f"at_{m}")).alias(m) for m in wanted])


def read(spark: SparkSession, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """The rows of all CSV files under a path, each read by its own header."""
    return picked(lines(spark.read, path), extra)
