"""Helpers that the operators share: session settings, tables, written intermediates, hashing."""

import math
import shutil
import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import larder
from larder.session import configure, scratch_dir

# texts differ in length by a factor of thousands, so batches for Python are short
BATCH_ROWS = 256


_shipped: set[str] = set()


def session(spark: SparkSession) -> SparkSession:
    """The session with its settings, and with this package on the workers' path.

    Functions on the workers import the package. Spark serves it to them as an archive, once per
    application, so it need not be installed there.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context, home = spark.sparkContext, Path(larder.__file__).parent
    if context.applicationId not in _shipped and home.is_dir():
        archive = f"{tempfile.mkdtemp(prefix='package-')}/larder"
        context.addPyFile(shutil.make_archive(archive, "zip", home.parent, home.name))
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows written to the shared folder and read again; a lost executor costs no rerun."""
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_crc(doc_id: str = "doc_id") -> Column:
    """Unsigned crc32 of the id as text; 0 without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0))


def in_sample(n: int, of: int, key: Column) -> Column:
    """Is the hash of key among the smallest n of about `of` hashes? A few more are let through, nearly never fewer."""
    share = (n + 8 * math.sqrt(n) + 64) / max(of, 1)
    return F.lit(True) if share >= 1 else F.xxhash64(key) < F.lit(int(-2 ** 63 + share * 2 ** 64))


def sample_ids(rows: DataFrame, n: int, *keep: str) -> DataFrame:
    """n rows in the order of a hash of doc_id: the same rows at any partitioning. Ids do not repeat in rows.

    A task sends on what is below a bound of the hash, so all tasks together send little more than n rows.
    """
    rows = rows.select("doc_id", *keep).where("doc_id IS NOT NULL")
    return rows.where(in_sample(n, rows.count(), F.col("doc_id"))).orderBy(
        F.xxhash64("doc_id"), "doc_id", *keep).limit(n)


def with_sampled_text(docs: DataFrame, sampled: DataFrame) -> DataFrame:
    """The text of each sampled row, whose columns are doc_id and others, all of them keys of docs but for a label.

    The sample is bounded by its caller, so it is sent to every task. Of rows that share the keys the
    least text is taken, where they are read: a repeated id brings one text.
    """
    keys = [c for c in sampled.columns if c in docs.columns]
    return docs.select(*keys, "text").join(F.broadcast(sampled), keys).groupBy(*sampled.columns).agg(F.min("text").alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal inputs stay equal, others spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
