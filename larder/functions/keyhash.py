"""Sampling and splitting by a hash of the row key: the same rows at any partitioning."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 2 ** 53


def unit_hash(salt: str, *key: str | Column) -> Column:
    """A number in [0, 1) from a 64-bit hash of the key."""
    return F.pmod(F.xxhash64(F.lit(salt), *key), F.lit(SPACE)) / F.lit(float(SPACE))
