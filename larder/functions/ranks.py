"""Exact order statistics of large columns, without sorting them and without one big task."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
SKETCH_K, SKETCH_ERROR = 2048, 0.003  # of the quantile sketch, and thrice its usual error in rank


def kth_smallest(df: DataFrame, value: str, ranks: dict, group: str | None = None) -> dict:
    """The ranks[g]-th smallest (from 1) value of each group, exactly.

    A mergeable quantile sketch, made in the pass that finds the bounds, says about where the rank is.
    The first count looks there, with a bucket for all below and one for all above, so a sketch that
    is off costs a pass and no more. Each pass counts the values of the interval that holds the wanted rank in 1,024 equal
    buckets and keeps one of them, so a pass shuffles at most 1,024 rows per group and the
    interval shrinks until it holds one distinct value. Only bounds and counts reach the driver.
    `value` must be numeric; ranks is {group value: rank}, with the key None if there is no group.
    Nulls and NaN are no values and have no rank. A rank beyond a group's values is an error.
    """
    key = F.col(group) if group else F.lit(None).cast("string")
    rows = df.select(key.alias("g"), F.col(value).cast("double").alias("v"))
    rows = rows.where("v IS NOT NULL AND NOT isnan(v)")
    sizes = rows.groupBy("g").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_double("v", SKETCH_K).alias("sketch")).collect()
    bounds = {r.g: (r.lo, r.hi) for r in sizes}
    for g, rank in ranks.items():
        n = next((r.n for r in sizes if r.g == g), 0)
        if not 1 <= rank <= n:
            raise ValueError(f"rank {rank} of {n} values" + f" in group {g!r}" * (group is not None))
    todo = {g: (*bounds[g], rank) for g, rank in ranks.items()}  # interval and rank inside it
    about = _about(df, {r.g: (r.sketch, ranks[r.g] / r.n) for r in sizes if r.g in ranks and r.lo < r.hi})
    found = {}
    while True:
        found |= {g: lo for g, (lo, hi, _) in todo.items() if lo == hi}
        todo = {g: t for g, t in todo.items() if g not in found}
        if not todo:
            return found
        counted = (
            rows.where(_any(_inside(g, lo, hi) for g, (lo, hi, _) in todo.items()))
            .withColumn("b", F.coalesce(*[
                F.when(_inside(g, lo, hi), _outer(F.col("v"), *about[g]) if g in about else _bucket(F.col("v"), lo, hi))
                for g, (lo, hi, _) in todo.items()
            ]))
            .groupBy("g", "b")
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("g", "b")
            .collect()
        )
        for g, (_, _, rank) in list(todo.items()):
            for r in (r for r in counted if r.g == g):
                if rank <= r.n:
                    todo[g] = (r.lo, r.hi, rank)
                    break
                rank -= r.n
        about = {}


def _about(df: DataFrame, sketches: dict) -> dict:
    """{group: interval} that nearly surely holds the value at a share of the rows, by the group's sketch."""
    if not sketches:
        return {}
    shares = [F.array(*[F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), F.lit(min(max(share + error, 0.0), 1.0)))
                        for error in (-SKETCH_ERROR, SKETCH_ERROR)]) for sketch, share in sketches.values()]
    found = df.sparkSession.range(1).select(*[c.alias(f"q{k}") for k, c in enumerate(shares)]).first()
    return {g: tuple(q) for g, q in zip(sketches, found) if all(map(math.isfinite, q))}


def quantile(df: DataFrame, value: str, q: float) -> float:
    """Linear-interpolation quantile of the values, exactly; an error if there is none."""
    number = F.col(value).cast("double")
    n = df.where(number.isNotNull() & ~F.isnan(number)).count()
    position = q * (n - 1)
    low = int(position)
    lo = kth_smallest(df, value, {None: low + 1})[None]
    if position == low:
        return lo
    # the next value is the same one, or the least above it
    upto, above = df.select(number.alias("v")).where("v IS NOT NULL AND NOT isnan(v)").agg(
        F.count_if(F.col("v") <= lo), F.min(F.when(F.col("v") > lo, F.col("v")))).first()
    hi = lo if upto >= low + 2 else above
    return lo + (hi - lo) * (position - low)


def _inside(g, lo: float, hi: float) -> Column:
    return F.col("g").eqNullSafe(F.lit(g)) & F.col("v").between(lo, hi)


def _bucket(v: Column, lo: float, hi: float) -> Column:
    # halves, because the whole width may be beyond the largest number
    width = F.least(F.floor((v / 2 - lo / 2) / F.lit(hi / 2 - lo / 2) * BUCKETS), F.lit(BUCKETS - 1))
    # the ends are buckets of their own, so that every pass splits the interval
    return F.when(v == lo, -1).when(v == hi, BUCKETS).otherwise(width)


def _outer(v: Column, lo: float, hi: float) -> Column:
    """Buckets of an interval, and one on each side of it."""
    inner = _bucket(v, lo, hi) if lo < hi else F.lit(-1)
    return F.when(v < lo, -2).when(v > hi, BUCKETS + 1).otherwise(inner)


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)
