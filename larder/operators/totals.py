"""Totals of the fact by one key, from which the reports are joined and totalled further.

Totalling before the join keeps a hot key from reaching the join as more than one row, and lets
the tasks combine rows before the shuffle. All sums can be added up, so some sets of totals are kept
beside the facts: a load writes them, an append adds those of its own rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import exact


SUMS = ["records", "prepared", "sold", "waste", "pct_hundredths", "waste_cost", "revenue", "profit_loss"]
# what the kept sets are totalled by, sets of few rows first
KEPT = {
    "tier": ["waste_risk_tier"],
    "category": ["category_id"],
    "date": ["date_id"],
    "center": ["center_id"],
    "meal": ["meal_id"],
    "group": ["date_id", "category_id", "category", "cuisine", "center_type"],
}


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("records"),
        F.sum("prepared_qty").alias("prepared"),
        F.sum("sold_qty").alias("sold"),
        F.sum("waste_qty").alias("waste"),
        F.sum(exact.hundredths(F.col("waste_percentage"))).alias("pct_hundredths"),
        F.sum("waste_cost").alias("waste_cost"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit_loss").alias("profit_loss"),
    ]


def by_key(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(*_sums())


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Totals by fewer keys, or of several loads, from totals."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def kept_rows(fact: DataFrame, item: DataFrame, center: DataFrame, *known: DataFrame) -> DataFrame:
    """All kept sets from one pass over the facts; `kept` names the set of each row.

    The set by groups leaves out facts without an item, a center or a member of a dimension in `known`,
    which has its key as first column. Tasks combine rows by every set before the shuffle. The rows of a
    set lie together in the files, so that a reader of one set skips the row groups of others.
    """
    rows, has_all = fact, F.lit(True)
    sides = [item.select("meal_id", "category", "cuisine"), center.select("center_id", "center_type"),
             *[dim.select(dim.columns[0]) for dim in known]]
    for k, side in enumerate(sides):
        rows = rows.join(side.withColumn(f"has_{k}", F.lit(True)), side.columns[0], "left")
        has_all = has_all & F.col(f"has_{k}").isNotNull()
    rows = rows.withColumn("has_all", has_all)
    columns = list(dict.fromkeys(["has_all", *[c for by in KEPT.values() for c in by]]))
    sets = {name: by if name != "group" else ["has_all", *by] for name, by in KEPT.items()}
    # the number of a grouping has a bit for each column that it does not have, the first one highest
    numbers = {sum(1 << k for k, c in enumerate(reversed(columns)) if c not in by): name
               for name, by in sets.items()}
    names = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return rows.groupingSets([[F.col(c) for c in by] for by in sets.values()], *columns).agg(
        F.element_at(names, F.grouping_id().cast("int")).alias("kept"), *_sums(),
    ).where((F.col("kept") != "group") | F.col("has_all")).drop("has_all").sortWithinPartitions("kept")


def total(name: str) -> Column:
    return F.sum(name)


def total_money(name: str) -> Column:
    return F.sum(name).cast("double")


def mean_pct(digits: int = 2) -> Column:
    """Mean of the row percentages."""
    return exact.mean_of(F.sum("pct_hundredths"), F.sum("records"), digits)


def waste_pct(digits: int = 2) -> Column:
    """Waste as a share of prepared: the ratio of the sums."""
    return exact.ratio_pct(F.sum("waste"), F.sum("prepared"), digits)
