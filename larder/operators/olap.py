"""Slice, dice, roll-up, drill-down and pivot over the star."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import totals
from larder.sources.warehouse import Star

SLICE_DIMENSIONS = {
    "cuisine": "cuisine", "category": "category_name", "center_type": "center_type",
    "quarter": "quarter", "season": "season", "month_name": "month_name",
}
ROLLUP_LEVELS = {
    "week": ["year", "week_number"],
    "month": ["year", "month_name", "month_number"],
    "quarter": ["year", "quarter"],
    "year": ["year"],
    "cuisine": ["cuisine"],
    "center_type": ["center_type"],
    "category": ["category_name", "food_group"],
}
# from totals by key
PIVOT_METRICS = {
    "waste_cost": lambda: totals.total_money("waste_cost"),
    "waste_qty": lambda: totals.total("waste"),
    "sold_qty": lambda: totals.total("sold"),
    "revenue": lambda: totals.total_money("revenue"),
    "waste_percentage": totals.mean_pct,
}
ALL = ["item", "center", "date", "category"]


def _first(rows: DataFrame, limit: int | None, *order) -> DataFrame:
    """The first rows in an order; all of them, ordered, if limit is None."""
    rows = rows.orderBy(*order)
    return rows if limit is None else rows.limit(limit)


def _totals(count_name: str) -> list:
    return [
        totals.total("records").alias(count_name),
        totals.total("prepared").alias("total_prepared"),
        totals.total("sold").alias("total_sold"),
        totals.total("waste").alias("total_waste"),
        totals.mean_pct().alias("avg_waste_pct"),
        totals.total_money("waste_cost").alias("total_waste_cost"),
        totals.total_money("revenue").alias("total_revenue"),
    ]


def slice_(star: Star, dimension: str, value: str, limit: int | None = 100) -> DataFrame:
    """Fix one dimension to one member and total the rest."""
    if dimension not in SLICE_DIMENSIONS:
        raise ValueError(f"slice by one of {list(SLICE_DIMENSIONS)}, not {dimension!r}")
    by = ["category", "cuisine", "center_type", "month_name"]
    column = SLICE_DIMENSIONS[dimension]
    return (
        star.totals(*dict.fromkeys([*by, column]), known=ALL)
        .where(F.col(column) == value)
        .groupBy(*by).agg(*_totals("total_records"))
        .transform(_first, limit, F.desc("total_waste"), *by)
    )


def dice(star: Star, cuisine=None, category=None, center_type=None, quarter=None,
         waste_risk=None, limit: int | None = 100) -> DataFrame:
    """Detail rows that meet all the given conditions, costliest waste first."""
    rows = star.join("item", "center", "date")
    wanted = {"cuisine": cuisine, "category": category, "center_type": center_type,
              "quarter": quarter, "waste_risk_tier": waste_risk}
    for column, value in wanted.items():
        if value:
            rows = rows.where(F.col(column) == value)
    return rows.select(
        "fact_id", "week_number", "month_name", "quarter", "item_name", "category", "cuisine",
        "center_name", "center_type", "prepared_qty", "sold_qty", "waste_qty",
        F.col("waste_percentage").alias("waste_pct"),
        F.col("waste_cost").cast("double").alias("waste_cost"),
        F.col("revenue").cast("double").alias("revenue"),
        "waste_risk_tier",
    ).transform(_first, limit, F.desc("waste_cost"), "fact_id")


def rollup(star: Star, level: str = "month") -> DataFrame:
    """Totals at one level of a hierarchy."""
    by = ROLLUP_LEVELS.get(level, ROLLUP_LEVELS["category"])
    rows = star.totals(*by, known=ALL).groupBy(*by).agg(*_totals("record_count"))
    if level in ("week", "month", "quarter", "year"):
        order = [*(c for c in ("year", "month_number", "quarter", "week_number") if c in by)]
        name = {"week": "week_number", "month": "month_name"}.get(level, level)
        rows = rows.orderBy(*order).withColumn("time_dimension", F.col(name))
        return rows.drop(*(c for c in by if c != "year"))
    name = by[0]
    return rows.orderBy(F.desc("total_waste"), name).withColumnRenamed(
        name, "grouping_dimension")


def rollup_hierarchy(star: Star) -> DataFrame:
    """Year, quarter and month totals and the grand total in one pass."""
    by = ["year", "quarter", "month_number"]
    return (
        star.totals(*by, known=ALL).rollup(*by)
        .agg(F.grouping_id().cast("int").alias("level"), *_totals("record_count"))
        .orderBy("level", *by)
    )


def drilldown(star: Star, parent: str, value: str, limit: int | None = 25) -> DataFrame:
    """Totals of the members below one category (its meals) or center type (its centers).

    The fact is totalled by key before the join, so a hot key costs the join one row.
    """
    if parent == "category":
        members = star.item.where(F.col("category") == value).select(
            "meal_id", "item_name", "cuisine", "perishability_tier")
        sums = star.totals("meal_id").groupBy("meal_id").agg(*_totals("center_weeks_recorded"))
        return sums.join(members, "meal_id").select(
            *members.columns, *sums.drop("meal_id").columns
        ).orderBy(F.desc("total_waste"), "meal_id")
    if parent == "center_type":
        members = star.center.where(F.col("center_type") == value).select(
            "center_id", "center_name", "city_code", "op_area")
        sums = star.totals("center_id").groupBy("center_id").agg(*_totals("total_records")[:-1])
        return sums.join(members, "center_id").select(
            *members.columns, *sums.drop("center_id").columns
        ).transform(_first, limit, F.desc("total_waste"), "center_id")
    raise ValueError(f"drill down from 'category' or 'center_type', not {parent!r}")


def pivot(star: Star, row: str = "category", column: str = "center_type",
          metric: str = "waste_cost", columns: list[str] | None = None) -> DataFrame:
    """Cross table of a metric, 0 where there are no rows, with the sum of each row's cells.

    The total of waste_percentage is therefore a sum of means. Without `columns`, the distinct
    labels are read from the dimension.
    """
    row = "category" if row == "category" else "cuisine"
    column = "center_type" if column == "center_type" else "quarter"
    if columns is None:
        dim = star.center if column == "center_type" else star.date
        columns = sorted(r[0] for r in dim.select(column).distinct().collect())
    value = PIVOT_METRICS.get(metric, PIVOT_METRICS["waste_cost"])()
    cells = (
        star.totals(row, column, known=["item", "center", "date"])
        .groupBy(F.col(row).alias("label")).pivot(column, columns).agg(value)
        .fillna(0, columns)
    )
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    if metric not in ("waste_qty", "sold_qty"):
        total = F.round(total, 2)
    return cells.withColumn("total", total).orderBy("label")
