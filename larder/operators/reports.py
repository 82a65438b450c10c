"""The audit report, the detail browser and the warehouse extract."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators.totals import total, total_money, waste_pct
from larder.sources.warehouse import Star


def category_scorecard(star: Star) -> DataFrame:
    """Waste by category; the rating tests the unrounded ratio of the sums."""
    urgent, attention, fine = fixed.RATINGS

    def above(limit):
        return F.sum("waste") * 100 > F.sum("prepared") * int(limit)

    return (
        star.totals("category_name", "food_group", "spoilage_sensitivity")
        .groupBy("category_name", "food_group", "spoilage_sensitivity")
        .agg(
            total("records").alias("total_observations"),
            total("prepared").alias("prepared_units"),
            total("sold").alias("sold_units"),
            total("waste").alias("wasted_units"),
            waste_pct().alias("waste_percentage"),
            total_money("waste_cost").alias("waste_cost_dollars"),
            total_money("revenue").alias("revenue_dollars"),
            F.when(above(fixed.RATING_URGENT_ABOVE), urgent)
            .when(above(fixed.RATING_ATTENTION_ABOVE), attention)
            .otherwise(fine).alias("efficiency_rating"),
        )
        .orderBy(F.desc("waste_percentage"), "category_name")
    )


def top_centers(star: Star, n: int = 10) -> DataFrame:
    by = ["center_id", "center_name", "center_type", "op_area"]
    return (
        star.totals(*by)
        .groupBy(*by)
        .agg(
            total("waste").alias("wasted_units"),
            waste_pct().alias("waste_percentage"),
            total_money("waste_cost").alias("waste_cost_dollars"),
        )
        .orderBy(F.desc("waste_cost_dollars"), "center_id").limit(n)
    )


def savings(star: Star) -> DataFrame:
    """Total waste cost over the audited categories and the part to be saved."""
    cost = F.sum(F.col("waste_cost_dollars").cast("decimal(30,2)"))
    share = F.lit(str(fixed.SAVINGS_SHARE)).cast("decimal(3,2)")
    return category_scorecard(star).agg(
        F.count(F.lit(1)).alias("total_categories_audited"),
        cost.cast("double").alias("total_waste_cost"),
        F.round(cost * share, 2).cast("double").alias("projected_savings_target"),
    )


def _matching(star: Star, search: str | None) -> DataFrame:
    """Joined rows whose item, category or center contains the text in any case."""
    rows = star.join("item", "center", known=["item", "center", "date"])
    if search:
        text = f"%{search}%"
        rows = rows.where(F.col("item_name").ilike(text) | F.col("category").ilike(text)
                          | F.col("center_name").ilike(text))
    return rows


def _block_after(star: Star, after: int, limit: int, search: str | None) -> DataFrame:
    """Matching rows behind a fact_id, at least `limit` of them if there are so many.

    Facts are numbered without gaps and written in that order, so a page is looked for in the next
    few ids, which are in few row groups. While it is not full the block grows eightfold: a page
    costs little more than the rows up to its last one, and the rest of the table is not read.
    """
    rows, span, last = _matching(star, search), limit, None
    while True:
        block = rows.where(F.col("fact_id") > after).where(F.col("fact_id") <= after + span)
        if block.limit(limit).count() == limit:
            return block
        if last is None:
            last = star.fact.agg(F.max("fact_id")).first()[0] or 0
        if after + span >= last:
            return block
        span *= 8


def browse(star: Star, page: int = 1, limit: int = 20, search: str | None = None,
           after: int | None = None) -> DataFrame:
    """One page of detail rows in load order.

    With `after`, the page starts after that fact_id and reads the rows up to its end only; page
    numbers must skip rows.
    """
    if after is not None:
        rows = _block_after(star, after, limit, search).orderBy("fact_id")
    else:
        rows = _matching(star, search).orderBy("fact_id").offset((page - 1) * limit)
    return rows.limit(limit).join(star.date, "date_id").orderBy("fact_id").select(
        "original_record_id", "week_number", "month_name", "item_name", "category", "cuisine",
        "center_name", "center_type",
        F.col("base_price").cast("double").alias("base_price"),
        F.col("checkout_price").cast("double").alias("checkout_price"),
        "discount_percent", "emailer_for_promotion", "homepage_featured",
        "sold_qty", "prepared_qty", "waste_qty", "waste_percentage",
        F.col("waste_cost").cast("double").alias("waste_cost"),
    )


def browse_count(star: Star, limit: int = 20, search: str | None = None) -> DataFrame:
    """Rows and pages of the same joined rows that `browse` shows.

    Facts are counted by their keys before the join, so a text is compared once for each pair of item
    and center.
    """
    keys = ["meal_id", "center_id", *(["date_id"] if "date" not in star.complete else [])]
    counted = replace(star, fact=star.fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    rows = _matching(counted, search).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"))
    return rows.withColumn(
        "total_pages", F.call_function("div", F.col("total_records") + (limit - 1), F.lit(limit)))


EXTRACT_COLUMNS = ["fact_id", "week_number", "month_name", "item_name", "category", "cuisine",
                   "center_name", "center_type", "checkout_price", "base_price", "sold_qty",
                   "prepared_qty", "waste_qty", "waste_percentage", "waste_cost", "revenue"]


def extract(star: Star, limit: int | None = None) -> DataFrame:
    """The joined detail rows for export: all of them, or the first `limit` in load order."""
    rows = star.join("item", "center", "date").select(*EXTRACT_COLUMNS)
    return rows if limit is None else rows.orderBy("fact_id").limit(limit)
