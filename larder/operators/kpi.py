"""Headline figures and dashboard charts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import exact
from larder.operators.totals import mean_pct, total, total_money, waste_pct
from larder.sources.warehouse import Star


def summary(star: Star) -> DataFrame:
    """All facts, joined to nothing, so that rows with unknown keys count too."""
    return star.totals().agg(
        F.coalesce(total("records"), F.lit(0)).alias("total_records"),
        total("prepared").alias("total_food_prepared"),
        total("sold").alias("total_food_sold"),
        total("waste").alias("total_food_wasted"),
        waste_pct().alias("overall_waste_percentage"),
        total_money("waste_cost").alias("total_waste_cost"),
        total_money("revenue").alias("total_revenue"),
        total_money("profit_loss").alias("total_profit_loss"),
    ).select(
        "*",
        star.center.agg(F.count(F.lit(1))).scalar().alias("active_fulfillment_centers"),
        star.item.agg(F.count(F.lit(1))).scalar().alias("monitored_menu_items"),
    )


def monthly(star: Star) -> DataFrame:
    """Months of all years together."""
    return (
        star.totals("month_name", "month_number")
        .groupBy("month_name", "month_number")
        .agg(
            total("sold").alias("demand_sold"),
            total("prepared").alias("food_prepared"),
            total("waste").alias("food_wasted"),
            mean_pct().alias("waste_pct"),
        )
        .orderBy("month_number")
    )


def top_wasted(star: Star, n: int = 8) -> DataFrame:
    by = ["item_name", "category", "cuisine"]
    return (
        star.totals(*by)
        .groupBy(*by)
        .agg(
            total("waste").alias("total_waste_units"),
            total_money("waste_cost").alias("total_waste_cost"),
            mean_pct().alias("avg_waste_pct"),
        )
        .orderBy(F.desc("total_waste_units"), *by).limit(n)
    )


def by_cuisine(star: Star) -> DataFrame:
    return (
        star.totals("cuisine")
        .groupBy("cuisine")
        .agg(
            total("prepared").alias("prepared"),
            total("sold").alias("sold"),
            total("waste").alias("waste"),
            waste_pct().alias("waste_pct"),
            total_money("waste_cost").alias("cost"),
        )
        .orderBy(F.desc("waste"), "cuisine")
    )


def by_center_type(star: Star) -> DataFrame:
    """After totalling by center there is one row per center, so distinct centers is a count."""
    return (
        star.totals("center_id", "center_type")
        .groupBy("center_type")
        .agg(
            F.count(F.lit(1)).alias("center_count"),
            total("sold").alias("sold"),
            total("waste").alias("waste"),
            waste_pct().alias("waste_pct"),
        )
        .orderBy("center_type")
    )


def by_risk_tier(star: Star) -> DataFrame:
    """Share of each tier; the window runs over the three totals."""
    everything = F.sum("record_count").over(Window.partitionBy())
    return (
        star.totals("waste_risk_tier").groupBy("waste_risk_tier").agg(total("records").alias("record_count"))
        .withColumn("percentage", exact.ratio_pct(F.col("record_count"), everything, 1))
        .orderBy("waste_risk_tier")
    )


SKETCH_BITS = 14  # registers of a sketch, as a power of two: a standard error of 0.8 %


def meal_sketches(star: Star) -> DataFrame:
    """date_id, center_type and a mergeable sketch of the meals served there that day.

    A few kilobytes for each row, whatever the number of facts; they are made by center before the
    join, kept, and merged for any period later without reading facts again.
    """
    daily = star.fact.groupBy("date_id", "center_id").agg(F.hll_sketch_agg("meal_id", SKETCH_BITS).alias("meals"))
    return daily.join(star.center.select("center_id", "center_type"), "center_id").groupBy("date_id", "center_type").agg(
        F.hll_union_agg("meals").alias("meals"))


def meals_by_period(star: Star, sketches: DataFrame, period: str = "year") -> DataFrame:
    """About how many different meals each center type served in a period of the calendar, from daily sketches."""
    return sketches.join(star.date.select("date_id", period), "date_id").groupBy(period, "center_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("meals")).alias("about_meals"))


def exact_meals_by_period(star: Star, period: str = "year") -> DataFrame:
    """The exact numbers; a meal is one row of a period and center before the join."""
    served = star.fact.join(star.date.select("date_id", period), "date_id").select(period, "center_id", "meal_id").distinct()
    return served.join(star.center.select("center_id", "center_type"), "center_id").groupBy(period, "center_type").agg(
        F.countDistinct("meal_id").alias("meals"))
