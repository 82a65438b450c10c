"""Short findings for managers."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators.totals import mean_pct, total, total_money
from larder.sources.warehouse import Star


def high_waste_items(star: Star, n: int = 3) -> DataFrame:
    """Items by mean waste percentage, rounded to one decimal before ranking."""
    return (
        star.totals("item_name", "category")
        .groupBy("item_name", "category")
        .agg(
            mean_pct(1).alias("avg_waste_pct"),
            total("waste").alias("total_wasted"),
            total_money("waste_cost").alias("monetary_loss"),
        )
        .orderBy(F.desc("avg_waste_pct"), "item_name", "category").limit(n)
    )


def peak_periods(star: Star, n: int = 2) -> DataFrame:
    return (
        star.totals("month_name", "quarter")
        .groupBy("month_name", "quarter")
        .agg(total("sold").alias("total_orders"), mean_pct(1).alias("waste_pct"))
        .orderBy(F.desc("total_orders"), "month_name").limit(n)
    )


def cards(high_waste: DataFrame, peaks: DataFrame, rules: DataFrame, anomalies: DataFrame,
          clusters: DataFrame) -> DataFrame:
    """Five text cards from the best row of each finding.

    `rules` are presented rules, `anomalies` the top anomalies, `clusters` profiles with names,
    strategies and top categories.
    """
    spoilage = F.col("name").contains("Spoilage") | (F.col("avg_waste_pct") > 13)
    first = {
        "high_waste": high_waste.orderBy(F.desc("avg_waste_pct"), "item_name").limit(1),
        "peak": peaks.orderBy(F.desc("total_orders"), "month_name").limit(1),
        "rule": rules.orderBy(F.desc("lift"), F.desc("confidence"), "antecedent",
                              "consequent").limit(1),
        "anomaly": anomalies.orderBy(F.desc("waste_cost"), "fact_id").limit(1),
        "cluster": clusters.orderBy(F.desc(spoilage), "cluster").limit(1),
    }
    arguments = {  # title, metric value, summary
        "high_waste": (["category"], ["avg_waste_pct"],
                       ["item_name", "total_wasted", "monetary_loss"]),
        "peak": (["month_name"], ["total_orders"], ["month_name", "waste_pct"]),
        "rule": (["antecedent", "consequent"], ["confidence_pct", "lift"],
                 ["antecedent", "confidence_pct", "consequent"]),
        "anomaly": (["center_name"], ["waste_cost"],
                    ["fact_id", "item_name", "week_number", "prepared_qty", "sold_qty",
                     "waste_percentage", "root_cause_diagnosis"]),
        "cluster": (["name"], ["percentage_of_catalog"],
                    ["record_count", "avg_waste_pct", F.array_join("top_categories", ", ")]),
    }
    rows = []
    for name, df in first.items():
        card = fixed.INSIGHT_CARDS[name]
        title, metric, summary = (
            F.format_string(card[part], *args)
            for part, args in zip(("title", "metric_value", "summary"), arguments[name]))
        rows.append(df.select(
            F.lit(card["id"]).alias("id"),
            F.lit(card["category"]).alias("category"),
            F.lit(card["badge"]).alias("badge"),
            title.alias("title"),
            F.lit(card["metric_label"]).alias("metric_label"),
            metric.alias("metric_value"),
            summary.alias("summary"),
            (F.lit(card["action"]) if card["action"] else F.col("operational_strategy"))
            .alias("action"),
        ))
    return reduce(DataFrame.unionByName, rows)
