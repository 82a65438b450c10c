"""Demand forecasting: forest, ridge benchmark, metrics and preparation sizing."""

from collections.abc import Sequence

import numpy as np
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import exact, fixed, keyhash
from larder.operators.mining import features
from larder.operators.mining.classify import scenarios

TREES, DEPTH, SEED, RIDGE_ALPHA = 80, 12, 42, 1.0
NODES_MB = 64  # statistics of the nodes that are split together, in each task


def fit_forest(train: DataFrame, target: str = "sold_qty", trees: int = TREES,
               depth: int = DEPTH, bins: int = features.MAX_BINS):
    """Forest over all rows.

    Every node looks at all features, so the trees do not depend on how many nodes are split together.
    Each task holds and sends the statistics of those nodes, so they are few, and the tasks no more than run
    at once. Rows find their nodes in the trees; ids of them would be a number for each row and tree.
    """
    return RandomForestRegressor(
        labelCol=target, numTrees=trees, maxDepth=depth, featureSubsetStrategy="all",
        maxBins=bins, maxMemoryInMB=NODES_MB, cacheNodeIds=False, seed=SEED,
    ).fit(train.select("features", target).coalesce(train.sparkSession.sparkContext.defaultParallelism))


def fit_ridge(df: DataFrame, target: str = "sold_qty", columns: Sequence[str] = features.FEATURES,
              alpha: float = RIDGE_ALPHA) -> tuple[dict[str, float], float]:
    """Ridge coefficients and intercept, exactly.

    Two aggregations over the rows: the means, then the products of the centered columns. Only
    those sums, a matrix of the size of the feature list, are solved on the driver.
    """
    names = [*columns, target]
    centers = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    centered = [F.col(c).cast("double") - F.lit(float(centers[c])) for c in names]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = df.agg(*[F.sum(centered[i] * centered[j]) for i, j in pairs]).first()
    gram = np.zeros((len(names), len(names)))
    for (i, j), value in zip(pairs, sums):
        gram[i, j] = gram[j, i] = value
    k = len(columns)
    weights = np.linalg.solve(gram[:k, :k] + alpha * np.eye(k), gram[:k, k])
    intercept = centers[target] - float(weights @ [centers[c] for c in columns])
    return dict(zip(columns, map(float, weights))), intercept


def ridge_prediction(weights: dict[str, float], intercept: float) -> Column:
    return sum((F.col(c) * F.lit(w) for c, w in weights.items()), F.lit(intercept))


def metrics(df: DataFrame, actual: str = "sold_qty", predicted: str = "prediction") -> DataFrame:
    """R2, RMSE, MAE and the mean of the actual values in one aggregation."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    n = F.col("test_records")
    # squares of whole numbers are added as decimals, which neither overflow nor cancel
    squares = F.col(actual).cast("decimal(19,0)")
    sums = df.agg(
        F.count(F.lit(1)).alias("test_records"),
        F.sum(y.cast("decimal(19,0)")).alias("y"),
        F.sum((squares * squares).cast("decimal(28,0)")).alias("yy"),
        F.sum(error * error).cast("double").alias("ee"),
        F.sum(F.abs(error)).cast("double").alias("ae"),
    ).withColumn("spread", F.col("yy").cast("double") - F.col("y").cast("double") * F.col("y").cast("double") / n
                 ).withColumn("y", F.col("y").cast("double"))
    return sums.select(
        "test_records",
        F.round(1 - F.try_divide(F.col("ee"), F.col("spread")), 4)
        .alias("r2_score"),
        F.round(F.sqrt(F.col("ee") / n), 2).alias("rmse"),
        F.round(F.col("ae") / n, 2).alias("mae"),
        F.round(F.col("y") / n, 1).alias("mean_actual_demand"),
    )


def actual_vs_predicted(df: DataFrame, key: str = "fact_id", n: int = 25) -> DataFrame:
    """n rows in the order of a hash of the key, with the prediction floored at 0 and rounded."""
    return (
        df.orderBy(keyhash.unit_hash("pairs", key), key).limit(n)
        .select(key, F.col("sold_qty").alias("actual"),
                F.greatest(F.lit(0.0), F.rint("prediction")).cast("bigint").alias("predicted"))
    )


def prep_sizing(df: DataFrame, demand: str) -> DataFrame:
    """Preparation, surplus, cost and revenue for a demand per row.

    Needs category, base_price and checkout_price; all other columns stay.
    """
    perishable = F.col("category").isin(fixed.PERISHABLE_CATEGORIES)
    buffer = F.when(perishable, F.lit(float(fixed.PERISHABLE_BUFFER))).otherwise(
        F.lit(float(fixed.STANDARD_BUFFER)))
    percent = F.when(perishable, "8").otherwise("12")
    floored = F.greatest(F.lit(float(fixed.PREP_DEMAND_FLOOR)), F.col(demand).cast("double"))
    prep, surplus = F.col("recommended_preparation_qty"), F.col("estimated_surplus_waste_units")
    price = "decimal(12,2)"
    return df.withColumns({
        "forecasted_demand": F.rint(floored).cast("bigint"),
        "recommended_preparation_qty": F.rint(floored * (buffer + 1.0)).cast("bigint"),
        "recommended_safety_buffer_pct": F.round(buffer * 100, 1),
    }).withColumn(
        "estimated_surplus_waste_units", prep - F.col("forecasted_demand")
    ).withColumns({
        "projected_waste_percentage": exact.even_pct(surplus, prep),
        "estimated_waste_cost": (surplus * F.col("base_price").cast(price)).cast("double"),
        "projected_revenue": (F.col("forecasted_demand") * F.col("checkout_price").cast(price))
        .cast("double"),
        "waste_optimization_note": F.format_string(
            fixed.PREP_NOTE, prep.cast("string"), percent,
            F.format_string("%.1f", exact.even_pct(surplus, prep, 1))),
    })


def forecast(df: DataFrame, codes, model) -> DataFrame:
    """Predicted demand and its sizing for each scenario row."""
    filled = scenarios(df)
    scored = model.transform(features.assemble(features.encode(filled, codes)))
    sized = prep_sizing(scored, "prediction")
    new = [c for c in sized.columns if c not in scored.columns]
    return sized.select(*[c for c in df.columns if c not in fixed.SCENARIO_DEFAULTS], *new)
