"""Demand tier classification: forests, metrics, confusion matrix, batch scoring."""

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import exact, fixed
from larder.operators.mining import features

TREES, DEPTH, BENCHMARK_DEPTH, SEED = 100, 12, 8, 42


def with_label(df: DataFrame) -> DataFrame:
    """Number the tiers LOW 0, MEDIUM 1, HIGH 2."""
    position = F.array_position(F.array(*map(F.lit, fixed.TIER_LABELS)), F.col("demand_tier"))
    return df.withColumn("label", (position - 1).cast("double"))


def fit_forest(train: DataFrame, trees: int = TREES, depth: int = DEPTH,
               bins: int = features.MAX_BINS):
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", maxBins=bins,
        maxMemoryInMB=1024, cacheNodeIds=True, seed=SEED,
    ).fit(train)


def fit_tree(train: DataFrame, depth: int = BENCHMARK_DEPTH, bins: int = features.MAX_BINS):
    return DecisionTreeClassifier(
        maxDepth=depth, maxBins=bins, maxMemoryInMB=1024, seed=SEED).fit(train)


def predicted_tier(prediction: str = "prediction") -> Column:
    labels = F.array(*map(F.lit, fixed.TIER_LABELS))
    return F.element_at(labels, F.col(prediction).cast("int") + 1)


def confusion(df: DataFrame, actual: str = "demand_tier",
              predicted: str = "predicted_tier") -> DataFrame:
    """Counts of every (actual, predicted) pair of labels, with 0 where there are no rows."""
    labels = F.array(*map(F.lit, fixed.TIER_LABELS))
    grid = (
        df.sparkSession.range(1).select(F.explode(labels).alias("actual"))
        .select("actual", F.explode(labels).alias("predicted"), F.lit(0).alias("n"))
    )
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.unionByName(grid).groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


def confusion_with_totals(counts: DataFrame) -> DataFrame:
    """The matrix with row, column and grand totals."""
    return counts.cube("actual", "predicted").agg(F.sum("n").alias("n")).select(
        F.coalesce("actual", F.lit("TOTAL")).alias("actual"),
        F.coalesce("predicted", F.lit("TOTAL")).alias("predicted"),
        "n",
    )


def metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and the label-weighted precision, recall and F1, in percent.

    A label that is never predicted counts with precision 0.
    """
    hit = F.col("actual") == F.col("predicted")
    sums = {}
    for label in fixed.TIER_LABELS:
        sums |= {
            f"hits_{label}": F.sum(F.when(hit & (F.col("actual") == label), F.col("n"))),
            f"actual_{label}": F.sum(F.when(F.col("actual") == label, F.col("n"))),
            f"predicted_{label}": F.sum(F.when(F.col("predicted") == label, F.col("n"))),
        }
    row = counts.agg(F.sum("n").alias("test_records"), F.sum(F.when(hit, F.col("n"))).alias("hits"),
                     *[total.alias(name) for name, total in sums.items()])
    precision, recall, f1 = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for label in fixed.TIER_LABELS:
        hits, actual, predicted = (F.col(f"{kind}_{label}")
                                   for kind in ("hits", "actual", "predicted"))
        weight = actual / F.col("test_records")
        precision += weight * F.coalesce(F.try_divide(hits, predicted), F.lit(0.0))
        recall += weight * F.coalesce(F.try_divide(hits, actual), F.lit(0.0))
        f1 += weight * F.coalesce(F.try_divide(2 * hits, actual + predicted), F.lit(0.0))
    return row.select(
        "test_records",
        exact.ratio_pct(F.col("hits"), F.col("test_records")).alias("accuracy"),
        F.round(precision * 100, 2).alias("precision"),
        F.round(recall * 100, 2).alias("recall"),
        F.round(f1 * 100, 2).alias("f1_score"),
    )


def feature_importance(spark, model, columns=features.FEATURES) -> DataFrame:
    """One row per feature, in percent."""
    rows = [(name, float(value)) for name, value in zip(columns, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").withColumn(
        "importance", F.round(F.col("importance") * 100, 2)).orderBy(
        F.desc("importance"), "feature")


def scenarios(df: DataFrame) -> DataFrame:
    """Fill missing inputs with the defaults and derive the discount; other columns stay."""
    inputs = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in fixed.SCENARIO_DEFAULTS.items()
    }
    for name in ("checkout_price", "base_price", "op_area"):
        inputs[name] = inputs[name].cast("double")
    base, checkout = F.col("base_price"), F.col("checkout_price")
    amount = F.greatest(F.lit(0.0), base - checkout)
    return df.withColumns(inputs).withColumns({
        "discount_amount": amount,
        "discount_percent": F.round(amount / F.greatest(base, F.lit(1.0)) * 100, 2),
    })


def score(df: DataFrame, codes, model) -> DataFrame:
    """Tier, its probabilities in percent and advice for each scenario row."""
    scored = model.transform(features.assemble(features.encode(scenarios(df), codes)))
    probability = vector_to_array("probability")
    advice = F.create_map(*[F.lit(x) for pair in fixed.TIER_ADVICE.items() for x in pair])
    return scored.withColumn("predicted_demand_tier", predicted_tier()).select(
        *[c for c in df.columns if c not in fixed.SCENARIO_DEFAULTS],
        "predicted_demand_tier",
        *[F.round(probability[i] * 100, 1).alias(f"probability_{label}")
          for i, label in enumerate(fixed.TIER_LABELS)],
        F.round("discount_amount", 2).alias("discount_applied"),
        F.col("discount_percent").alias("discount_percentage"),
        F.element_at(advice, F.col("predicted_demand_tier"))
        .alias("waste_prevention_recommendation"),
    )
