"""Isolation forest anomalies and their diagnosis.

Trees are grown from small hash samples, one group per tree, and rows are scored in Arrow batches
against the finished trees; both are the only Python steps.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import exact, fixed, keyhash, ranks
from larder.sources.warehouse import Star

COLUMNS = ["waste_qty", "waste_percentage", "waste_cost", "discount_percent"]
TREES, SAMPLE, SEED, CONTAMINATION = 100, 256, 42, 0.02
DETAILS = ["fact_id", "week_number", "month_name", "item_name", "category", "cuisine",
           "center_name", "center_type", "prepared_qty", "sold_qty", "emailer_for_promotion",
           "homepage_featured"]
EULER = 0.5772156649015329


def extract(star: Star) -> DataFrame:
    return star.join("item", "center", "date").select(
        *DETAILS, *[F.col(c).cast("double").alias(c) for c in COLUMNS])


def average_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + EULER
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


def tree_samples(df: DataFrame, n: int, key: str = "fact_id", trees: int = TREES,
                 sample: int = SAMPLE) -> DataFrame:
    """Rows drawn for each tree: about 1.5 * sample per tree, whatever n is.

    A row is offered to as many random trees as the rate asks for, at least one, and taken by
    hash; with many rows nearly all are dropped by one hash comparison.
    """
    rate = 1.5 * sample * trees / max(n, 1)
    offers = max(1, min(trees, int(np.ceil(rate))))
    slot = F.explode(F.sequence(F.lit(0), F.lit(offers - 1))) if offers > 1 else F.lit(0)
    return (
        df.select(key, *COLUMNS, slot.alias("slot"))
        .where(keyhash.unit_hash("keep", key, "slot") < rate / offers)
        .withColumn("tree", F.floor(keyhash.unit_hash("tree", key, "slot") * trees).cast("int"))
        .withColumn("place", keyhash.unit_hash("place", key, "slot"))
    )


def grow(pdf: pd.DataFrame, key: str = "fact_id") -> pd.DataFrame:
    """One isolation tree from the `SAMPLE` rows of lowest hash, as a table of nodes."""
    pdf = pdf.sort_values("place").drop_duplicates(key).head(SAMPLE)
    tree = int(pdf["tree"].iloc[0])
    points = pdf[COLUMNS].to_numpy(float)
    rng = np.random.default_rng([SEED, tree])
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes = []  # (node, feature, threshold, left, right, path)

    def place(rows, depth):
        number = len(nodes)
        nodes.append(None)
        spread = np.flatnonzero(rows.max(0) > rows.min(0)) if len(rows) > 1 else []
        if depth >= limit or len(spread) == 0:
            nodes[number] = (number, -1, 0.0, -1, -1, depth + float(average_path(len(rows))))
            return number
        feature = int(rng.choice(spread))
        column = rows[:, feature]
        threshold = float(rng.uniform(column.min(), column.max()))
        left = place(rows[column <= threshold], depth + 1)
        right = place(rows[column > threshold], depth + 1)
        nodes[number] = (number, feature, threshold, left, right, 0.0)
        return number

    place(points, 0)
    frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
    return frame.assign(tree=tree, size=len(points))


NODES = ("node INT, feature INT, threshold DOUBLE, left INT, right INT, path DOUBLE, tree INT, "
         "size INT")


def fit(df: DataFrame, key: str = "fact_id") -> pd.DataFrame:
    """The nodes of all trees: at most 2 * SAMPLE - 1 per tree, so small on the driver."""
    samples = tree_samples(df, df.count(), key)
    return samples.groupBy("tree").applyInPandas(lambda pdf: grow(pdf, key), NODES).toPandas()


def score(df: DataFrame, nodes: pd.DataFrame) -> DataFrame:
    """Add anomaly_score = 2 ** (-mean path / expected path): near 1 is anomalous."""
    forest = []
    for _, tree in nodes.sort_values(["tree", "node"]).groupby("tree"):
        forest.append(tuple(tree[c].to_numpy() for c in
                            ("feature", "threshold", "left", "right", "path")))
    expected = float(average_path(nodes.groupby("tree")["size"].first()).mean())
    depth = int(np.ceil(np.log2(SAMPLE))) + 1

    def path_lengths(*columns: pd.Series) -> pd.Series:
        points = np.stack([c.to_numpy(float) for c in columns], 1)
        rows = np.arange(len(points))
        total = np.zeros(len(points))
        for feature, threshold, left, right, path in forest:
            at = np.zeros(len(points), int)
            for _ in range(depth):
                split = feature[at]
                lower = points[rows, np.maximum(split, 0)] <= threshold[at]
                at = np.where(split < 0, at, np.where(lower, left[at], right[at]))
            total += path[at]
        return pd.Series(2.0 ** (-total / len(forest) / expected))

    # only the four features travel to Python; the other columns stay in the JVM
    isolation = F.pandas_udf(path_lengths, "double")
    return df.withColumn("anomaly_score", isolation(*COLUMNS))


def flag(scored: DataFrame, column: str = "anomaly_score",
         contamination: float = CONTAMINATION,
         values: DataFrame | None = None) -> tuple[DataFrame, float]:
    """Flag the rows above the exact (1 - contamination) quantile; returns the threshold too.

    The quantile reads the column several times, from `values` if given, so that should be a
    plain scan.
    """
    values = scored if values is None else values
    threshold = ranks.quantile(values, column, 1 - contamination)
    return scored.withColumns({
        "is_anomaly": F.col(column) > F.lit(threshold),
        # below 0 is anomalous
        "decision_value": F.lit(threshold) - F.col(column),
    }), threshold


def diagnosis() -> Column:
    promo = (F.col("emailer_for_promotion") + F.col("homepage_featured")) > 0
    pct = F.col("waste_percentage")
    return (
        F.when(promo & (pct > 18), fixed.CAUSE_PROMO)
        .when(F.col("category").isin(fixed.FRESH_CATEGORIES) & (pct > 20), fixed.CAUSE_EXPIRY)
        .when((F.col("prepared_qty") > 2000) & (F.col("sold_qty") < 1200), fixed.CAUSE_BUFFER)
        .otherwise(fixed.CAUSE_COLLAPSE)
    )


def top(flagged: DataFrame, n: int = 15) -> DataFrame:
    """The costliest flagged rows with their diagnosis."""
    shown = [c for c in DETAILS if c not in ("emailer_for_promotion", "homepage_featured")]
    score_column = ([F.round("anomaly_score", 4).alias("anomaly_score")]
                    if "anomaly_score" in flagged.columns else [])
    return (
        flagged.where("is_anomaly")
        .orderBy(F.desc("waste_cost"), "fact_id").limit(n)
        .select(*shown, F.col("waste_qty").cast("bigint").alias("waste_qty"),
                F.bround("waste_percentage", 1).alias("waste_percentage"), "waste_cost",
                *score_column, diagnosis().alias("root_cause_diagnosis"))
    )


def summary(flagged: DataFrame, threshold: float,
            contamination: float = CONTAMINATION) -> DataFrame:
    """Counts, the threshold of the scores and the lowest signed value, which is below 0 for anomalies."""
    anomalies = F.sum(F.col("is_anomaly").cast("int"))
    n = F.count(F.lit(1))
    return flagged.agg(
        F.lit(contamination).alias("contamination"),
        n.alias("total_records_analyzed"),
        anomalies.alias("anomalies_detected"),
        exact.even_pct(anomalies, n).alias("anomaly_rate_pct"),
        F.round(F.min("decision_value"), 4).alias("lowest_decision_value"),
        F.lit(round(threshold, 4)).alias("raw_score_threshold"),
    )
