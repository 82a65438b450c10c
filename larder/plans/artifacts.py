"""What several queries share: the fitted models and the tables they were applied to.

Each is made once per application and set of tables. Tables are written to the shared folder, so
a lost executor costs no refit; models are small and stay on the driver.
"""

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import ingest
from larder.operators.mining import anomaly, classify, cluster, features, regress
from larder.session import scratch_dir
from larder.sources import extracts, warehouse
from larder.streaming import files

# labelled rows that the tier classifiers are fitted on, in the order of a hash of the key
CLASSIFIER_ROWS = 30_000

_made: dict[tuple, object] = {}


def once(make):
    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), make.__name__)
        if key not in _made:
            _made[key] = make(spark, sf_dir)
        return _made[key]
    return get


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@once
def encoded(spark, sf_dir):
    """Features of all facts with codes, label and the stratified split."""
    rows = features.extract(warehouse.star(spark, sf_dir))
    codes = features.fit_codes(rows)
    rows = written(classify.with_label(features.encode(rows, codes)), "features")
    return SimpleNamespace(codes=codes, rows=features.split(rows, "fact_id", "demand_tier"))


@once
def tier_rows(spark, sf_dir):
    """Training and test vectors of the classifiers; at most CLASSIFIER_ROWS train them."""
    made = encoded(spark, sf_dir)
    train, test = _vectors(made.rows)
    train = written(features.hash_sample(
        train.select("fact_id", "features", "label"), "fact_id", CLASSIFIER_ROWS), "tier-train")
    return SimpleNamespace(train=train, test=test, n=train.count(), bins=features.bins(made.codes))


@once
def classifier(spark, sf_dir):
    """Forest with its predictions for the test rows."""
    data = tier_rows(spark, sf_dir)
    forest = classify.fit_forest(data.train, bins=data.bins)
    tested = forest.transform(data.test).select(
        "fact_id", "demand_tier", classify.predicted_tier().alias("predicted_tier"))
    return SimpleNamespace(forest=forest, train_records=data.n, tested=written(tested, "classified"))


@once
def benchmark_tree(spark, sf_dir):
    """The single tree with its predictions for the test rows."""
    data = tier_rows(spark, sf_dir)
    tree = classify.fit_tree(data.train, bins=data.bins)
    tested = tree.transform(data.test).select(
        "fact_id", "demand_tier", classify.predicted_tier().alias("predicted_tier"))
    return SimpleNamespace(tree=tree, train_records=data.n, tested=written(tested, "benchmarked"))


@once
def demand_rows(spark, sf_dir):
    """Training and test vectors of the regressions; the split ignores the label."""
    made = encoded(spark, sf_dir)
    train, test = _vectors(features.split(made.rows.drop("is_train"), "fact_id"))
    train = written(train.select("features", "sold_qty", *features.FEATURES), "demand-train")
    return SimpleNamespace(train=train, test=test, n=train.count(), bins=features.bins(made.codes))


@once
def regressor(spark, sf_dir):
    """Demand forest with its predictions."""
    data = demand_rows(spark, sf_dir)
    forest = regress.fit_forest(data.train, bins=data.bins)
    tested = forest.transform(data.test).select("fact_id", "sold_qty", "prediction")
    return SimpleNamespace(forest=forest, train_records=data.n, tested=written(tested, "regressed"))


@once
def ridge(spark, sf_dir):
    """Ridge weights with their predictions."""
    data = demand_rows(spark, sf_dir)
    weights = regress.fit_ridge(data.train)
    tested = data.test.select(
        "fact_id", "sold_qty", regress.ridge_prediction(*weights).alias("prediction"))
    return SimpleNamespace(weights=weights, train_records=data.n, tested=written(tested, "ridged"))


def _vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = features.assemble(rows)
    return rows.where("is_train"), rows.where("NOT is_train")


@once
def clusters(spark, sf_dir):
    """Standardized rows, written, the k-means centers and the assigned rows."""
    star = warehouse.star(spark, sf_dir)
    # the moments need no item, only that there is one
    values = star.join(known=["item"]).select(*[F.col(c).cast("double").alias(c) for c in cluster.COLUMNS])
    scaled = written(cluster.standardize(cluster.extract(star), values=values), "standardized")
    model = cluster.fit(scaled)
    # the labels follow from the written rows and a few centers, so they are not written again
    return SimpleNamespace(scaled=scaled, model=model, assigned=cluster.assign(scaled, model))


@once
def elbow(spark, sf_dir):
    """Inertia by number of clusters, a row for each."""
    return cluster.elbow(clusters(spark, sf_dir).scaled)


@once
def anomalies(spark, sf_dir):
    """Rows with isolation scores and the flagged rows."""
    star = warehouse.star(spark, sf_dir)
    # the trees need no dimension, only that it has a member
    trees = anomaly.fit(star.join(known=["item", "center", "date"]).select(
        "fact_id", *[F.col(c).cast("double").alias(c) for c in anomaly.COLUMNS]))
    scored = written(anomaly.score(anomaly.extract(star), trees), "scored")
    flagged, threshold = anomaly.flag(scored)
    return SimpleNamespace(scored=scored, flagged=flagged, threshold=threshold)


@once
def pct_outliers(spark, sf_dir):
    """Rows flagged by a rule instead of a model: the top 2 % of waste percentages."""
    star = warehouse.star(spark, sf_dir)
    values = star.join(known=["item", "center", "date"]).select("waste_percentage")
    return anomaly.flag(anomaly.extract(star), "waste_percentage", values=values)[0]


@once
def appended(spark, sf_dir):
    """The star with the feed appended; its kept totals are those of the load and of the batch."""
    star, path = warehouse.star(spark, sf_dir), scratch_dir(spark, "increments")
    ingest.append(spark, star, extracts.feed(spark, sf_dir), path, 0, "event_id")
    return ingest.with_increments(spark, star, path)


def landed(spark, sf_dir):
    """The events as several arrived files, earliest first, and their schema."""
    events = extracts.table(spark, sf_dir, "events")
    path = scratch_dir(spark, "landing")
    events.repartitionByRange(4, "ts").write.parquet(path)
    return path, events.schema


@once
def streamed_windows(spark, sf_dir):
    """Closed weeks of the events with their warnings, from one run of the stream."""
    star = warehouse.star(spark, sf_dir)
    landing, schema = landed(spark, sf_dir)
    path = scratch_dir(spark, "windows")
    feed = extracts.as_feed(files.read_stream(spark, landing, schema))
    files.run_windows(spark, files.window_measures(feed, star, "event_id"), path, scratch_dir(spark, "checkpoint"))
    return spark.read.parquet(path)
