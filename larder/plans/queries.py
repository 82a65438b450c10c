"""Every operator as a named query over one folder of test tables."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from larder.functions import exact
from larder.operators import dimensions, fact, ingest, insights, kpi, olap, periods, reports
from larder.operators.mining import anomaly, classify, cluster, features, regress, rules
from larder.plans import artifacts
from larder.session import configure, scratch_dir
from larder.sources import audit, catalog, extracts, feeds, sqltext, warehouse
from larder.streaming import files

TYPE_RULES = {"min_support": 0.2, "min_confidence": 0.3, "min_lift": 0.0}
PIVOTS = {
    "olap_pivot_cost": ("category", "center_type", "waste_cost"),
    "olap_pivot_waste_qty": ("cuisine", "quarter", "waste_qty"),
    "olap_pivot_sold_qty": ("category", "quarter", "sold_qty"),
    "olap_pivot_revenue": ("cuisine", "center_type", "revenue"),
    "olap_pivot_waste_pct": ("category", "center_type", "waste_percentage"),
}
SLICES = {"cuisine": "Thai", "category": "Biryani", "center_type": "TYPE_A", "quarter": "Q1",
          "season": "Winter", "month_name": "March"}


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name) for f in df.schema])


def on_star(query):
    """A query on the loaded star."""
    return lambda spark, sf_dir: query(warehouse.star(configure(spark), sf_dir))


def on_artifact(make, query):
    """A query on a shared fitted model or table."""
    return lambda spark, sf_dir: query(make(configure(spark), sf_dir))


# --- sources, sinks and the warehouse build ------------------------------------------------------

def scan_bounded(spark, sf_dir):
    lines = extracts.table(spark, sf_dir, "lineitem")
    return extracts.bounded_scan(lines, extracts.LINE_KEYS, None).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")


def dim_category(spark, sf_dir):
    return dimensions.build_category(extracts.meals(spark, sf_dir))


def dim_food_item(spark, sf_dir):
    return dimensions.build_food_item(extracts.meals(spark, sf_dir))


def dim_center(spark, sf_dir):
    return dimensions.build_center(extracts.centers(spark, sf_dir))


def dim_date(spark, sf_dir):
    return dimensions.build_date_between(extracts.table(spark, sf_dir, "lineitem"), "l_shipdate")


def _fact(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    return fact.build_fact(extracts.orders(spark, sf_dir), star.item, star.category)


def fact_build(spark, sf_dir):
    return doubles(_fact(spark, sf_dir))


def fact_tiers(spark, sf_dir):
    return _fact(spark, sf_dir).groupBy("waste_risk_tier", "demand_tier").agg(
        F.count(F.lit(1)).alias("record_count"))


def surrogate_key(spark, sf_dir):
    numbered = fact.surrogate_key(
        configure(spark), extracts.lines(spark, sf_dir), extracts.LOAD_ORDER)
    return numbered.select("fact_id", *extracts.LINE_KEYS)


def fact_load(spark, sf_dir):
    path = scratch_dir(spark, "refresh")
    warehouse.load_test_tables(spark, sf_dir, path)
    return warehouse.read(spark, path).fact.groupBy("fact_year").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("fact_id").alias("first_fact_id"),
        F.max("fact_id").alias("last_fact_id"),
        F.sum("prepared_qty").alias("total_prepared"),
        exact.money(F.col("profit_loss")).alias("total_profit_loss"),
    )


def export_extract(spark, sf_dir):
    path = scratch_dir(spark, "export")
    rows = reports.extract(warehouse.star(configure(spark), sf_dir), 2000)
    warehouse.export_csv(rows, path)
    return doubles(spark.read.schema(rows.schema).csv(path, header=True))


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def dataset_profile(spark, sf_dir):
    return reduce(DataFrame.unionByName, [
        catalog.profile(extracts.table(spark, sf_dir, name), name) for name in TABLES
    ]).withColumn("column_list", F.array_join("column_list", ", "))


def catalog_list(spark, sf_dir):
    """Every table is registered; the events are an upload, the others baselines."""
    entries = [
        catalog.entry(extracts.table(spark, sf_dir, name), name,
                      source_type="USER_UPLOAD" if name == "events" else "EXTERNAL_BENCHMARK",
                      deletable=name == "events", with_size=True)
        for name in ["events", *[t for t in TABLES if t != "events"]]
    ]
    return catalog.listing(catalog.register(None, entries)).select(
        "dataset_id", "name", "source_type", "record_count",
        F.array_join("column_list", ", ").alias("column_list"), "column_count", "is_deletable")


# --- incremental ingest ---------------------------------------------------------------------------

def ingest_normalize(spark, sf_dir):
    rows = ingest.normalize(extracts.mixed_feed(spark, sf_dir), "event_id")
    return rows.select("row_key", "date", "week", "sold", "meal", "center")


def _resolved(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    feed = ingest.normalize(extracts.mixed_feed(spark, sf_dir), "event_id")
    return ingest.resolve_period(feed, star.date), star


def ingest_period(spark, sf_dir):
    return _resolved(spark, sf_dir)[0].select("row_key", "date_id", "period_source")


def dim_date_upsert(spark, sf_dir):
    resolved, star = _resolved(spark, sf_dir)
    return ingest.new_dates(resolved, star.date)


def ingest_fk_default(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    feed = ingest.normalize(extracts.feed(spark, sf_dir), "event_id")
    return ingest.resolve_keys(feed, star).select(
        "row_key", "meal_id", "center_id", "category_id", "meal_substituted",
        "center_substituted")


def ingest_measures(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    return doubles(ingest.fact_rows(extracts.feed(spark, sf_dir), star, "event_id"))


def ingest_append(spark, sf_dir):
    """Years with data after the feed was appended, with the counts the append reported."""
    star = warehouse.star(configure(spark), sf_dir)
    path = scratch_dir(spark, "increments")
    result = ingest.append(spark, star, extracts.feed(spark, sf_dir), path, 0, "event_id").first()
    reported = ["records_before", "records_added", "total_records", "centers_substituted",
                "last_record_id"]
    return periods.years(ingest.with_increments(spark, star, path)).withColumns(
        {name: F.lit(result[name]).cast("bigint") for name in reported})


AFTER_APPEND = {
    "olap_slice_cuisine": lambda s: olap.slice_(s, "cuisine", SLICES["cuisine"]),
    "olap_rollup_month": olap.rollup,
    "olap_rollup_category": lambda s: olap.rollup(s, "category"),
    "olap_rollup_hierarchy": olap.rollup_hierarchy,
    "olap_drilldown_category": lambda s: olap.drilldown(s, "category", "Biryani"),
    "olap_pivot_cost": lambda s: olap.pivot(s, *PIVOTS["olap_pivot_cost"]),
    "kpi_summary": kpi.summary,
    "chart_center_type": kpi.by_center_type,
    "chart_risk_tier": kpi.by_risk_tier,
    "period_bounds": periods.bounds,
    "period_compare_monthly_by_year": lambda s: periods.compare_monthly(s, by_year=True),
    "early_warning_daily": lambda s: periods.early_warning(periods.compare_daily(s)),
}


# --- mining ---------------------------------------------------------------------------------------

def feature_rows(star):
    return features.extract(star).drop("waste_qty")


def encode(spark, sf_dir):
    return artifacts.encoded(configure(spark), sf_dir).rows.select("fact_id", *features.CODES)


def split(spark, sf_dir):
    return artifacts.encoded(configure(spark), sf_dir).rows.groupBy(
        "demand_tier", "is_train").agg(F.count(F.lit(1)).alias("record_count"))


def ruled_tiers(star):
    """A fixed rule in the place of a model: promotions sell much, dear items little."""
    promo = (F.col("emailer_for_promotion") + F.col("homepage_featured")) > 0
    predicted = (F.when(promo, "HIGH").when(F.col("checkout_price") >= 930, "LOW")
                 .otherwise("MEDIUM"))
    return star.fact.select("demand_tier", predicted.alias("predicted_tier"))


def ruled_demand(star):
    """A fixed rule in the place of a regression."""
    promo = F.col("emailer_for_promotion") + F.col("homepage_featured")
    return star.fact.select("sold_qty", (F.lit(230) + promo * 40).alias("prediction"))


def rf_classify(made):
    return classify.metrics(classify.confusion(made.tested)).select(
        F.lit("random_forest").alias("model"),
        F.lit(made.train_records).cast("bigint").alias("train_records"), "*")


def dt_classify(made):
    return classify.metrics(classify.confusion(made.tested)).select(
        F.lit("decision_tree").alias("model"),
        F.lit(made.train_records).cast("bigint").alias("train_records"),
        "test_records", "accuracy")


def feature_importance(spark, sf_dir):
    """Of both forests."""
    configure(spark)
    made = {"classifier": artifacts.classifier(spark, sf_dir).forest,
            "regressor": artifacts.regressor(spark, sf_dir).forest}
    return reduce(DataFrame.unionByName, [
        classify.feature_importance(spark, model).withColumn("model", F.lit(name))
        for name, model in made.items()])


def _scenarios(star):
    """Every fact as a scenario; small kitchens do not state their size."""
    op_area = F.when(F.col("capacity_tier") != "Express Fulfillment Depot", F.col("op_area"))
    return star.join("item", "center").select(
        "fact_id", F.col("checkout_price").cast("double").alias("checkout_price"),
        F.col("base_price").cast("double").alias("base_price"), "emailer_for_promotion",
        "homepage_featured", op_area.alias("op_area"), "category", "cuisine", "center_type")


def score_tier(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    return classify.score(_scenarios(star), artifacts.encoded(spark, sf_dir).codes,
                          artifacts.classifier(spark, sf_dir).forest)


def forecast(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    return regress.forecast(_scenarios(star), artifacts.encoded(spark, sf_dir).codes,
                            artifacts.regressor(spark, sf_dir).forest)


def rf_regress(made):
    return regress.metrics(made.tested).select(
        F.lit("random_forest").alias("model"),
        F.lit(made.train_records).cast("bigint").alias("train_records"), "*")


def ridge(made):
    return regress.metrics(made.tested).select(
        F.lit("ridge").alias("model"), "r2_score")


def prep_sizing(star):
    """Sizing for the sold quantity of every fact."""
    rows = star.join("item").select("fact_id", "category", "base_price", "checkout_price",
                                    "sold_qty")
    return regress.prep_sizing(rows, "sold_qty").drop("category", "base_price", "checkout_price",
                                                      "sold_qty")


def standardize(spark, sf_dir):
    scaled = cluster.standardize(cluster.extract(warehouse.star(configure(spark), sf_dir)))
    return scaled.select("fact_id", *[F.round(c, 4).alias(c) for c in cluster.SCALED])


def kmeans(made):
    """Centers in standardized units, in the order of the clusters."""
    return made.assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("record_count"),
        *[F.round(F.avg(c), 4).alias(c) for c in cluster.SCALED],
    ).withColumn("inertia", F.lit(round(made.model.inertia, 1)))


def _ruled_clusters(star):
    """Fixed labels in the place of fitted ones: much or little sold, high or low waste."""
    label = F.when(F.col("sold_qty") > 300, 0).otherwise(2) + F.when(
        F.col("waste_percentage") >= 12, 1).otherwise(0)
    return cluster.extract(star).withColumn("cluster", label)


def davies_bouldin(spark, sf_dir):
    rows = _ruled_clusters(warehouse.star(configure(spark), sf_dir))
    return cluster.davies_bouldin(cluster.standardize(rows))


def pair_rules(spark, sf_dir):
    return rules.rules(extracts.baskets(spark, sf_dir), **TYPE_RULES)


def assoc_rules(spark, sf_dir):
    return rules.presented(pair_rules(spark, sf_dir))


def item_support(spark, sf_dir):
    """Of the part names, which are more than the types."""
    found = rules.item_support(extracts.baskets(spark, sf_dir, "p_name"), 0.05)
    return found.withColumn("support", F.round("support", 4))


def pair_support(spark, sf_dir):
    found = rules.pair_support(extracts.baskets(spark, sf_dir), 0.2)
    return found.withColumn("support", F.round("support", 4))


def _type_sets(spark, sf_dir):
    return rules.grown(extracts.baskets(spark, sf_dir), 0.02, 0.3)


def itemsets(spark, sf_dir):
    """Frequent sets of any size."""
    return rules.itemsets(*_type_sets(spark, sf_dir)).select(
        F.array_join("items", " + ").alias("itemset"), "size", "basket_count", F.round("support", 4).alias("support"))


def itemset_rules(spark, sf_dir):
    """Rules from two items or more."""
    return rules.set_rules(*_type_sets(spark, sf_dir), min_lift=0.0).where(F.size("antecedent") > 1).select(
        F.array_join("antecedent", " + ").alias("antecedent"), "consequent", F.round("support", 4).alias("support"),
        F.round("confidence", 4).alias("confidence"), F.round("lift", 3).alias("lift"))


def distinct_meals(star, period):
    """Merged daily sketches beside the exact numbers."""
    about = kpi.meals_by_period(star, kpi.meal_sketches(star), period)
    return kpi.exact_meals_by_period(star, period).join(about, [period, "center_type"]).select(
        period, "center_type", "meals", (F.abs(F.col("about_meals") - F.col("meals")) <= 0.02 * F.col("meals")).alias("within_2_pct"))


SOLD_BY_CUISINE = """SELECT cuisine, category, count(*) AS record_count, sum(sold_qty) AS total_sold
    FROM fact JOIN food_item USING (meal_id) WHERE cuisine = :cuisine AND sold_qty >= :least
    GROUP BY cuisine, category"""


def sql_rows(spark, sf_dir):
    """Text with named values."""
    star = warehouse.star(configure(spark), sf_dir)
    return sqltext.frame(spark, star, SOLD_BY_CUISINE, {"cuisine": "Thai", "least": 200})


def sql_scalar(spark, sf_dir):
    """A value with a quote and a comment in it is no part of the text."""
    star = warehouse.star(configure(spark), sf_dir)
    text = "SELECT count(*) FROM food_item WHERE item_name <> :name"
    found = sqltext.scalar(spark, star, text, {"name": "Chef's ' OR 1=1 -- special"})
    return spark.range(1).select(F.lit(found).cast("bigint").alias("other_items"))


def _cluster_cards(made):
    order = F.sort_array(F.collect_list(F.struct("rank", "category")))
    tops = cluster.top_categories(made.assigned).groupBy("cluster").agg(
        F.transform(order, lambda c: c["category"]).alias("top_categories"))
    return (cluster.profile(made.assigned).join(cluster.strategy(made.assigned), "cluster")
            .join(tops, "cluster"))


def insight_cards(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    return insights.cards(
        insights.high_waste_items(star), insights.peak_periods(star),
        rules.top(pair_rules(spark, sf_dir)),
        anomaly.top(artifacts.anomalies(spark, sf_dir).flagged),
        _cluster_cards(artifacts.clusters(spark, sf_dir)))


# --- what is exact about the fitted models --------------------------------------------------------

def classifier_checks(made):
    """Against guessing the tiers in proportion to the test rows: what that gets right on average."""
    sizes = made.tested.groupBy("demand_tier").count().agg(
        F.max("count").alias("most"), F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("squares"))
    right = F.col("accuracy") * F.col("test_records") / 100
    return classify.metrics(classify.confusion(made.tested)).join(sizes).select(
        "test_records", F.lit(made.train_records).cast("bigint").alias("train_records"),
        F.col("most").alias("majority_records"), F.expr("squares div all").alias("guessed_records"),
        (right >= F.col("squares") / F.col("all")).alias("better_than_guessing"))


def regressor_checks(made):
    """Against always forecasting the mean of the test rows."""
    return regress.metrics(made.tested).join(made.tested.agg(F.stddev_pop("sold_qty").alias("spread"))).select(
        "test_records", F.lit(made.train_records).cast("bigint").alias("train_records"),
        ((F.col("rmse") >= F.col("mae")) & (F.col("rmse") <= 1.01 * F.col("spread"))).alias("no_worse_than_the_mean"))


def ridge_checks(spark, sf_dir):
    """The weights solve the normal equations on the training rows: each column's product with the residuals is its penalty."""
    made, data = artifacts.ridge(configure(spark), sf_dir), artifacts.demand_rows(spark, sf_dir)
    weights, intercept = made.weights
    residual = F.col("sold_qty") - regress.ridge_prediction(weights, intercept)
    sums = data.train.agg(
        F.sum(residual).alias("r"), F.sum(F.abs(residual)).alias("scale"),
        *[F.sum(F.col(c) * residual).alias(c) for c in weights], *[F.sum(F.abs(F.col(c) * residual)).alias(f"abs_{c}") for c in weights])
    solved = F.abs("r") <= 1e-7 * F.col("scale")
    for c, w in weights.items():
        solved = solved & (F.abs(F.col(c) - regress.RIDGE_ALPHA * F.lit(w)) <= 1e-7 * F.col(f"abs_{c}"))
    return regressor_checks(made).join(sums.select(solved.alias("normal_equations_hold")))


def importance_checks(spark, sf_dir):
    return feature_importance(spark, sf_dir).groupBy("model").agg(
        F.count(F.lit(1)).alias("features"),
        F.round(F.sum("importance")).cast("bigint").alias("total_pct"))


def score_tier_discounts(spark, sf_dir):
    return score_tier(spark, sf_dir).select("fact_id", "discount_applied")


def forecast_buffers(spark, sf_dir):
    return forecast(spark, sf_dir).select(
        "fact_id", "recommended_safety_buffer_pct",
        (F.col("recommended_preparation_qty") >= F.col("forecasted_demand")).alias("covers_demand"))


def cluster_checks(spark, sf_dir):
    """Counts over the clusters; the model's inertia against that of the labels, and of one cluster; the elbow."""
    made = artifacts.clusters(configure(spark), sf_dir)
    curve = artifacts.elbow(spark, sf_dir).withColumn(
        "before", F.lag("inertia").over(Window.orderBy("k")))  # five rows
    means = made.assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[
        (F.var_pop(c) * F.count(F.lit(1))).alias(c) for c in cluster.SCALED])
    within = sum((F.col(c) for c in cluster.SCALED), F.lit(0.0))
    inertia = made.model.inertia
    return means.agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("clusters"),
        (F.abs(F.sum(within) - inertia) <= 0.01 * inertia).alias("labels_have_the_inertia"),
        # standardized rows have a total square of one a column
        (F.sum(within) < 0.8 * len(cluster.SCALED) * F.sum("n")).alias("clusters_are_closer")).join(
            curve.agg(F.bool_and(F.coalesce(F.col("inertia") <= F.col("before"), F.lit(True)))
                      .alias("inertia_falls")))


def pca_checks(made):
    return cluster.scatter(made.assigned).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("fact_id").alias("facts"))


def anomaly_checks(made):
    share = anomaly.CONTAMINATION
    return made.flagged.agg(
        F.count(F.lit(1)).alias("records"),
        (F.count_if("is_anomaly") <= F.ceil(F.count(F.lit(1)) * share)).alias("no_more_than_share"),
        F.bool_and(F.col("is_anomaly") == (F.col("decision_value") < 0)).alias("flags_follow_sign"))


# --- streaming ------------------------------------------------------------------------------------

def stream_ingest(spark, sf_dir):
    star = warehouse.star(configure(spark), sf_dir)
    landing, schema = artifacts.landed(spark, sf_dir)
    path, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "checkpoint")
    files.ingest_files(spark, star, files.read_stream(spark, landing, schema, 2),
                       extracts.as_feed, path, checkpoint, "event_id")
    return spark.read.parquet(f"{path}/fact").groupBy("date_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum("sold_qty").alias("total_sold"),
        F.sum("prepared_qty").alias("total_prepared"),
        F.sum("center_substituted").alias("centers_substituted"),
        exact.money(F.col("profit_loss")).alias("total_profit_loss"),
    )


def stream_feed_csv(spark, sf_dir):
    """The feed as CSV files under three headers, two files at a time."""
    star = warehouse.star(configure(spark), sf_dir)
    landing, path = scratch_dir(spark, "landing"), scratch_dir(spark, "stream")
    extracts.land_feed_files(spark, sf_dir, landing)
    files.ingest_files(spark, star, files.read_feed_stream(spark, landing, 2),
                       lambda lines: feeds.picked(lines, ["event_id"]), path, scratch_dir(spark, "checkpoint"), "event_id")
    return spark.read.parquet(f"{path}/fact").groupBy("date_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum("sold_qty").alias("total_sold"),
        F.sum("prepared_qty").alias("total_prepared"),
        F.sum("center_substituted").alias("centers_substituted"),
        exact.money(F.col("profit_loss")).alias("total_profit_loss"),
    )


def feed_files(spark, sf_dir):
    """Facts of the feed as CSV files under three headers."""
    star, landing = warehouse.star(configure(spark), sf_dir), scratch_dir(spark, "landing")
    extracts.land_feed_files(spark, sf_dir, landing)
    return doubles(ingest.fact_rows(feeds.read(spark, landing, ["event_id"]), star, "event_id"))


WARNING_COLUMNS = ["window_start", "food_wasted", "previous_food_wasted", "waste_change_pct", "change_display", "status"]


def stream_period_agg(spark, sf_dir):
    return artifacts.streamed_windows(spark, sf_dir).drop(*[c for c in WARNING_COLUMNS[2:]])


def stream_early_warning(spark, sf_dir):
    return artifacts.streamed_windows(spark, sf_dir).select(*WARNING_COLUMNS)


def stream_late_windows(spark, sf_dir):
    """Windows of the events as they come in no order of time: a row of any age counts."""
    star, landing = warehouse.star(configure(spark), sf_dir), scratch_dir(spark, "landing")
    events = extracts.table(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(landing)
    path = scratch_dir(spark, "windows")
    feed = extracts.as_feed(files.read_stream(spark, landing, events.schema, 1))
    files.run_late_windows(spark, files.window_measures(feed, star, "event_id", delay=None), path,
                           scratch_dir(spark, "checkpoint"))
    return files.latest_windows(spark, path).drop("versions")


def feed_dirty(spark, sf_dir):
    """The events with dates, weeks and numbers as people write them, resolved and set aside."""
    star = warehouse.star(spark, sf_dir)
    resolved = ingest.resolve_period(ingest.normalize(
        extracts.dirty_feed(spark, sf_dir), "event_id"), star.date)
    sold = ingest._whole(F.col("sold"))
    return resolved.select("row_key", "date_id", "period_source", sold.alias("sold_given"))


def feed_quarantined(spark, sf_dir):
    """Those of the dirty feed that an append sets aside, with its own count of them."""
    star = warehouse.star(spark, sf_dir)
    path = scratch_dir(spark, "increments")
    result = ingest.append(spark, star, extracts.dirty_feed(spark, sf_dir), path, 0, "event_id").first()
    return spark.read.parquet(f"{path}/quarantine").select(
        "row_key", "date", F.lit(result["records_quarantined"]).alias("records_quarantined"),
        F.lit(result["records_added"]).alias("records_added"))


# --- the list -------------------------------------------------------------------------------------

def configured(query):
    """The query with the session settings that its plan relies on, whichever ran before."""
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


QUERIES = {
    "scan_bounded": scan_bounded,
    "dim_category": dim_category,
    "dim_food_item": dim_food_item,
    "dim_center": dim_center,
    "dim_date": dim_date,
    "fact_build": fact_build,
    "fact_tiers": fact_tiers,
    "surrogate_key": surrogate_key,
    "fact_load": fact_load,
    "export_extract": export_extract,
    "dataset_profile": dataset_profile,
    "catalog_list": catalog_list,
    "warehouse_status": on_star(audit.status),

    "ingest_normalize": ingest_normalize,
    "ingest_period": ingest_period,
    "dim_date_upsert": dim_date_upsert,
    "ingest_fk_default": ingest_fk_default,
    "ingest_measures": ingest_measures,
    "ingest_append": ingest_append,
    **{f"{name}_after_append": on_artifact(artifacts.appended, query) for name, query in AFTER_APPEND.items()},
    "feed_dirty": feed_dirty,
    "feed_quarantined": feed_quarantined,

    **{f"olap_slice_{dim}": on_star(lambda s, dim=dim, value=value: olap.slice_(s, dim, value))
       for dim, value in SLICES.items()},
    "olap_dice": on_star(lambda s: olap.dice(s, cuisine="Indian", center_type="TYPE_B",
                                             quarter="Q2", waste_risk="HIGH")),
    "olap_dice_all": on_star(olap.dice),
    **{f"olap_rollup_{level}": on_star(lambda s, level=level: olap.rollup(s, level))
       for level in olap.ROLLUP_LEVELS},
    "olap_rollup_hierarchy": on_star(olap.rollup_hierarchy),
    "olap_drilldown_category": on_star(lambda s: olap.drilldown(s, "category", "Biryani")),
    "olap_drilldown_center": on_star(lambda s: olap.drilldown(s, "center_type", "TYPE_B")),
    **{name: on_star(lambda s, args=args: olap.pivot(s, *args)) for name, args in PIVOTS.items()},

    "kpi_summary": on_star(kpi.summary),
    "chart_monthly": on_star(kpi.monthly),
    "chart_top_wasted": on_star(kpi.top_wasted),
    "chart_cuisine": on_star(kpi.by_cuisine),
    "chart_center_type": on_star(kpi.by_center_type),
    "chart_risk_tier": on_star(kpi.by_risk_tier),
    "report_category_scorecard": on_star(reports.category_scorecard),
    "report_top_centers": on_star(reports.top_centers),
    "report_savings": on_star(reports.savings),
    "browse_page": on_star(lambda s: reports.browse(s, page=3, limit=20, search="fish")),
    "browse_after": on_star(lambda s: reports.browse(s, after=1000, limit=20)),
    "browse_count": on_star(lambda s: reports.browse_count(s, limit=20, search="fish")),
    "insight_high_waste": on_star(insights.high_waste_items),
    "insight_peak_periods": on_star(insights.peak_periods),

    "period_weeks": on_star(periods.weeks),
    "period_months": on_star(periods.months),
    "period_years": on_star(periods.years),
    "period_dates": on_star(periods.dates),
    "period_bounds": on_star(periods.bounds),
    "period_measures": on_star(lambda s: periods.measures(
        s, F.col("calendar_date").between("1997-01-01", "1997-06-30"))),
    "period_compare_daily": on_star(periods.compare_daily),
    "period_compare_weekly": on_star(periods.compare_weekly),
    "period_compare_weekly_by_year": on_star(lambda s: periods.compare_weekly(s, by_year=True)),
    "period_compare_monthly": on_star(periods.compare_monthly),
    "period_compare_monthly_by_year": on_star(lambda s: periods.compare_monthly(s, by_year=True)),
    "period_compare_yearly": on_star(periods.compare_yearly),
    "period_compare_custom": on_star(
        lambda s: periods.compare_custom(s, "1998-03-01", "1998-05-31")),
    "early_warning": on_star(
        lambda s: periods.early_warning(periods.compare_weekly(s, by_year=True))),
    "early_warning_daily": on_star(lambda s: periods.early_warning(periods.compare_daily(s))),
    "early_warning_monthly": on_star(
        lambda s: periods.early_warning(periods.compare_monthly(s, by_year=True))),
    "early_warning_yearly": on_star(lambda s: periods.early_warning(periods.compare_yearly(s))),
    "early_warning_custom": on_star(lambda s: periods.early_warning(
        periods.compare_custom(s, "1998-03-01", "1998-05-31"))),

    "item_support": item_support,
    "pair_support": pair_support,
    "assoc_rules": assoc_rules,
    "assoc_rules_top": lambda spark, sf_dir: rules.top(pair_rules(spark, sf_dir)),
    "itemsets": itemsets,
    "itemset_rules": itemset_rules,
    "distinct_meals_by_year": on_star(lambda s: distinct_meals(s, "year")),
    "distinct_meals_by_month": on_star(lambda s: distinct_meals(s, "month_name")),
    "sql_rows": sql_rows,
    "sql_scalar": sql_scalar,
    "features": on_star(feature_rows),
    "encode": encode,
    "split": split,
    "clf_metrics": on_star(lambda s: classify.metrics(classify.confusion(ruled_tiers(s)))),
    "confusion_matrix": on_star(
        lambda s: classify.confusion_with_totals(classify.confusion(ruled_tiers(s)))),
    "reg_metrics": on_star(lambda s: regress.metrics(ruled_demand(s))),
    "prep_sizing": on_star(prep_sizing),
    "standardize": standardize,
    "davies_bouldin": davies_bouldin,
    "cluster_profile": on_star(lambda s: cluster.profile(_ruled_clusters(s))),
    "cluster_top_categories": on_star(lambda s: cluster.top_categories(_ruled_clusters(s))),
    "cluster_strategy": on_star(lambda s: cluster.strategy(_ruled_clusters(s))),
    "anomaly_diagnosis": on_artifact(artifacts.pct_outliers, anomaly.top),

    "rf_classify": on_artifact(artifacts.classifier, rf_classify),
    "dt_classify": on_artifact(artifacts.benchmark_tree, dt_classify),
    "feature_importance": feature_importance,
    "score_tier": score_tier,
    "rf_regress": on_artifact(artifacts.regressor, rf_regress),
    "ridge": on_artifact(artifacts.ridge, ridge),
    "actual_vs_pred": on_artifact(artifacts.regressor,
                                  lambda made: regress.actual_vs_predicted(made.tested)),
    "forecast": forecast,
    "kmeans": on_artifact(artifacts.clusters, kmeans),
    "silhouette": on_artifact(artifacts.clusters, lambda made: cluster.silhouette(made.assigned)),
    "silhouette_euclidean": on_artifact(artifacts.clusters, lambda made: cluster.euclidean_silhouette(made.assigned)),
    "elbow": artifacts.elbow,
    "pca_2d": on_artifact(artifacts.clusters, lambda made: cluster.scatter(made.assigned)),
    "iforest_scores": on_artifact(
        artifacts.anomalies, lambda made: made.scored.select("fact_id", "anomaly_score")),
    "iforest_flags": on_artifact(
        artifacts.anomalies, lambda made: made.flagged.select("fact_id", "is_anomaly")),
    "anomaly_top": on_artifact(artifacts.anomalies, lambda made: anomaly.top(made.flagged)),
    "anomaly_summary": on_artifact(
        artifacts.anomalies, lambda made: anomaly.summary(made.flagged, made.threshold)),
    "insight_cards": insight_cards,
    "classifier_checks": on_artifact(artifacts.classifier, classifier_checks),
    "tree_checks": on_artifact(artifacts.benchmark_tree, classifier_checks),
    "regressor_checks": on_artifact(artifacts.regressor, regressor_checks),
    "ridge_checks": ridge_checks,
    "importance_checks": importance_checks,
    "score_tier_discounts": score_tier_discounts,
    "forecast_buffers": forecast_buffers,
    "cluster_checks": cluster_checks,
    "pca_checks": on_artifact(artifacts.clusters, pca_checks),
    "anomaly_checks": on_artifact(artifacts.anomalies, anomaly_checks),

    "stream_ingest": stream_ingest,
    "stream_period_agg": stream_period_agg,
    "stream_early_warning": stream_early_warning,
    "stream_late_windows": stream_late_windows,
    "stream_feed_csv": stream_feed_csv,
    "feed_files": feed_files,
}
QUERIES = {name: configured(query) for name, query in QUERIES.items()}
