"""Models and mining on planted data, and samples that do not depend on partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from larder.functions import ranks
from larder.operators.mining import anomaly, classify, cluster, features, regress, rules

# The basket patterns with known rules
PATTERNS = [
    ["Creamy Chicken Alfredo Pasta", "Garlic Butter Naan Basket", "Cold Brew Iced Coffee"],
    ["Penne Arrabiata Bowl", "Artisan Woodfired Pizza", "Italian Espresso Tonic"],
    ["Artisan Woodfired Pizza", "Garlic Butter Naan Basket", "Cold Brew Iced Coffee"],
    ["Margherita Basil Pizza", "Italian Espresso Tonic", "Tiramisu Espresso Cup"],
    ["Creamy Chicken Alfredo Pasta", "Greek Feta Olive Salad", "Italian Espresso Tonic"],
    ["Penne Arrabiata Bowl", "Garlic Butter Naan Basket", "Tiramisu Espresso Cup"],
    ["Spicy Pepperoni Pizza", "Garlic Butter Naan Basket", "Sparkling Ginger Ale"],
    ["Hyderabadi Dum Biryani", "Masala Chai Deluxe", "Gulab Jamun Trio"],
    ["Hyderabadi Dum Biryani", "Paneer Tikka Rice Bowl", "Mango Lassi Fusion"],
    ["Paneer Tikka Rice Bowl", "Garlic Butter Naan Basket", "Masala Chai Deluxe"],
    ["Kashmiri Mutton Biryani", "Masala Chai Deluxe", "Gulab Jamun Trio"],
    ["Lucknowi Veg Biryani", "Mango Lassi Fusion", "Gulab Jamun Trio"],
    ["Hyderabadi Dum Biryani", "Classic Veg Hakka Noodles", "Mango Lassi Fusion"],
    ["Thai Green Curry Bowl", "Steamed Jasmine Rice", "Thai Jasmine Iced Tea"],
    ["Pad Thai Wok Rice", "Crispy Spring Rolls", "Thai Jasmine Iced Tea"],
    ["Thai Green Curry Bowl", "Crispy Spring Rolls", "Thai Coconut Smoothie"],
    ["Pad Thai Wok Rice", "Tom Yum Prawn Soup", "Thai Jasmine Iced Tea"],
    ["Steamed Jasmine Rice", "Szechuan Spiced Fish", "Thai Coconut Smoothie"],
    ["Tom Yum Prawn Soup", "Crispy Spring Rolls", "Lemongrass Cooler"],
    ["Herb Roast Chicken Sub", "Crispy Herb Wedges", "Cold Brew Iced Coffee"],
    ["Grilled Paneer Sandwich", "Farm Fresh Green Bowl", "Cold Brew Iced Coffee"],
    ["Smoked Chicken Quesadilla", "Crispy Herb Wedges", "Berry Infusion Soda"],
    ["Gourmet Salad Niçoise", "Cream of Wild Mushroom", "Spiced Mint Lemonade"],
    ["Herb Roast Chicken Sub", "Cream of Wild Mushroom", "Berry Infusion Soda"],
    ["Butter Glazed Tiger Prawns", "Gourmet Salad Niçoise", "Italian Espresso Tonic"],
]


@pytest.fixture(scope="module")
def baskets(spark):
    lines = [(i, item) for i, pattern in enumerate(PATTERNS) for item in [*pattern, pattern[0]]]
    return spark.createDataFrame(lines, "basket_id BIGINT, item STRING")


def test_known_rules(baskets):
    assert rules.item_support(baskets).count() == 24
    assert rules.pair_support(baskets).count() == 4
    found = rules.top(rules.rules(baskets)).collect()
    assert [(r.antecedent, r.consequent, r.confidence, r.lift) for r in found[:2]] == [
        ("Pad Thai Wok Rice", "Thai Jasmine Iced Tea", 1.0, 8.33),
        ("Thai Jasmine Iced Tea", "Pad Thai Wok Rice", 0.667, 8.33)]
    assert len(found) == 6 and {r.lift for r in found} == {8.33, 5.56}
    assert found[0].conviction == 99.0 and {r.support for r in found} == {0.08}
    assert "67% simultaneously" in found[1].waste_mitigation_strategy


def test_one_huge_basket(spark, baskets):
    # one basket with as many lines as all others, of many items that are nowhere else
    huge = spark.range(5000).select(F.lit(999).cast("bigint").alias("basket_id"),
                                    F.format_string("rare %d", "id").alias("item"))
    got = rules.pair_support(baskets.unionByName(huge), 0.07)
    assert rows(got, "item_a", "item_b", "basket_count") == rows(
        rules.pair_support(baskets, 0.08), "item_a", "item_b", "basket_count")


def test_exact_order_statistics(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), [1e9, -1e9]])
    df = spark.createDataFrame([(float(v), "a" if i % 3 else "b") for i, v in enumerate(values)],
                               "v DOUBLE, g STRING")
    for q in (0.0, 0.02, 0.5, 0.98, 1.0):
        assert ranks.quantile(df, "v", q) == pytest.approx(
            np.quantile(values, q), abs=1e-12)
    by = {"a": np.sort(values[np.arange(len(values)) % 3 != 0]), "b": np.sort(values[::3])}
    assert ranks.kth_smallest(df, "v", {"a": 100, "b": 900}, "g") == {
        "a": by["a"][99], "b": by["b"][899]}


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, "x").otherwise("y")
                                  .alias("label"))
    first = features.split(df.repartition(1), "id", "label")
    again = features.split(df.repartition(16), "id", "label")
    assert rows(first) == rows(again)
    assert rows(first.where("is_train").groupBy("label").count()) == [("x", 75), ("y", 676)]
    assert features.split(df, "id").where("is_train").count() == 752
    sample = rows(features.hash_sample(df.repartition(1), "id", 50))
    assert sample == rows(features.hash_sample(df.repartition(16), "id", 50))
    assert len(sample) == 50


@pytest.fixture(scope="module")
def demand(spark):
    """Demand that the features decide, up to little noise."""
    rng = np.random.default_rng(3)
    categories, cuisines = ["Fish", "Soup", "Pizza"], ["Thai", "Indian"]
    data = []
    for i in range(1500):
        price, base = rng.uniform(80, 400), rng.uniform(200, 420)
        promo, area = int(rng.random() < .3), float(rng.uniform(1, 7))
        category = categories[i % 3]
        sold = 450 - price + 120 * promo + 20 * area + 40 * (i % 3) + rng.normal(0, 5)
        data.append((i, price, base, max(0.0, base - price), 0.0, float(promo), 0.0, area,
                     f"TYPE_{'ABC'[i % 3]}", category, cuisines[i % 2], int(max(sold, 1))))
    df = spark.createDataFrame(data, "fact_id BIGINT, checkout_price DOUBLE, base_price DOUBLE, "
                               "discount_amount DOUBLE, discount_percent DOUBLE, "
                               "emailer_for_promotion DOUBLE, homepage_featured DOUBLE, "
                               "op_area DOUBLE, center_type STRING, category STRING, "
                               "cuisine STRING, sold_qty BIGINT")
    from larder.functions import measures
    return df.withColumn("demand_tier", measures.demand_tier(F.col("sold_qty"))).persist()


def test_codes(spark, demand):
    codes = features.fit_codes(demand)
    unknown = demand.limit(1).withColumn("category", F.lit("New"))
    assert features.encode(unknown, codes).first()["category_code"] == 0.0
    by_name = {r.category: r.category_code for r in features.encode(demand, codes).collect()}
    assert by_name == {"Fish": 0.0, "Pizza": 1.0, "Soup": 2.0}


def test_classifier_learns(spark, demand):
    codes = features.fit_codes(demand)
    data = features.assemble(features.encode(classify.with_label(demand), codes))
    marked = features.split(data, "fact_id", "demand_tier")
    model = classify.fit_forest(marked.where("is_train"), trees=20, depth=6)
    tested = model.transform(marked.where("NOT is_train")).withColumn(
        "predicted_tier", classify.predicted_tier())
    counts = classify.confusion(tested)
    assert counts.count() == 9
    got = classify.metrics(counts).first()
    assert got["accuracy"] > 85 and got["test_records"] == marked.where("NOT is_train").count()
    totals = {(r.actual, r.predicted): r.n for r in classify.confusion_with_totals(counts).collect()}
    assert len(totals) == 16 and totals["TOTAL", "TOTAL"] == got["test_records"]
    importance = classify.feature_importance(spark, model).collect()
    assert importance[0]["feature"] == "checkout_price"
    assert sum(r.importance for r in importance) == pytest.approx(100, abs=0.1)
    scored = classify.score(spark.range(1).withColumn("checkout_price", F.lit(90.0)), codes, model)
    row = scored.first()
    assert row["predicted_demand_tier"] == "HIGH" and row["discount_percentage"] == 70.0
    assert sum(row[f"probability_{t}"] for t in ("LOW", "MEDIUM", "HIGH")) == pytest.approx(
        100, abs=0.2)


def test_metrics_without_predictions_of_a_label(spark):
    df = spark.createDataFrame([("LOW", "LOW"), ("HIGH", "LOW")],
                               "demand_tier STRING, predicted_tier STRING")
    row = classify.metrics(classify.confusion(df)).first()
    assert (row["accuracy"], row["precision"], row["recall"]) == (50.0, 25.0, 50.0)


def test_regression_beats_the_mean(spark, demand):
    codes = features.fit_codes(demand)
    data = features.assemble(features.encode(demand, codes))
    marked = features.split(data, "fact_id")
    model = regress.fit_forest(marked.where("is_train"), trees=20, depth=8)
    got = regress.metrics(model.transform(marked.where("NOT is_train"))).first()
    assert got["r2_score"] > 0.8
    out = regress.forecast(spark.range(1).withColumn("category", F.lit("Fish")), codes, model).first()
    assert out["recommended_safety_buffer_pct"] == 8.0
    assert out["recommended_preparation_qty"] > out["forecasted_demand"]
    assert regress.actual_vs_predicted(model.transform(marked)).count() == 25


def test_ridge_is_the_closed_form(demand):
    columns = ["checkout_price", "base_price", "op_area"]
    weights, intercept = regress.fit_ridge(demand, columns=columns)
    pdf = demand.toPandas()
    x, y = pdf[columns].to_numpy(), pdf["sold_qty"].to_numpy(float)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert [weights[c] for c in columns] == pytest.approx(list(want), rel=1e-9)
    assert intercept == pytest.approx(y.mean() - want @ x.mean(0), rel=1e-9)


def test_prep_sizing_floor_and_buffers(spark):
    df = spark.createDataFrame([(3, "Fish"), (100, "Pizza")], "d BIGINT, category STRING")
    df = df.withColumns({"base_price": F.lit(10.0), "checkout_price": F.lit(8.0)})
    assert rows(regress.prep_sizing(df, "d"), "forecasted_demand", "recommended_preparation_qty",
                "estimated_waste_cost", "projected_revenue") == [
        (10, 11, 10.0, 80.0), (100, 112, 120.0, 800.0)]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centers = [(400, 30, 8, 300, 2), (50, 20, 25, 250, 5), (200, 20, 10, 150, 30),
               (60, 5, 6, 800, 1)]
    data = []
    for i in range(800):
        point = rng.normal(centers[i % 4], 1.0)
        data.append((i, i % 4, *map(float, point), f"item {i}", ["Fish", "Soup"][i % 2], "Thai"))
    return spark.createDataFrame(
        data, "fact_id BIGINT, truth INT, sold_qty DOUBLE, waste_qty DOUBLE, "
        "waste_percentage DOUBLE, checkout_price DOUBLE, discount_percent DOUBLE, "
        "item_name STRING, category STRING, cuisine STRING").persist()


def test_planted_clusters(blobs):
    scaled = cluster.standardize(blobs)
    moments = scaled.agg(F.avg("z_sold_qty"), F.stddev_pop("z_sold_qty")).first()
    assert tuple(moments) == pytest.approx((0, 1), abs=1e-9)
    model = cluster.fit(scaled, starts=4)
    assigned = cluster.assign(scaled, model)
    pairs = rows(assigned.groupBy("truth", "cluster").count())
    assert len(pairs) == 4 and {n for _, _, n in pairs} == {200}
    # the clusters are numbered by mean sold quantity
    assert {t: c for t, c, _ in pairs} == {0: 0, 2: 1, 3: 2, 1: 3}
    scores = cluster.silhouette(assigned, 500).first()
    assert scores["silhouette"] > 0.9 and scores["silhouette_sample"] > 0.8
    assert cluster.silhouette(assigned).first()["records"] == 800
    assert cluster.davies_bouldin(assigned).first()[0] < 0.2
    assert cluster.scatter(assigned, 50).count() == 50 and cluster.scatter(assigned).count() == 800
    inertia = [r.inertia for r in cluster.elbow(scaled, [2, 4]).orderBy("k").collect()]
    assert inertia[0] > 10 * inertia[1]
    strategies = {r.cluster: r.operational_strategy for r in cluster.strategy(assigned).collect()}
    assert strategies[0].startswith("Staple") and strategies[3].startswith("High spoilage")
    assert strategies[1].startswith("Price-elastic") and strategies[2].startswith("Premium")


def test_silhouette_against_the_definition(spark):
    points = [(0, 0.0), (0, 1.0), (1, 10.0), (1, 12.0), (2, 30.0)]
    df = spark.createDataFrame(points, "cluster INT, x DOUBLE")
    got = sorted(r[0] for r in cluster.sample_silhouette(df, ["x"]).collect())
    want = []
    for i, (c, x) in enumerate(points):
        own = [abs(x - y) for j, (d, y) in enumerate(points) if d == c and j != i]
        others = {}
        for d, y in points:
            if d != c:
                others.setdefault(d, []).append(abs(x - y))
        near = min(map(np.mean, others.values()))
        want.append((near - np.mean(own)) / max(near, np.mean(own)) if own else 0.0)
    assert got == pytest.approx(sorted(want), abs=1e-9)


def test_planted_outliers(spark):
    rng = np.random.default_rng(7)
    data = []
    for i in range(1020):
        factor = 10 if i >= 1000 else 1
        waste = float(rng.normal(30, 4)) * factor
        data.append((i, waste, float(rng.normal(10, 1)) * (4 if i >= 1000 else 1), waste * 20.0,
                     float(rng.normal(5, 1))))
    df = spark.createDataFrame(data, "fact_id BIGINT, waste_qty DOUBLE, waste_percentage DOUBLE, "
                               "waste_cost DOUBLE, discount_percent DOUBLE")
    nodes = anomaly.fit(df)
    assert nodes["tree"].nunique() == anomaly.TREES
    assert nodes.groupby("tree").size().max() <= 2 * anomaly.SAMPLE - 1
    again = anomaly.fit(df.repartition(16))
    scored = anomaly.score(df, nodes).persist()
    assert rows(scored) == rows(anomaly.score(df, again))
    flagged, threshold = anomaly.flag(scored)
    found = [r[0] for r in flagged.where("is_anomaly").select("fact_id").collect()]
    assert len(found) == 21 and set(range(1000, 1020)) <= set(found)
    got = anomaly.summary(flagged, threshold).first()
    assert (got["anomalies_detected"], got["anomaly_rate_pct"]) == (21, 2.06)


def test_diagnosis_order(spark):
    df = spark.createDataFrame(
        [(1, 0, 18.5, "Fish", 10, 5), (0, 0, 20.5, "Fish", 10, 5), (0, 0, 20.5, "Soup", 2001, 1199),
         (0, 0, 20.5, "Soup", 10, 5)],
        "emailer_for_promotion INT, homepage_featured INT, waste_percentage DOUBLE, "
        "category STRING, prepared_qty BIGINT, sold_qty BIGINT")
    assert [r[0].split(":")[0] for r in df.select(anomaly.diagnosis()).collect()] == [
        "Failed Promotional Surge", "Perishability Expiry", "Forecasting Buffer Overshoot",
        "Abnormal Demand Collapse"]


def test_itemsets_of_four_and_their_rules(spark):
    """A planted set of four, against counting every subset."""
    from itertools import combinations

    rng = np.random.default_rng(7)
    lists = [["a", "b", "c", "d"]] * 30 + [list(rng.choice(list("abcdefgh"), rng.integers(1, 5), replace=False)) for _ in range(120)]
    lists += [["x"], ["x"]]
    lines = [(k, str(i)) for k, items in enumerate(lists) for i in [*items, items[0]]]
    baskets = spark.createDataFrame([*lines, (500, None)], "basket_id INT, item STRING")
    n = len(lists) + 1
    counts = {}
    for items in lists:
        for size in range(1, len(items) + 1):
            for c in combinations(sorted(set(map(str, items))), size):
                counts[c] = counts.get(c, 0) + 1
    want = {c: k for c, k in counts.items() if k / n >= 0.05}
    model, total = rules.grown(baskets, 0.05, 0.5)
    assert total == n
    got = {tuple(r["items"]): r.basket_count for r in rules.itemsets(model, total).collect()}
    assert got == want and ("a", "b", "c", "d") in got
    found = {(tuple(r.antecedent), r.consequent): round(r.confidence, 9) for r in rules.set_rules(model, total, 0.0).collect()}
    assert found == {(tuple(x for x in c if x != y), y): round(k / want[tuple(x for x in c if x != y)], 9)
                     for c, k in want.items() if len(c) > 1 for y in c if k / want[tuple(x for x in c if x != y)] >= 0.5}
    assert rules.itemsets(*rules.grown(baskets.where("false"), 0.05)).collect() == []
