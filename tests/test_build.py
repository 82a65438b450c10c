"""Measures, dimensions, numbering, loading."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from larder.functions import exact, measures
from larder.operators import dimensions, fact
from larder.plans.queries import QUERIES
from larder.sources import audit, catalog, extracts, warehouse


def test_tier_edges(spark):
    df = spark.createDataFrame([(8.0, 100), (16.0, 350), (7.99, 99), (16.01, 351)],
                               "pct DOUBLE, sold BIGINT")
    assert [tuple(r) for r in df.select(
        measures.waste_risk_tier(F.col("pct")), measures.demand_tier(F.col("sold"))).collect()
    ] == [("MEDIUM", "MEDIUM"), ("MEDIUM", "MEDIUM"), ("LOW", "LOW"), ("HIGH", "HIGH")]


def test_prep_model(spark):
    df = spark.createDataFrame(
        [("Fish", False, 2016), ("Fish", True, 2016), (None, False, 2016), ("Beverages", False, 0),
         ("Fish", True, 4032)], "category STRING, promo BOOLEAN, total BIGINT")
    got = [r[0] for r in df.select(measures.prepared_qty(
        F.lit(1000), F.col("category"), F.col("promo"), F.col("total"))).collect()]
    # rate, rate + promotion, default rate, clipped below, clipped above
    assert got == [1210, 1245, 1120, 1030, 1332]


def test_half_even_preparation(spark):
    row = spark.range(1).select(F.rint(F.lit(2.5)), F.rint(F.lit(3.5))).first()
    assert tuple(row) == (2.0, 4.0)


def test_exact_rounding(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (0, 0), (1, 3)], "n BIGINT, d BIGINT")
    got = [tuple(r) for r in df.select(
        exact.ratio(F.col("n"), F.col("d"), 2), exact.ratio_pct(F.col("n"), F.col("d"), 0)
    ).collect()]
    assert got == [(0.13, 13.0), (-0.13, -13.0), (None, None), (0.33, 33.0)]
    means = spark.createDataFrame([(12.34,), (12.35,)], "x DOUBLE").agg(
        exact.mean(F.col("x")), exact.mean(F.col("x"), 1)).first()
    assert tuple(means) == (12.35, 12.3)


def test_zero_prepared_has_no_waste_percentage(spark):
    df = spark.createDataFrame([(0, 0)], "waste BIGINT, prepared BIGINT")
    assert df.select(measures.waste_percentage(F.col("waste"), F.col("prepared"))).first()[0] == 0


def test_categories_in_order_of_appearance(star):
    assert rows(star.category) == [
        (1, "Curry", "Mains", "Moderate"), (2, "Fish", "Mains", "High"),
        (3, "Beverages", "Beverages", "Low"), (4, "Soup", "Starters & Sides", "Moderate"),
    ]


def test_items(star):
    assert rows(star.item, "meal_id", "item_name", "perishability_tier", "shelf_life_days") == [
        (1230, "Szechuan Spiced Fish", "High", 1), (1885, "Thai Jasmine Iced Tea", "Low", 30),
        (2664, "Cream of Wild Mushroom", "High", 2), (77, "Indian Curry #77", "Low", 30)]


def test_centers(star):
    assert rows(star.center, "center_id", "center_name", "capacity_tier") == [
        (13, "Mega Center #13 (City 590)", "Mega Distribution Hub"),
        (20, "Urban Center #20 (City 522)", "Urban Central Kitchen"),
        (55, "Express Center #55 (City 647)", "Express Fulfillment Depot")]


def test_base_calendar(star):
    days = rows(star.date)
    assert len(days) == 26
    assert days[0] == (202401, 1, datetime.date(2024, 1, 1), "January", 1, "Q1", 2024, 0, "Winter")
    assert days[25] == (202426, 26, datetime.date(2024, 6, 24), "June", 6, "Q2", 2024, 1, "Summer")


@pytest.mark.parametrize("partitions", [1, 16])
def test_numbering_is_dense_and_ordered(spark, partitions):
    # a third of the rows are copies of one row
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")))
                                  .alias("k"), "id").repartition(partitions)
    got = fact.surrogate_key(spark, df, ["k", "id"], start=10, partitions=7).orderBy(
        "fact_id")
    numbered = got.collect()
    assert [r.fact_id for r in numbered] == list(range(11, 3011))
    assert [(r.k, r.id) for r in numbered] == sorted((r.k, r.id) for r in numbered)


def test_bounded_scan(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), "id")
    got = [tuple(r) for r in extracts.bounded_scan(df, ["a", "id"], 150).collect()]
    assert got == sorted((i % 10, i) for i in range(1000))[:150]
    assert extracts.bounded_scan(df, ["a"], None).count() == 1000


def test_the_scan_reads_all_lines_in_order(spark):
    lines = extracts.table(spark, "/root/testdata/sf0.01", "lineitem")
    got = [tuple(r) for r in QUERIES["scan_bounded"](spark, "/root/testdata/sf0.01").collect()]
    want = lines.toPandas().sort_values(extracts.LINE_KEYS)[extracts.LINE_KEYS[:6]]
    assert len(got) == lines.count() > 50_000
    assert got == list(want.itertuples(index=False, name=None))


def test_csv_refresh_and_export(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "id,week,center_id,meal_id,checkout_price,base_price,emailer_for_promotion,"
        "homepage_featured,num_orders\n"
        "9,1,55,1885,136.83,152.29,0,0,177\n7,2,55,1885,140.00,130.00,1,0,270\n"
        "8,2,55,4242,10.00,12.50,0,0,15\n5,27,55,1885,10.00,12.50,0,0,15\n")
    meals = spark.createDataFrame([(1885, "Beverages", "Thai")],
                                  "meal_id BIGINT, category STRING, cuisine STRING")
    centers = spark.createDataFrame(
        [(55, 647, 56, "TYPE_C", 2.0)],
        "center_id BIGINT, city_code INT, region_code INT, center_type STRING, op_area DOUBLE")
    from larder.sources import schemas
    orders = extracts.read_csv(spark, str(tmp_path / "orders.csv"), schemas.RAW_ORDERS)
    path = str(tmp_path / "warehouse")
    summary = warehouse.refresh(spark, path, meals, centers, orders).first()
    assert (summary["records_loaded"], summary["date_rows"]) == (4, 26)
    loaded = warehouse.read(spark, path)
    # an unknown meal and a week beyond the calendar stay in the fact, but leave the joins
    assert rows(loaded.fact, "fact_id", "original_record_id", "meal_id") == [
        (1, 5, 1885), (2, 7, 1885), (3, 8, 4242), (4, 9, 1885)]
    assert loaded.complete == {"center", "category"}
    assert rows(loaded.join("center", known=["item", "date"]), "fact_id") == [(2,), (4,)]
    # a price above the base price is no discount
    assert rows(loaded.fact.where("fact_id = 2"), "discount_percent") == [(0.0,)]
    assert {r.step_name for r in audit.recent(spark, f"{path}/audit_log").collect()} == {
        "EXTRACT", "TRANSFORM", "LOAD"}
    warehouse.refresh(spark, path, meals, centers, orders.limit(1))
    assert warehouse.read(spark, path).fact.count() == 1  # a refresh replaces
    warehouse.export_csv(loaded.item, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).columns == loaded.item.columns


def test_catalog(spark, tmp_path):
    spark.range(7).selectExpr("id", "id * 2 AS b").write.parquet(str(tmp_path / "data"))
    df = spark.read.parquet(str(tmp_path / "data"))
    base = catalog.register(None, [
        catalog.entry(df, "upload", with_size=True),
        catalog.entry(df, "baseline", source_type="EXTERNAL_BENCHMARK", deletable=False)])
    target = catalog.save(base, str(tmp_path / "catalog"), 1)
    stored = catalog.load(spark, target)
    assert rows(stored, "name", "record_count", "column_list") == [
        ("baseline", 7, ["id", "b"]), ("upload", 7, ["id", "b"])]
    assert stored.where("name = 'upload'").first()["file_size_kb"] > 0
    assert [r.name for r in catalog.listing(stored).collect()] == ["baseline", "upload"]
    more = catalog.register(stored, [catalog.entry(df, "third")])
    assert rows(more, "dataset_id") == [(1,), (2,), (3,)]
    assert rows(catalog.remove(more, 1), "dataset_id") == [(2,), (3,)]
    with pytest.raises(ValueError, match="cannot be deleted"):
        catalog.remove(more, 2)
    with pytest.raises(ValueError, match="not found"):
        catalog.remove(more, 9)


def test_status_of_an_empty_warehouse(star):
    from dataclasses import replace
    empty = replace(star, fact=star.fact.limit(0))
    assert audit.status(empty).first()["warehouse_status"] == "EMPTY"
    assert dimensions.build_date(star.fact.sparkSession, "2024-07-01", 3).count() == 3
