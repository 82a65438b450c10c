"""Incremental feeds, batch and stream."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from larder.functions import fixed
from larder.operators import ingest, kpi, periods
from larder.sources import feeds
from larder.streaming import files

WEEK_28 = [(28, 55, 1885, 120), (28, 55, 1230, 95), (28, 55, 2664, 210), (28, 55, 1885, 80),
           (28, 55, 1230, 150)]


@pytest.fixture
def week_28(spark):
    return spark.createDataFrame(
        [tuple(map(str, (i, *r))) for i, r in enumerate(WEEK_28)],
        "id STRING, `Week` STRING, `Hub ID` STRING, `Dish ID` STRING, ` Num Orders ` STRING")


def feed(spark, **columns):
    """A one-row feed."""
    return spark.range(1).select(*[F.lit(v).cast("string").alias(c) for c, v in columns.items()])


def test_headers(spark):
    df = feed(spark, **{" Order Date ": "x", "SALES": "1"})
    assert ingest.normalize_headers(df).columns == ["order_date", "sales"]
    with pytest.raises(ValueError, match="collide"):
        ingest.normalize_headers(feed(spark, **{"a b": 1, "A_B": 2}))


def test_first_synonym_wins(spark):
    df = ingest.normalize(feed(spark, orders=3, num_orders=4, store_id=9, cost=1, price=2))
    row = df.first()
    assert (row.sold, row.center, row.base, row.price, row.meal) == ("4", "9", "1", "2", None)


def test_a_column_named_like_a_meaning_gives_way_to_the_first_synonym(spark):
    row = ingest.normalize(feed(spark, sold_qty=4, sold=3)).first()
    assert row.sold == "4"


@pytest.mark.parametrize("given, date_id, source", [
    ({"date": "2024-07-03"}, 20240703, "date"),
    ({"date": "2024-01-08"}, 202402, "date"),  # a day the calendar has keeps its id
    ({"date": "7/4/2024"}, 20240704, "date"),
    ({"date": "soon"}, None, "unparseable"),
    ({"date": None, "week": "5"}, 202405, "week"),
    ({"date": None, "week": "30.0"}, 202430, "week"),
    ({"sold": "1"}, 202427, "next"),
])
def test_period_chain(spark, star, given, date_id, source):
    row = ingest.resolve_period(ingest.normalize(feed(spark, **given)), star.date).first()
    assert (row.date_id, row.period_source) == (date_id, source)


def test_unreadable_dates_are_set_aside(spark, star):
    df = feed(spark, date="soon", sold=3).unionByName(feed(spark, date="2024-07-01", sold=4))
    assert rows(ingest.quarantined(df, star), "date", "sold") == [("soon", "3")]
    assert rows(ingest.fact_rows(df, star), "sold_qty") == [(4,)]


@pytest.mark.parametrize("meal, center, expected", [
    ("1230", "13", (1230, 13, 2, 0, 0)),
    ("1230.0", "999", (1230, 13, 2, 0, 1)),  # unknown center: smallest id
    ("999", None, (77, 13, 1, 1, 1)),  # unknown meal: smallest id, and its category
    ("x", "20", (77, 20, 1, 1, 0)),
])
def test_default_members(spark, star, meal, center, expected):
    df = ingest.normalize(feed(spark, meal_id=meal, center_id=center))
    assert rows(ingest.resolve_keys(df, star), "meal_id", "center_id", "category_id",
                "meal_substituted", "center_substituted") == [expected]


@pytest.mark.parametrize("given, expected", [
    ({"sold": 0}, {"sold_qty": 1}),
    ({"sold": 100, "prepared": 40}, {"prepared_qty": 100, "waste_qty": 0}),
    ({"sold": 100, "prepared": 130}, {"prepared_qty": 130, "waste_qty": 30}),
    ({"sold": 100, "prepared": 130, "waste": 7}, {"waste_qty": 7, "waste_percentage": 5.38}),
    ({"sold": 100, "prepared": 130, "waste": -7}, {"waste_qty": 0}),
    ({"price": "400"}, {"checkout_price": 400, "base_price": 400, "discount_percent": 0}),
    ({}, {"checkout_price": 285.5, "base_price": 310, "discount_percent": 7.9}),
])
def test_measures(spark, star, given, expected):
    df = feed(spark, date="2024-07-01", meal_id="1885", center_id="55", **given)
    row = ingest.fact_rows(df, star).first()
    assert {k: float(row[k]) for k in expected} == expected


def test_imputed_quantities(spark, star):
    df = spark.range(500).select("id", F.lit("1885").alias("meal_id"),
                                 F.lit("2024-07-01").alias("date"))
    got = ingest.fact_rows(df, star, "id")
    again = ingest.fact_rows(df.repartition(16), star, "id")
    assert rows(got) == rows(again)
    low, high = got.agg(F.min("sold_qty"), F.max("sold_qty")).first()
    assert 80 <= low < high < 320
    ratio = F.col("prepared_qty") / F.col("sold_qty")
    low, high = got.agg(F.min(ratio), F.max(ratio)).first()
    assert 1.04 < low < high < 1.31


def test_append_keeps_history(spark, star, week_28, tmp_path):
    path = str(tmp_path / "increments")
    result = ingest.append(spark, star, week_28, path, 0, "id").first()
    assert (result["records_before"], result["records_added"], result["total_records"]) == (5, 5, 10)
    both = ingest.with_increments(spark, star, path)
    assert kpi.summary(both).first()["total_records"] == 10
    week = periods.compare_weekly(both, 28).first()
    assert (week["record_count"], week["food_sold"], week["status"]) == (5, 655, "NORMAL")
    assert rows(both.fact.where("fact_id > 5"), "fact_id", "original_record_id") == [
        (i, i) for i in (10, 6, 7, 8, 9)]
    # the same batch again replaces itself; another batch adds
    ingest.append(spark, star, week_28, path, 0, "id")
    both = ingest.with_increments(spark, star, path)
    assert both.fact.count() == 10
    ingest.append(spark, both, week_28, path, 1, "id")
    both = ingest.with_increments(spark, star, path)
    assert both.fact.count() == 15 and both.fact.select("fact_id").distinct().count() == 15
    assert both.date.count() == 27


def test_stream_reads_each_file_once(spark, star, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "stream")
    schema = "id BIGINT, date STRING, sold STRING, meal_id STRING, center_id STRING"

    def land(first, day):
        spark.range(first, first + 10).select(
            "id", F.lit(day).alias("date"), F.lit("100").alias("sold"),
            F.lit("1885").alias("meal_id"), F.lit("55").alias("center_id"),
        ).coalesce(1).write.mode("append").parquet(landing)

    def run():
        files.ingest_files(spark, star, files.read_stream(spark, landing, schema, 1), lambda d: d,
                           path, str(tmp_path / "checkpoint"), "id")
        return ingest.with_increments(spark, star, path).fact

    land(0, "2024-07-01")
    land(10, "2024-07-02")
    assert run().count() == 25
    assert run().count() == 25  # nothing new
    land(20, "2023-01-05")  # old dates are accepted
    got = run()
    assert got.count() == 35
    assert sorted(r[0] for r in got.select("fact_id").collect()) == list(range(1, 36))


def test_windows_close_and_late_rows_are_left_out(spark, star, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "windows")
    schema = "id BIGINT, date STRING, sold STRING, prepared STRING"

    def run(number, *days_and_sold):
        spark.createDataFrame(
            [(number * 100 + i, day, str(sold), str(2 * sold))
             for i, (day, sold) in enumerate(days_and_sold)], schema,
        ).coalesce(1).write.mode("append").parquet(landing)
        feed = files.read_stream(spark, landing, schema)
        files.run_windows(spark, files.window_measures(feed, star, "id"), path,
                          str(tmp_path / "checkpoint"))

    run(1, ("2024-07-01", 100), ("2024-07-03", 50), ("2024-07-09", 300))
    run(2, ("2024-07-02", 999), ("2024-07-17", 10))  # the first is too late
    got = spark.read.parquet(path)
    assert rows(got, F.col("window_start").cast("string"), "food_wasted", "previous_food_wasted",
                "status") == [("2024-07-01", 150, 0, "NORMAL"), ("2024-07-08", 300, 150, "CRITICAL")]


def test_files_with_their_own_headers(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("meal_id,sold,date\n1885,100,2024-01-01\n\n77,,2024-01-02\n")
    (landing / "b.csv").write_text('﻿Order Date,"Num Orders",Dish ID,Note\n2024-02-01,7,1230,"a, ""b"""\nOrder Date,"Num Orders",Dish ID,Note\n')
    (landing / "c.csv").write_text("Sales;Dish\n5;6\n")
    (landing / "d.csv").write_text("")
    got = feeds.read(spark, str(landing), ["note"])
    assert got.columns == [*fixed.FEED_SYNONYMS, "note"]
    assert rows(got, "date", "sold", "meal", "note") == sorted([
        ("2024-01-01", "100", "1885", None), ("2024-01-02", None, "77", None),
        ("2024-02-01", "7", "1230", 'a, "b"'), (None, None, None, None)], key=repr)
    (landing / "e.csv").write_text("Order Date,order_date\n1,2\n")
    with pytest.raises(ValueError, match="e.csv"):
        feeds.read(spark, str(landing))


def test_a_stream_of_files_with_their_own_headers(spark, star, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "stream")
    landing.mkdir()

    def run():
        files.ingest_files(spark, star, files.read_feed_stream(spark, str(landing), 1),
                           lambda lines: feeds.picked(lines, ["id"]), path, str(tmp_path / "checkpoint"), "id")
        return rows(spark.read.parquet(f"{path}/fact"), "row_key", "meal_id", "sold_qty")

    (landing / "a.csv").write_text("id,meal_id,sold,date\n1,1885,100,2024-07-01\n2,1230,5,2024-07-01\n")
    (landing / "b.csv").write_text("Day,Orders,ID,Food ID\n2024-07-02,9,3,77\n")
    assert run() == [(1, 1885, 100), (2, 1230, 5), (3, 77, 9)]
    (landing / "c.csv").write_text("sales,ID,timestamp,dish_id\n4,4,2023-01-05,2664\n")
    assert run() == [(1, 1885, 100), (2, 1230, 5), (3, 77, 9), (4, 2664, 4)]
    assert run() == [(1, 1885, 100), (2, 1230, 5), (3, 77, 9), (4, 2664, 4)]


def test_late_rows_rewrite_their_window(spark, star, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "windows")
    schema = "id BIGINT, date STRING, sold STRING, prepared STRING"

    def run(number, *days_and_sold):
        spark.createDataFrame([(number * 100 + i, day, str(sold), str(2 * sold))
                               for i, (day, sold) in enumerate(days_and_sold)], schema,
                              ).coalesce(1).write.mode("append").parquet(landing)
        feed = files.read_stream(spark, landing, schema)
        files.run_late_windows(spark, files.window_measures(feed, star, "id", delay=None), path, str(tmp_path / "checkpoint"))
        return rows(files.latest_windows(spark, path), F.col("window_start").cast("string"), "food_wasted", "record_count", "versions")

    assert run(1, ("2024-07-01", 100), ("2024-07-09", 300)) == [("2024-07-01", 100, 1, 1), ("2024-07-08", 300, 1, 1)]
    # 60 days late, and in a window of its own
    assert run(2, ("2024-09-17", 10)) == [("2024-07-01", 100, 1, 1), ("2024-07-08", 300, 1, 1), ("2024-09-16", 10, 1, 1)]
    assert run(3, ("2024-07-03", 50), ("2024-05-01", 7)) == [
        ("2024-04-29", 7, 1, 1), ("2024-07-01", 150, 2, 2), ("2024-07-08", 300, 1, 1), ("2024-09-16", 10, 1, 1)]
    batch = files.window_measures(spark.read.parquet(landing), star, "id")
    assert rows(files.latest_windows(spark, path).drop("versions")) == rows(batch)
