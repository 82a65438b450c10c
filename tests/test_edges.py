"""Ties, gaps, odd spellings and plans that must hold at scale."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import SF_DIR
from larder.functions import changes, exact, ranks
from larder.operators import ingest, olap, periods
from larder.operators.mining import cluster, features
from larder.sources import catalog, extracts, warehouse


def test_row_percentages_round_half_to_even(spark):
    df = spark.createDataFrame([(17, 160), (5, 32), (3, 160), (1, 3), (0, 7)], "n BIGINT, d BIGINT")
    assert [r[0] for r in df.select(exact.row_pct(F.col("n"), F.col("d"))).collect()] == [
        10.62, 15.62, 1.88, 33.33, 0.0]


def test_changes_round_half_to_even(spark):
    df = spark.createDataFrame([(898, 800), (702, 800), (5, 0), (902, 800)], "now BIGINT, before BIGINT")
    got = [r[0] for r in df.select(changes.change_pct(F.col("now"), F.col("before"))).collect()]
    assert got == [12.2, -12.2, None, 12.8]


@pytest.mark.parametrize("values,rank,want", [
    ([3.0, None, 1.0, float("nan"), 2.0], 3, 3.0),
    ([1.0] * 50 + [2.0], 51, 2.0),
    ([-1e308, 0.0, 1e308], 2, 0.0),
    ([float("-inf"), 5.0, float("inf")], 2, 5.0),
])
def test_rank_among_odd_values(spark, values, rank, want):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert ranks.kth_smallest(df, "v", {None: rank}) == {None: want}


@pytest.mark.parametrize("values,rank", [([1.0, None], 2), ([None], 1), ([], 1), ([1.0], 0)])
def test_a_rank_beyond_the_values_is_an_error(spark, values, rank):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    with pytest.raises(ValueError, match="rank"):
        ranks.kth_smallest(df, "v", {None: rank})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_bounded_scan_puts_missing_keys_first(spark, n):
    df = spark.createDataFrame([(None, 1), (5, 2), (None, 3), (4, 4), (4, 5)], "k BIGINT, v BIGINT")
    want = [(None, 1), (None, 3), (4, 4), (4, 5), (5, 2)][:n]
    assert [tuple(r) for r in extracts.bounded_scan(df, ["k", "v"], n).collect()] == want


@pytest.mark.parametrize("text", [
    "2024-06-28", "2024-06-28 10:00:00", "6/28/2024", "28 June 2024", "June 28, 2024", "28-06-2024",
    "2024/06/28", "20240628", "6/28/2024 10:00", "28/6/2024", "Jun 28, 2024", "28 Jun 2024"])
def test_days_as_people_write_them(spark, text):
    got = spark.range(1).select(ingest.parsed_time(F.lit(text)).cast("date")).first()[0]
    assert got == datetime.date(2024, 6, 28)


@pytest.mark.parametrize("text", ["some day", "31/31/2024", "", "June", "2024"])
def test_other_texts_are_no_days(spark, text):
    got = spark.range(1).select(ingest.parsed_time(F.lit(text)).cast("date")).first()[0]
    assert got is None or text == "2024"


def test_missing_texts_and_numbers_beyond_whole_ones(spark, star):
    feed = spark.createDataFrame(
        [("NA", "28", "NaN", "N/A"), ("null", "nan", "inf", "-5"), ("", None, "1e30", "7.9")],
        "date STRING, week STRING, sold STRING, waste STRING")
    got = ingest.fact_rows(feed, star).select("date_id", "sold_qty", "waste_qty").collect()
    assert got[0].date_id == 202428
    assert all(r.sold_qty >= 20 and r.waste_qty >= 0 for r in got)
    assert {r.waste_qty for r in got} >= {0, 7}


def test_append_registers_the_feed_and_counts_what_it_sets_aside(spark, star, tmp_path):
    feed = spark.createDataFrame([("June 28, 2024", "5"), ("some day", "6"), ("some day", "6")], "date STRING, sold STRING")
    got = ingest.append(spark, star, feed, str(tmp_path), 0, name="june.csv").first()
    assert (got.records_added, got.records_quarantined) == (1, 2)
    listed = spark.read.parquet(f"{tmp_path}/catalog").first()
    assert (listed.name, listed.record_count, listed.processing_status, listed.column_list) == (
        "june.csv", 3, "PROCESSED_IN_WAREHOUSE", ["date", "sold"])
    with pytest.raises(ValueError, match="no rows"):
        ingest.append(spark, star, feed.where("false"), str(tmp_path), 1)


def test_all_columns_are_listed(spark):
    wide = spark.range(3).select(*[F.lit(i).alias(f"c{i}") for i in range(40)])
    assert len(catalog.profile(wide, "wide").first()["column_list"]) == 40
    assert catalog.profile(wide, "wide", shown=2).first()["column_list"] == ["c0", "c1"]


def test_limits_can_be_left_out(star):
    assert olap.dice(star, limit=None).count() == 5
    assert olap.dice(star, limit=2).count() == 2
    assert olap.slice_(star, "cuisine", "Thai", limit=None).count() >= 1


def test_a_rare_cluster_gets_a_center(spark):
    rng = np.random.default_rng(1)
    near = rng.normal(0, 1, (50_000, 5))
    data = [(i, *map(float, p)) for i, p in enumerate(near)] + [(50_000, 500.0, 500.0, 500.0, 500.0, 500.0)]
    scaled = spark.createDataFrame(data, "fact_id BIGINT, " + ", ".join(f"{c} DOUBLE" for c in cluster.SCALED))
    model = cluster.fit(scaled, k=2, starts=2, iterations=5)
    assert sorted(np.round(model.centers[:, 0])) == [0, 500]


def test_every_vocabulary_fits_the_bins(spark):
    df = spark.createDataFrame([(f"t{i}", f"c{i % 200}", "u") for i in range(300)], "center_type STRING, category STRING, cuisine STRING")
    assert features.bins(features.fit_codes(df)) == 301


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_prune_the_folders(spark):
    star = warehouse.star(spark, SF_DIR)
    for df in (periods.measures(star, F.col("calendar_date").between("1997-01-01", "1997-06-30")),
               periods.compare_custom(star, "1998-03-01", "1998-05-31")):
        assert "fact_year" in plan(df).split("PartitionFilters: [")[1].split("]")[0]


def test_no_raw_fact_is_shuffled(spark):
    star = warehouse.star(spark, SF_DIR)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (periods.dates(star), olap.rollup(star, "cuisine"), olap.pivot(star),
                   olap.rollup_hierarchy(star)):
            lines = plan(df).splitlines()
            scans = [i for i, x in enumerate(lines) if "FileScan" in x and "fact_year" in x]
            assert scans
            for i in scans:  # the first of the two above a scan of the fact is a partial total
                above = next(x for x in reversed(lines[:i]) if "Exchange" in x or "HashAggregate" in x)
                assert "HashAggregate" in above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_undated_batches_move_on_a_week(spark, star, tmp_path):
    feed = spark.createDataFrame([("5",)], "sold STRING")
    from dataclasses import replace

    ids, known = [], star
    for batch in range(3):
        ingest.append(spark, known, feed, str(tmp_path), batch)
        dates = spark.read.parquet(f"{tmp_path}/date")
        known = replace(star, date=star.date.unionByName(dates.drop("batch_id").dropDuplicates(["date_id"])))
        ids.append(spark.read.parquet(f"{tmp_path}/fact/batch_id={batch}").first()["date_id"])
    assert ids == sorted(set(ids)) and len(ids) == 3


@pytest.mark.parametrize("shape", ["even", "ties", "far"])
def test_ranks_near_the_sketch_are_exact(spark, shape):
    rng = np.random.default_rng(4)
    values = {"even": rng.random(30_000), "ties": rng.integers(0, 5, 30_000).astype(float),
              "far": np.concatenate([rng.random(29_990) * 1e-9, [1e300, -1e300, np.inf, -np.inf, 5, 6, 7, 8, 9, 10]])}[shape]
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(30_000) % 2, "v": values}))
    order = np.sort(values)
    for rank in (1, 2, 14_999, 15_000, 29_999, 30_000):
        assert ranks.kth_smallest(df, "v", {None: rank}) == {None: order[rank - 1]}
    halves = [np.sort(values[k::2]) for k in range(2)]
    assert ranks.kth_smallest(df, "v", {0: 7000, 1: 15_000}, "g") == {0: halves[0][6999], 1: halves[1][14_999]}
    if shape != "far":
        for q in (0, 0.5, 0.9801, 1):
            assert ranks.quantile(df, "v", q) == pytest.approx(np.quantile(values, q), abs=1e-12)
