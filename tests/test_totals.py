"""Kept totals: the same results as from the facts, after a load and after appends."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import facts, rows
from larder.operators import ingest, kpi, olap, periods, reports, totals
from larder.sources import warehouse

OPERATORS = {
    "slice": lambda s: olap.slice_(s, "category", "Fish"),
    "week": lambda s: olap.rollup(s, "week"), "by_category": lambda s: olap.rollup(s, "category"),
    "meals_of": lambda s: olap.drilldown(s, "category", "Fish"),
    "pivot": lambda s: olap.pivot(s, "cuisine", "quarter", "waste_percentage", ["Q1", "Q2", "Q3"]),
    "summary": kpi.summary, "monthly": kpi.monthly, "cuisine": kpi.by_cuisine, "center_type": kpi.by_center_type,
    "tier": kpi.by_risk_tier, "scorecard": reports.category_scorecard, "bounds": periods.bounds,
}


def with_kept(star, folder):
    """The star with its facts and totals written, and what its facts lack noted."""
    spark = star.fact.sparkSession
    star.fact.write.parquet(f"{folder}/fact")
    star = replace(star, fact=spark.read.parquet(f"{folder}/fact"))
    lacking = {r.dimension for r in warehouse.orphan_keys(star).collect()}
    totals.kept_rows(star.fact, star.item, star.center, star.category.select("category_id"), star.date.select("date_id")
                     ).write.parquet(f"{folder}/totals")
    return replace(star, complete=frozenset(warehouse.KEYS) - lacking,
                   kept=warehouse.read_kept(spark, f"{folder}/totals"))


@pytest.fixture(scope="module")
def stars(spark, star, tmp_path_factory):
    """A star with facts of an unknown center and of an unknown date, as loaded and after two appends."""
    feed = spark.createDataFrame(
        [(1, "2024-07-14", "100", "1885", "55"), (2, "2024-07-15", "90", "9", "55"), (3, "2024-01-29", "20", "77", "13"),
         (4, "2024-07-15", "90", "2664", "99"), (5, "no day", "90", "2664", "20")],
        "id BIGINT, date STRING, sold STRING, meal_id STRING, center_id STRING")
    unknown = facts(spark, [(7, 1885, 98, 40, 50), (60, 1230, 13, 70, 80)]).withColumn("fact_id", F.col("fact_id") + 5)
    folder = str(tmp_path_factory.mktemp("star"))
    loaded = with_kept(replace(star, fact=star.fact.unionByName(unknown)), folder)
    once = loaded
    for batch in range(2):
        ingest.append(spark, once, feed, f"{folder}/more", batch, "id")
        once = ingest.with_increments(spark, loaded, f"{folder}/more")
    return {"loaded": loaded, "appended": once}


@pytest.mark.parametrize("name", ["loaded", "appended"])
def test_kept_totals_change_nothing(stars, name):
    star = stars[name]
    plain = replace(star, kept={}, complete=frozenset())
    differ = [k for k, query in OPERATORS.items() if rows(query(star)) != rows(query(plain))]
    assert differ == []


def test_facts_are_not_read(stars):
    star = stars["appended"]
    for name, query in OPERATORS.items():
        files = query(star).inputFiles()
        assert files and not [f for f in files if "/fact/" in f], name


def test_facts_without_member(stars):
    """What a set leaves out decides whether it serves."""
    star = stars["loaded"]
    assert star.complete == {"item", "category"}
    assert kpi.summary(star).first()["total_records"] == 7
    assert kpi.by_cuisine(star).agg(F.sum("sold")).first()[0] == 100 + 350 + 351 + 99 + 50 + 40 + 70
    assert olap.rollup(star, "cuisine").agg(F.sum("total_sold")).first()[0] == 950


def test_a_repeated_batch_replaces_its_totals(spark, stars, star, tmp_path):
    loaded = stars["loaded"]
    feed = spark.createDataFrame([(1, "2024-07-14", "100", "1885", "55")],
                                 "id BIGINT, date STRING, sold STRING, meal_id STRING, center_id STRING")
    for _ in range(2):
        ingest.append(spark, loaded, feed, str(tmp_path), 0, "id")
    both = ingest.with_increments(spark, loaded, str(tmp_path))
    assert kpi.summary(both).first()["total_records"] == 8


def test_empty_fact(spark, star, tmp_path):
    empty = with_kept(replace(star, fact=star.fact.limit(0)), str(tmp_path))
    assert kpi.summary(empty).first()["total_records"] == 0
    assert olap.rollup(empty).count() == periods.weeks(empty).count() == 0
