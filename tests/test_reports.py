"""OLAP, reports, periods on the hand-made star."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import facts, rows
from larder.functions import changes
from larder.operators import insights, kpi, olap, periods, reports


def test_slice_rejects_unknown_dimension(star):
    with pytest.raises(ValueError):
        olap.slice_(star, "color", "red")
    with pytest.raises(ValueError):
        olap.drilldown(star, "color", "red")


def test_unknown_level_rolls_up_to_category(star):
    assert rows(olap.rollup(star, "no such level")) == rows(olap.rollup(star, "category"))


def test_dice_conditions_and_order(star):
    assert [r.fact_id for r in olap.dice(star).collect()] == [2, 3, 4, 1, 5]
    assert rows(olap.dice(star, cuisine="Thai", quarter="Q1"), "fact_id") == [(1,), (2,)]
    assert olap.dice(star, cuisine="Thai", center_type="TYPE_A").count() == 0


def test_pivot_fills_and_adds_means(star):
    got = olap.pivot(star, "category", "center_type", "waste_percentage").collect()
    by = {r["label"]: r for r in got}
    assert by["Fish"]["TYPE_A"] == 0
    assert by["Fish"]["total"] == round(by["Fish"]["TYPE_B"], 2)


def test_orphans_count_in_kpis_but_not_in_joins(spark, star):
    orphan = facts(spark, [(30, 1885, 55, 10, 20)]).withColumn("fact_id", F.lit(99).cast("bigint"))
    more = replace(star, fact=star.fact.unionByName(orphan))
    assert kpi.summary(more).first()["total_records"] == 6
    assert sum(r.record_count for r in olap.rollup(more, "cuisine").collect()) == 5
    assert reports.browse_count(more).first()["total_records"] == 5


def test_ratio_of_sums_is_not_mean_of_ratios(star):
    fish = {r.category_name: r for r in reports.category_scorecard(star).collect()}
    assert kpi.summary(star).first()["overall_waste_percentage"] == 10.71  # 114 / 1064
    assert olap.rollup(star, "cuisine").where("grouping_dimension = 'Continental'").first()[
        "avg_waste_pct"] == 11.13  # mean of 12.25 and 10.0, half up
    assert fish  # every category with facts is rated


def test_browse_pages(star):
    first = reports.browse(star, page=1, limit=2).collect()
    second = reports.browse(star, page=2, limit=2).collect()
    assert [r.original_record_id for r in first + second] == [1, 2, 3, 4]
    after = reports.browse(star, after=2, limit=2).collect()
    assert after == second
    assert rows(reports.browse(star, search="ICED TEA"), "original_record_id") == [(1,), (2,)]
    assert tuple(reports.browse_count(star, 2).first()) == (5, 3)


def test_week_spike_is_critical(star):
    spike = periods.compare_weekly(star, 5).first()
    assert (spike["food_wasted"], spike["previous_food_wasted"]) == (99, 4)
    assert spike["status"] == "CRITICAL" and spike["waste_change_pct"] == 2375.0
    first = periods.compare_weekly(star, 4).first()
    assert first["waste_change_pct"] is None and first["change_display"] == "N/A (Baseline)"
    card = periods.early_warning(periods.compare_weekly(star, 5)).first()
    assert "increased by +2375.0% (+95 units)" in card["details"]


def test_warning_edges(spark):
    df = spark.createDataFrame([(4.9,), (5.0,), (14.9,), (15.0,), (None,)], "p DOUBLE")
    assert [r[0] for r in df.select(changes.warning_status(F.col("p"))).collect()] == [
        "NORMAL", "WARNING", "WARNING", "CRITICAL", "NORMAL"]
    pair = spark.createDataFrame([(0, 0), (5, 0)], "c BIGINT, p BIGINT")
    assert [r[0] for r in pair.select(changes.change_pct(F.col("c"), F.col("p"))).collect()] == [
        None, None]


def test_previous_periods(spark, star):
    more = replace(star, fact=facts(spark, [
        (1, 1885, 55, 100, 110), (5, 1885, 55, 100, 120), (9, 1885, 55, 100, 130)]))
    daily = periods.compare_daily(more, "2024-01-29").first()
    assert daily["previous_period_label"] == "Previous Logged Date (2024-01-01)"
    weekly = periods.compare_weekly(more, 5).first()  # week 4 has no data
    assert weekly["previous_record_count"] == 0
    january = periods.compare_monthly(more, "january").first()
    assert january["previous_period_label"] == "Month of December (Previous Month)"
    custom = periods.compare_custom(more, "2024-01-29", "2024-02-27").first()
    assert (custom["food_wasted"], custom["previous_food_wasted"]) == (50, 10)
    assert custom["waste_change_pct"] == 400.0
    empty = periods.compare_custom(more, "2030-01-01", "2030-01-31").first()
    assert (empty["record_count"], empty["waste_percentage"]) == (0, 0.0)
    assert [periods.month_of(v) for v in (3, "3", "MARCH", "13", "x")] == [3, 3, 3, 1, 1]


def test_insights_rank_by_rounded_mean(star):
    top = insights.high_waste_items(star).collect()
    assert [r.avg_waste_pct for r in top] == sorted((r.avg_waste_pct for r in top), reverse=True)
    assert insights.peak_periods(star).first()["month_name"] == "January"


def test_sql_text_with_named_values(spark, star):
    from larder.sources import sqltext

    text = "SELECT item_name, :label AS label FROM food_item WHERE category = :category ORDER BY meal_id"
    for label in ("plain", "it's", "' OR 1=1 --", "x; DROP VIEW fact"):
        found = sqltext.rows(spark, star, text, {"category": "Fish", "label": label})
        assert [r["label"] for r in found] == [label]
        assert sqltext.rows(spark, star, text, {"category": label, "label": ""}) == []
    assert sqltext.scalar(spark, star, "SELECT sum(sold_qty) FROM fact WHERE sold_qty >= :least", {"least": 100}) == 801
    assert sqltext.scalar(spark, star, "SELECT 1 FROM fact WHERE false") is None
    assert len(sqltext.rows(spark, star, "SELECT * FROM fact", limit=2)) == 2
    assert sqltext.frame(spark, star, "SELECT * FROM date_dim").columns == star.date.columns


def test_a_page_after_an_id_reads_few_rows(spark, star, tmp_path):
    """The block of ids reaches the scan, and rare matches are found however far away."""
    from dataclasses import replace

    many = star.fact.where("fact_id = 1").drop("fact_id", "original_record_id").crossJoin(
        spark.range(1, 20_001).select(F.col("id").alias("fact_id"), F.col("id").alias("original_record_id")))
    many = many.withColumn("meal_id", F.when(F.col("fact_id") % 7000 == 0, 1230).otherwise(F.col("meal_id")))
    many.repartitionByRange(20, "fact_id").sortWithinPartitions("fact_id").write.parquet(str(tmp_path / "fact"))
    wide = replace(star, fact=spark.read.parquet(str(tmp_path / "fact")))
    page = reports.browse(wide, after=15_000, limit=3)
    assert rows(page, "original_record_id") == [(15_001,), (15_002,), (15_003,)]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(fact_id,15003)" in plan and "GreaterThan(fact_id,15000)" in plan
    assert rows(reports.browse(wide, after=10, limit=2, search="fish"), "original_record_id") == [(14_000,), (7000,)]
    assert rows(reports.browse(wide, after=14_000, limit=2, search="fish")) == []
    assert reports.browse(wide, after=19_999, limit=5).count() == 1
    assert reports.browse_count(wide, 20, "fish").first()["total_records"] == 2
