"""Periods with data, their measures, and comparison with the period before.

Every comparison starts from totals by date, kept ones or those of one scan of the fact; what follows
works on one row per date, so all periods of a grain are answered in one job and a filter picks some.
"""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import calendar, changes, exact, fixed
from larder.operators.totals import by_key
from larder.sources.warehouse import Star

METRICS = ["record_count", "food_prepared", "food_sold", "food_wasted", "waste_percentage",
           "waste_cost", "revenue"]


def by_date(star: Star, days: DataFrame | None = None) -> DataFrame:
    """Fact totals by date with the calendar attributes; `days` narrows the calendar.

    Without kept totals, the folders of other years than those of `days` are not read. A folder's year
    is that of the date_id, which for an ingested week past 53 is not the calendar's.
    """
    if days is None or "date" in star.kept:
        return star.totals("date_id").join(star.date if days is None else days, "date_id")
    fact = star.fact
    if "fact_year" in fact.columns:
        years = days.select(calendar.year_of_date_id(F.col("date_id")).alias("y")).distinct()
        fact = fact.where(F.col("fact_year").isin([r.y for r in years.collect()]))
    wanted = fact.join(days.select("date_id"), "date_id", "left_semi")
    return by_key(wanted, "date_id").join(days, "date_id")


def _measures() -> list[Column]:
    """Measures of a set of date totals; zeros if the set is empty."""
    def whole(name):
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    def amount(name):
        return F.coalesce(F.sum(name).cast("double"), F.lit(0.0))

    return [
        whole("records").alias("record_count"),
        whole("prepared").alias("food_prepared"),
        whole("sold").alias("food_sold"),
        whole("waste").alias("food_wasted"),
        F.coalesce(exact.even_pct(F.sum("waste"), F.sum("prepared")), F.lit(0.0))
        .alias("waste_percentage"),
        amount("waste_cost").alias("waste_cost"),
        amount("revenue").alias("revenue"),
    ]


# --- periods with data --------------------------------------------------------------------------

def _with_data(star: Star, *by: str) -> DataFrame:
    return by_date(star).groupBy(*by).agg(
        F.min("calendar_date").alias("start_date"),
        F.max("calendar_date").alias("end_date"),
        F.sum("records").alias("record_count"),
        F.sum("waste").alias("total_waste"),
    )


def weeks(star: Star) -> DataFrame:
    return _with_data(star, "week_number", "month_name", "year").orderBy(
        "year", "week_number", "month_name")


def months(star: Star) -> DataFrame:
    return _with_data(star, "month_name", "month_number", "year").orderBy("year", "month_number")


def years(star: Star) -> DataFrame:
    return _with_data(star, "year").orderBy("year")


def dates(star: Star) -> DataFrame:
    """Calendar dates that any fact refers to."""
    return (
        star.date.join(star.totals("date_id").select("date_id"), "date_id", "left_semi")
        .select("calendar_date").distinct().orderBy("calendar_date")
    )


def bounds(star: Star) -> DataFrame:
    """First and last date and the latest week, month and year with data."""
    return by_date(star).agg(
        F.min("calendar_date").alias("min_date"),
        F.max("calendar_date").alias("max_date"),
        F.max_by("week_number", F.struct("year", "week_number")).alias("latest_week"),
        F.max_by("month_name", F.struct("year", "month_number")).alias("latest_month"),
        F.max("year").alias("latest_year"),
        F.max("calendar_date").alias("latest_date"),
    )


def measures(star: Star, condition: Column) -> DataFrame:
    """Measures of the dates that meet a condition on the calendar."""
    return by_date(star, star.date.where(condition)).agg(*_measures())


# --- comparison with the period before ----------------------------------------------------------

def _compare(current: DataFrame, previous: DataFrame, on: Column | list,
             previous_label: Column | None = None) -> DataFrame:
    """Left join of each period with its predecessor, and the changes between them."""
    earlier = [F.col(m).alias(f"previous_{m}") for m in METRICS]
    keys = on if isinstance(on, list) else []
    pairs = current.join(previous.select(*keys, *earlier), on, "left")
    return _changes(pairs)


def _changes(pairs: DataFrame) -> DataFrame:
    pairs = pairs.fillna(0, [f"previous_{m}" for m in METRICS])

    def pct(name):
        return changes.change_pct(F.col(name), F.col(f"previous_{name}"))

    return pairs.withColumns({
        "waste_change_qty": F.col("food_wasted") - F.col("previous_food_wasted"),
        "waste_change_pct": pct("food_wasted"),
        "prep_change_pct": pct("food_prepared"),
        "sold_change_pct": pct("food_sold"),
        "waste_pct_diff": changes.point_diff(F.col("waste_percentage"),
                                             F.col("previous_waste_percentage")),
    }).withColumns({
        "change_display": changes.change_display(F.col("waste_change_pct")),
        "status": changes.warning_status(F.col("waste_change_pct")),
    })


def _labelled(pairs: DataFrame, current: Column, previous: Column) -> DataFrame:
    return pairs.withColumns({"current_period_label": current,
                              "previous_period_label": previous})


def compare_daily(star: Star, day: str | None = None) -> DataFrame:
    """Each date with data against the previous date that has data."""
    per_day = by_date(star).groupBy("calendar_date").agg(*_measures())
    # one row per calendar date reaches the window
    ordered = Window.orderBy("calendar_date")
    pairs = per_day.withColumns({
        "previous_date": F.lag("calendar_date").over(ordered),
        **{f"previous_{m}": F.lag(m).over(ordered) for m in METRICS},
    })
    pairs = _labelled(
        _changes(pairs),
        F.format_string("Date: %s", F.col("calendar_date").cast("string")),
        F.when(F.col("previous_date").isNull(), "Previous Date (No Prior Record)").otherwise(
            F.format_string("Previous Logged Date (%s)", F.col("previous_date").cast("string"))),
    ).drop("previous_date")
    return pairs if day is None else pairs.where(F.col("calendar_date") == F.lit(day).cast("date"))


def compare_weekly(star: Star, week: int | None = None, by_year: bool = False) -> DataFrame:
    """Each week number against the number before it, whether or not that one has data.

    Weeks of different years are totalled together unless by_year.
    """
    by = ["year", "week_number"] if by_year else ["week_number"]
    per_week = by_date(star).groupBy(*by).agg(*_measures())
    before = per_week.withColumn("week_number", F.col("week_number") + 1)
    pairs = _labelled(
        _compare(per_week, before, by),
        F.format_string("Week %d", "week_number"),
        F.format_string("Week %d (Previous Week)", F.col("week_number") - 1),
    )
    return pairs if week is None else pairs.where(F.col("week_number") == week)


def compare_monthly(star: Star, month: int | str | None = None,
                    by_year: bool = False) -> DataFrame:
    """Each month against the month before; January against December.

    Months of different years are totalled together unless by_year, where January's predecessor
    is the December of the year before.
    """
    by = ["year", "month_number"] if by_year else ["month_number"]
    per_month = by_date(star).groupBy(*by).agg(*_measures())
    next_month = F.col("month_number") % 12 + 1
    shifted = {"month_number": next_month}
    if by_year:
        shifted["year"] = F.col("year") + (F.col("month_number") == 12).cast("int")
    names = F.array(*map(F.lit, fixed.MONTHS))
    pairs = _labelled(
        _compare(per_month, per_month.withColumns(shifted), by),
        F.format_string("Month of %s", F.element_at(names, F.col("month_number"))),
        F.format_string("Month of %s (Previous Month)",
                        F.element_at(names, F.pmod(F.col("month_number") - 2, F.lit(12)) + 1)),
    )
    if month is None:
        return pairs
    return pairs.where(F.col("month_number") == month_of(month))


def month_of(value: int | str) -> int:
    """Month number of a number or a name; anything unknown is January."""
    text = str(value).strip()
    if text.isdigit():
        return int(text) if 1 <= int(text) <= 12 else 1
    name = text.capitalize()
    return fixed.MONTHS.index(name) + 1 if name in fixed.MONTHS else 1


def compare_yearly(star: Star, year: int | None = None) -> DataFrame:
    per_year = by_date(star).groupBy("year").agg(*_measures())
    before = per_year.withColumn("year", F.col("year") + 1)
    pairs = _labelled(
        _compare(per_year, before, ["year"]),
        F.format_string("Year %d", "year"),
        F.format_string("Year %d (Previous Year)", F.col("year") - 1),
    )
    return pairs if year is None else pairs.where(F.col("year") == year)


def compare_custom(star: Star, start: str, end: str) -> DataFrame:
    """The dates from start to end, both included, against as many days just before them."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    before_last = first - timedelta(days=1)
    before_first = before_last - (last - first)
    days = star.date.where(F.col("calendar_date").between(F.lit(before_first), F.lit(last)))
    is_current = F.col("calendar_date") >= F.lit(first)
    per_day = by_date(star, days)
    sides = [per_day.where(is_current).agg(*_measures()),
             per_day.where(~is_current).agg(*_measures())]
    # both sides are one row from the same totals
    rows = sides[0].withColumn("side", F.lit(1)).unionByName(
        sides[1].withColumn("side", F.lit(0)))
    pairs = rows.agg(*[
        F.max(F.when(F.col("side") == side, F.col(m))).alias(prefix + m)
        for side, prefix in ((1, ""), (0, "previous_")) for m in METRICS
    ])
    return _labelled(
        _changes(pairs),
        F.lit(f"Custom Range ({first} to {last})"),
        F.lit(f"Previous Equivalent Range ({before_first} to {before_last})"),
    )


def early_warning(pairs: DataFrame) -> DataFrame:
    """The warning card of each compared period."""
    pct, before = F.col("waste_change_pct"), F.col("previous_record_count")
    return pairs.select(
        *[c for c in ("year", "month_number", "week_number", "calendar_date")
          if c in pairs.columns],
        "current_period_label",
        "previous_period_label",
        F.format_string("%,d", "food_wasted").alias("current_waste_display"),
        F.format_string("%,d", "previous_food_wasted").alias("previous_waste_display"),
        "change_display",
        "status",
        changes.warning_badge(F.col("status")).alias("badge"),
        changes.warning_message(pct, before).alias("message"),
        changes.warning_detail(pct, F.col("waste_change_qty"), before).alias("details"),
    )
