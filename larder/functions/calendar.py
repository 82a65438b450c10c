"""Calendar attributes as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_number(day: Column) -> Column:
    """Weeks counted from January 1: days 1-7 are week 1."""
    return (F.floor((F.dayofyear(day) - 1) / 7) + 1).cast("int")


def weekly_date_id(day: Column) -> Column:
    return (F.year(day) * 100 + week_number(day)).cast("bigint")


def daily_date_id(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def year_of_date_id(date_id: Column) -> Column:
    """Year of a weekly (yyyyww) or daily (yyyymmdd) date id."""
    return F.when(date_id > 9999999, F.call_function("div", date_id, F.lit(10000))).otherwise(
        F.call_function("div", date_id, F.lit(100))
    ).cast("int")


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def attributes(day: Column) -> dict[str, Column]:
    month = F.month(day)
    return {
        "month_name": F.date_format(day, "MMMM"),
        "month_number": month,
        "quarter": F.format_string("Q%d", F.quarter(day)),
        "year": F.year(day),
        "season": season(month),
    }
