"""Period-over-period changes, early warnings and their display texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions import exact, fixed


def change_pct(current: Column, previous: Column) -> Column:
    """Percent change with one decimal; null where there was nothing before."""
    return F.when(previous > 0, exact.even_pct(current - previous, previous, 1))


def point_diff(current: Column, previous: Column) -> Column:
    """Difference of two percentages that have two decimals."""
    return (exact.hundredths(current) - exact.hundredths(previous)) / F.lit(100.0)


def warning_status(pct: Column) -> Column:
    return (
        F.when(pct >= fixed.CRITICAL_FROM, "CRITICAL")
        .when(pct >= fixed.WARNING_FROM, "WARNING")
        .otherwise("NORMAL")
    )


def change_display(pct: Column) -> Column:
    return (
        F.when(pct.isNull(), fixed.BASELINE_DISPLAY)
        .when(pct > 0, F.format_string("%+.1f%%", pct))
        .otherwise(F.format_string("%.1f%%", pct))
    )


def warning_badge(status: Column) -> Column:
    badges = F.create_map(*[F.lit(x) for pair in fixed.WARNING_BADGES.items() for x in pair])
    return F.element_at(badges, status)


def warning_message(pct: Column, previous_records: Column) -> Column:
    return (
        F.when(pct.isNull() & (previous_records == 0), fixed.MSG_BASELINE)
        .when(pct.isNull(), fixed.MSG_NO_CHANGE)
        .when(pct >= fixed.CRITICAL_FROM, fixed.MSG_CRITICAL)
        .when(pct >= fixed.WARNING_FROM, fixed.MSG_WARNING)
        .otherwise(F.format_string(fixed.MSG_CONTROLLED, F.format_string("%+.1f%%", pct)))
    )


def warning_detail(pct: Column, change_qty: Column, previous_records: Column) -> Column:
    signed_pct = F.format_string("%+.1f%%", pct)
    signed_qty = F.format_string("%+,d", change_qty)
    return (
        F.when(pct.isNull() & (previous_records == 0), fixed.DETAIL_BASELINE)
        .when(pct.isNull(), fixed.DETAIL_NO_CHANGE)
        .when(pct >= fixed.CRITICAL_FROM,
              F.format_string(fixed.DETAIL_CRITICAL, signed_pct, signed_qty))
        .when(pct >= fixed.WARNING_FROM,
              F.format_string(fixed.DETAIL_WARNING, signed_pct, signed_qty))
        .otherwise(F.format_string(fixed.DETAIL_CONTROLLED, signed_pct))
    )
