"""Rounded ratios and means that do not depend on row order, partitioning or float noise.

Everything is rounded on whole numbers, so a value on a tie (12.345) rounds the same way however
the rows were split over tasks. `ratio` rounds ties away from zero, as SQL does; the functions on
`even` round them to the even neighbour, as numeric libraries do, and serve what is rounded per row.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int) -> Column:
    """round(num / den, digits) of two whole numbers, as a double; null where den is 0."""
    scale = 10 ** digits
    den = F.nullif(den.cast("decimal(38,0)"), F.lit(0))
    num = num.cast("decimal(38,0)")
    half_up = F.call_function("div", F.abs(num) * (2 * scale) + den, den * 2)
    return F.signum(num).cast("bigint") * half_up / F.lit(float(scale))


def ratio_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """round(num / den * 100, digits) of two whole numbers."""
    return ratio(num * 100, den, digits)


def even(num: Column, den: Column) -> Column:
    """num / den of whole numbers, den > 0, to the nearest whole number; ties to the even one."""
    size = F.abs(num)
    whole = F.call_function("div", size, den)
    twice = (size - whole * den) * 2
    up = (twice > den) | ((twice == den) & (whole % 2 == 1))
    return F.signum(num).cast("bigint") * (whole + up.cast("int"))


def even_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """num / den * 100 of whole numbers with ties to the even digit; null where den is not above 0."""
    den = F.when(den > 0, den.cast("decimal(38,0)"))
    scale = 10 ** digits
    return even(num.cast("decimal(38,0)") * (100 * scale), den) / F.lit(float(scale))


def row_pct(num: Column, den: Column) -> Column:
    """Two-digit percentage of one row; long arithmetic, for den >= 1."""
    return even(num * 10000, den) / F.lit(100.0)


def hundredths(value: Column) -> Column:
    """A value with at most two decimals as a whole number of hundredths."""
    return F.rint(value * 100).cast("bigint")


def mean_of(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean from a total in hundredths and a count, rounded to `digits` <= 2."""
    step = ratio(total, count * 10 ** (2 - digits), 0)
    return step / F.lit(float(10 ** digits))


def mean(value: Column, digits: int = 2) -> Column:
    """Mean of a column that holds at most two decimals, rounded to `digits` <= 2."""
    return mean_of(F.sum(hundredths(value)), F.count(value), digits)


def money(value: Column) -> Column:
    """Exact total of a decimal money column, as a double with two decimals."""
    return F.sum(value).cast("double")
