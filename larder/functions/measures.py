"""Row measures of the fact table: preparation model, money measures, tiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions import exact, fixed

PRICE = "decimal(12,2)"
MONEY = "decimal(18,2)"


def prep_rate(category: Column) -> Column:
    rates = F.create_map(*[F.lit(x) for pair in fixed.PREP_RATES.items() for x in pair])
    return F.coalesce(F.try_element_at(rates, category), F.lit(fixed.DEFAULT_PREP_RATE))


def noise_sum(order: Column, item: Column, center: Column, line: Column, qty: Column) -> Column:
    """Sum of four near-uniform values in 0..1008, derived from the row's own keys.

    A seeded generator would give other values whenever the partitioning changes; this depends
    on nothing but the row. A key counts by its rest, so keys of 64 bits cannot overflow.
    """
    order, item, center = (F.pmod(k, F.lit(1009)) for k in (order, item, center))
    return (
        F.pmod(order * 7919 + item * 31 + line, F.lit(1009))
        + F.pmod(item * 6029 + center * 17 + order, F.lit(1009))
        + F.pmod(center * 4637 + order * 13 + line * 7, F.lit(1009))
        + F.pmod(line * 3571 + item * 11 + qty * 101, F.lit(1009))
    )


def noise(total: Column, std: float) -> Column:
    """Near-normal noise with the given standard deviation from `noise_sum`."""
    return (total - 2016) / F.lit(1009.0) * F.lit(1.7320508) * F.lit(std)


def prepared_qty(sold: Column, category: Column, promo: Column, noise_total: Column) -> Column:
    boost = F.when(promo, F.lit(fixed.PROMO_BOOST)).otherwise(F.lit(0.0))
    ratio = prep_rate(category) + boost + noise(noise_total, fixed.PREP_NOISE_STD)
    ratio = F.least(F.greatest(ratio, F.lit(fixed.PREP_RATIO_MIN)), F.lit(fixed.PREP_RATIO_MAX))
    return F.rint(sold * ratio).cast("bigint")  # rint is half-even


def waste_percentage(waste: Column, prepared: Column) -> Column:
    return exact.row_pct(waste, F.greatest(prepared, F.lit(1)))


def discount_amount(base: Column, checkout: Column) -> Column:
    return F.greatest(F.lit(0).cast(PRICE), base - checkout).cast(PRICE)


def discount_percent(discount: Column, base: Column) -> Column:
    cents = F.greatest(base, F.lit(1).cast(PRICE)) * 100
    return exact.row_pct((discount * 100).cast("bigint"), cents.cast("bigint"))


def waste_cost(waste: Column, base: Column) -> Column:
    return (waste * base).cast(MONEY)


def revenue(sold: Column, checkout: Column) -> Column:
    return (sold * checkout).cast(MONEY)


def profit_loss(revenue_: Column, prepared: Column, base: Column) -> Column:
    share = F.lit(fixed.COST_SHARE).cast("decimal(2,2)")
    return F.bround(revenue_ - prepared * base * share, 2).cast(MONEY)


def waste_risk_tier(pct: Column) -> Column:
    return (
        F.when(pct > fixed.WASTE_HIGH_ABOVE, "HIGH")
        .when(pct >= fixed.WASTE_MEDIUM_FROM, "MEDIUM")
        .otherwise("LOW")
    )


def demand_tier(sold: Column) -> Column:
    return (
        F.when(sold > fixed.DEMAND_HIGH_ABOVE, "HIGH")
        .when(sold >= fixed.DEMAND_MEDIUM_FROM, "MEDIUM")
        .otherwise("LOW")
    )


def with_measures(df):
    """Add the derived measures to rows with sold, prepared, waste and both prices."""
    return (
        df.withColumns({
            "discount_amount": discount_amount(F.col("base_price"), F.col("checkout_price")),
            "waste_percentage": waste_percentage(F.col("waste_qty"), F.col("prepared_qty")),
            "waste_cost": waste_cost(F.col("waste_qty"), F.col("base_price")),
            "revenue": revenue(F.col("sold_qty"), F.col("checkout_price")),
        })
        .withColumns({
            "discount_percent": discount_percent(F.col("discount_amount"), F.col("base_price")),
            "profit_loss": profit_loss(F.col("revenue"), F.col("prepared_qty"),
                                       F.col("base_price")),
            "waste_risk_tier": waste_risk_tier(F.col("waste_percentage")),
            "demand_tier": demand_tier(F.col("sold_qty")),
        })
    )
