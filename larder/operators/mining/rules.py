"""Association rules from (basket_id, item) rows: between pairs of items, and between sets of any size."""

import math

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.session import scratch_dir


def basket_count(baskets: DataFrame) -> int:
    return baskets.select("basket_id").distinct().count()


def item_support(baskets: DataFrame, min_support: float = fixed.RULE_MIN_SUPPORT) -> DataFrame:
    """Items in at least min_support of the baskets, each basket counted once.

    A popular item is one row per basket after the distinct, and is counted by partial sums.
    """
    return _frequent(baskets.distinct(), min_support, basket_count(baskets))


def _frequent(lines: DataFrame, min_support: float, n_baskets: int) -> DataFrame:
    """Of distinct lines."""
    return (
        lines.groupBy("item").agg(F.count(F.lit(1)).alias("basket_count"))
        .withColumn("support", F.col("basket_count") / F.lit(float(n_baskets)))
        .where(F.col("support") >= min_support)
    )


def pair_support(baskets: DataFrame, min_support: float = fixed.RULE_MIN_SUPPORT,
                 items: DataFrame | None = None, n_baskets: int | None = None) -> DataFrame:
    """Pairs of frequent items in at least min_support of the baskets.

    Baskets are cut down to their frequent items first. There are at most
    (mean distinct items per basket) / min_support of those, however large one basket is, so a
    cut basket is a short sorted array. Equal baskets are then counted as one, and only the
    distinct ones are taken apart into pairs, each weighted by its count.
    """
    n = basket_count(baskets) if n_baskets is None else n_baskets
    items = _frequent(baskets.distinct(), min_support, n) if items is None else items
    distinct_baskets = (
        baskets.join(items.select("item"), "item")
        .groupBy("basket_id").agg(F.sort_array(F.collect_set("item")).alias("items"))
        .groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        distinct_baskets
        .select("items", "n", F.posexplode("items").alias("i", "item_a"))
        .select("item_a", "n", F.explode(
            F.slice("items", F.col("i") + 2, F.size("items"))).alias("item_b"))
        .groupBy("item_a", "item_b").agg(F.sum("n").alias("basket_count"))
        .withColumn("support", F.col("basket_count") / F.lit(float(n)))
        .where(F.col("support") >= min_support)
    )


def rules(baskets: DataFrame, min_support: float = fixed.RULE_MIN_SUPPORT,
          min_confidence: float = fixed.RULE_MIN_CONFIDENCE,
          min_lift: float = fixed.RULE_MIN_LIFT) -> DataFrame:
    """Rules of both directions of each frequent pair, with their unrounded measures.

    The distinct lines and the frequent items are written once; every step reads those.
    """
    lines = _written(baskets.distinct(), "baskets")
    n = basket_count(lines)
    items = _written(_frequent(lines, min_support, n), "items")
    pairs = pair_support(lines, min_support, items, n)
    both = pairs.select(
        F.explode(F.array(
            F.struct(F.col("item_a").alias("antecedent"), F.col("item_b").alias("consequent")),
            F.struct(F.col("item_b").alias("antecedent"), F.col("item_a").alias("consequent")),
        )).alias("rule"),
        F.col("support"),
    ).select("rule.*", "support")

    def side(name):
        return items.select(F.col("item").alias(name), F.col("support").alias(f"{name}_support"))

    confidence, lift = F.col("confidence"), F.col("lift")
    return (
        both.join(side("antecedent"), "antecedent").join(side("consequent"), "consequent")
        .withColumn("confidence", F.col("support") / F.col("antecedent_support"))
        .withColumns({
            "lift": confidence / F.col("consequent_support"),
            "leverage": F.col("support")
            - F.col("antecedent_support") * F.col("consequent_support"),
            "conviction": F.when(
                confidence < 1, (1 - F.col("consequent_support")) / (1 - confidence)
            ).otherwise(F.lit(fixed.CERTAIN_CONVICTION)),
        })
        .where((confidence >= min_confidence) & (lift >= min_lift))
    )


def grown(baskets: DataFrame, min_support: float = fixed.RULE_MIN_SUPPORT,
          min_confidence: float = fixed.RULE_MIN_CONFIDENCE) -> tuple[FPGrowthModel, int]:
    """Frequent sets of any size by FP-growth, with the number of baskets.

    Baskets are cut down to their frequent items first, so one with very many items is short. The
    trees are dealt by item: each task grows the sets that end in its own items.
    """
    lines = _written(baskets.where("item IS NOT NULL").distinct(), "baskets")
    n = basket_count(baskets)
    items = _frequent(lines, min_support, n).select("item")
    cut = _written(lines.join(items, "item").groupBy("basket_id").agg(F.collect_list("item").alias("items")), "cut-baskets")
    # the share is of the baskets that still have items
    kept = max(cut.count(), 1)
    share = min(1.0, max(math.ceil(min_support * n - 1e-9), 1) / kept)
    return FPGrowth(itemsCol="items", minSupport=share * (1 - 1e-12), minConfidence=min_confidence).fit(cut), n


def itemsets(model: FPGrowthModel, n_baskets: int) -> DataFrame:
    """items (in order), size, basket_count and support of each frequent set."""
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"), F.size("items").alias("size"), F.col("freq").alias("basket_count"),
        (F.col("freq") / F.lit(float(n_baskets or 1))).alias("support"))


def set_rules(model: FPGrowthModel, n_baskets: int, min_lift: float = fixed.RULE_MIN_LIFT) -> DataFrame:
    """Rules from a set of items to one more: antecedent (in order), consequent and their measures."""
    found = itemsets(model, n_baskets)
    whole = found.where("size > 1").select("support", F.explode(F.transform(
        F.col("items"), lambda c: F.struct(F.array_remove("items", c).alias("antecedent"), c.alias("consequent")))).alias("rule")).select(
        "rule.*", "support")
    of = found.select(F.col("items").alias("antecedent"), F.col("support").alias("antecedent_support"))
    to = found.where("size = 1").select(F.col("items")[0].alias("consequent"), F.col("support").alias("consequent_support"))
    confidence = F.col("support") / F.col("antecedent_support")
    return whole.join(of, "antecedent").join(to, "consequent").withColumn("confidence", confidence).withColumn(
        "lift", F.col("confidence") / F.col("consequent_support")).where(
        (F.col("confidence") >= model.getOrDefault("minConfidence")) & (F.col("lift") >= min_lift))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def presented(found: DataFrame) -> DataFrame:
    """Rules with the rounded measures and the advice."""
    percent = F.rint(F.col("confidence") * 100).cast("bigint").cast("string")
    return found.select(
        "antecedent", "consequent",
        F.round("support", 3).alias("support"),
        _percent("support").alias("support_pct"),
        F.round("confidence", 3).alias("confidence"),
        _percent("confidence").alias("confidence_pct"),
        F.round("lift", 2).alias("lift"),
        F.round("leverage", 4).alias("leverage"),
        F.round("conviction", 2).alias("conviction"),
        F.format_string(fixed.RULE_ADVICE, "antecedent", percent, "consequent")
        .alias("waste_mitigation_strategy"),
    )


def _percent(name: str) -> Column:
    return F.round(F.col(name) * 100, 1)


def top(found: DataFrame, n: int = 15) -> DataFrame:
    """The n rules of highest rounded lift, then confidence."""
    return presented(found).orderBy(
        F.desc("lift"), F.desc("confidence"), "antecedent", "consequent").limit(n)
