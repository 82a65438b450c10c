"""Building the fact rows and numbering them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import measures
from larder.session import scratch_dir
from larder.sources import schemas


ROWS_PER_RANGE = 2_000_000


def build_fact(orders: DataFrame, items: DataFrame, categories: DataFrame,
               keep: Sequence[str] = ()) -> DataFrame:
    """Order rows to fact rows; `keep` names order columns to carry along.

    Orders of unknown meals stay, with the default rate and the first category. The dimension
    joins carry no hint: Spark broadcasts a side whose size is known to be small, and otherwise
    joins by shuffle with hot keys split.
    """
    sold, promo = F.col("num_orders"), F.col("emailer_for_promotion") + F.col("homepage_featured")
    noise = (
        F.col("noise_total") if "noise_total" in orders.columns
        else measures.noise_sum(F.col("id"), F.col("meal_id"), F.col("center_id"),
                                F.col("week"), sold)
    )
    if "date_id" not in orders.columns:
        orders = orders.withColumn("date_id", (F.lit(202400) + F.col("week")).cast("bigint"))
    rows = (
        orders.join(items.select("meal_id", "category"), "meal_id", "left")
        .join(categories.select("category_id", F.col("category_name").alias("category")),
              "category", "left")
        .withColumns({
            "category_id": F.coalesce("category_id", F.lit(1)),
            "sold_qty": sold,
            "prepared_qty": measures.prepared_qty(sold, F.col("category"), promo > 0, noise),
        })
        .withColumn("waste_qty", F.col("prepared_qty") - F.col("sold_qty"))
    )
    return measures.with_measures(rows).select(*keep, *schemas.FACT_COLUMNS)


def surrogate_key(spark: SparkSession, df: DataFrame, keys: Sequence[str], name: str = "fact_id",
                  start: int = 0, partitions: int | None = None,
                  size_by_count: bool = False) -> DataFrame:
    """Number the rows start + 1, start + 2, ... in the order of `keys`.

    Rows are range-partitioned by all the keys, so a hot first key is split by the next ones, and
    written once; numbering from the written files gives the same ids when a task is rerun. Each
    row's number is its place in its range plus the size of the ranges before it. The ranges are
    as many as the shuffle partitions (or more, with size_by_count, for a frame that is cheap to
    count), so their sizes are a small table.
    """
    if size_by_count and partitions is None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                         df.count() // ROWS_PER_RANGE)
    place = F.monotonically_increasing_id()
    staged = scratch_dir(spark, "numbered")
    ranged = (df.repartitionByRange(partitions, *keys) if partitions
              else df.repartitionByRange(*keys))
    (
        ranged.sortWithinPartitions(*keys)
        .withColumns({"_range": F.shiftright(place, 33).cast("int"),
                      "_place": place.bitwiseAND(F.lit(2 ** 33 - 1))})
        .write.parquet(staged)
    )
    rows = spark.read.parquet(staged)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("n")).select(
        "_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_place") + F.lit(start + 1)
    return (
        rows.join(F.broadcast(sizes), "_range")
        .select(number.alias(name), *df.columns)
    )
