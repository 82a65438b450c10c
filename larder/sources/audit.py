"""The run log, warehouse status and run summaries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources import schemas


def append(spark: SparkSession, path: str, steps: list[tuple[str, int, float, str]],
           status: str = "SUCCESS") -> None:
    """One log row per step, given as (name, records, seconds, details)."""
    rows = [(step, status, int(records), round(float(seconds), 3), details)
            for step, records, seconds, details in steps]
    columns = "step_name STRING, status STRING, records_processed BIGINT, "
    columns += "execution_time_sec DOUBLE, details STRING"
    log = spark.createDataFrame(rows, columns).withColumn("run_timestamp", F.current_timestamp())
    log.coalesce(1).write.mode("append").parquet(path)


def recent(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    return spark.read.schema(schemas.AUDIT_LOG).parquet(path).orderBy(
        F.desc("run_timestamp"), "step_name").limit(n)


def run_summary(spark: SparkSession, loaded: int, sizes: dict, seconds: dict) -> DataFrame:
    return spark.range(1).select(
        F.lit("SUCCESS").alias("status"),
        F.lit(loaded).cast("bigint").alias("records_loaded"),
        *[F.lit(n).cast("bigint").alias(f"{name}_rows") for name, n in sizes.items()],
        *[F.lit(round(s, 3)).alias(name) for name, s in seconds.items()],
    )


def status(star) -> DataFrame:
    """ONLINE if there are facts, with the size of each table."""
    counts = {
        "fact_records": star.fact, "food_items": star.item,
        "fulfillment_centers": star.center, "date_periods": star.date,
    }
    first, *others = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in counts.items()]
    return first.select(
        F.when(F.col("fact_records") > 0, "ONLINE").otherwise("EMPTY").alias("warehouse_status"),
        "fact_records",
        *[df.scalar().alias(df.columns[0]) for df in others],
    )
