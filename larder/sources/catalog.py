"""Dataset profiles and the dataset catalog."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources import schemas

def profile(df: DataFrame, name: str, shown: int | None = None,
            records: int | None = None) -> DataFrame:
    """Row count and the columns of a dataset, or the first `shown`.

    The count needs no column, and no scan if `records` says it.
    """
    columns = df.columns[:shown]
    counted = (df.agg(F.count(F.lit(1)).alias("record_count")) if records is None else
               df.sparkSession.range(1).select(F.lit(records).cast("bigint").alias("record_count")))
    return counted.select(
        F.lit(name).alias("name"),
        "record_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*map(F.lit, columns)).alias("column_list"),
    )


def size_kb(df: DataFrame) -> DataFrame:
    """Total size of the files behind a scan, from their listing; no row of them is read."""
    files = df.sparkSession.read.format("binaryFile").load(df.inputFiles()).select(
        F.col("length").alias("file_size"))
    return files.agg(F.round(F.sum("file_size") / 1024, 2).alias("file_size_kb"))


def entry(df: DataFrame, name: str, path: str = "", source_type: str = "USER_UPLOAD",
          provider: str = "User Imported File", deletable: bool = True,
          status: str = "READY_FOR_ETL", with_size: bool = False,
          records: int | None = None) -> DataFrame:
    """A catalog row without its id."""
    size = size_kb(df).scalar() if with_size else F.lit(None)
    return profile(df, name, records=records).select(
        "name",
        F.lit(source_type).alias("source_type"),
        F.lit(provider).alias("provider_source"),
        F.lit("").alias("source_url"),
        F.lit(path).alias("file_path"),
        "record_count",
        "column_list",
        size.cast("double").alias("file_size_kb"),
        F.current_date().alias("import_date"),
        F.lit(status).alias("processing_status"),
        F.lit(deletable).alias("is_deletable"),
    )


def register(catalog: DataFrame | None, entries: list[DataFrame]) -> DataFrame:
    """The catalog with new rows, numbered on from the highest id in the given order."""
    last = F.lit(0) if catalog is None else F.coalesce(
        catalog.agg(F.max("dataset_id")).scalar(), F.lit(0))
    numbered = [e.withColumn("dataset_id", (last + i).cast("bigint"))
                for i, e in enumerate(entries, 1)]
    new = reduce(DataFrame.unionByName, numbered).select(*_columns())
    return new if catalog is None else catalog.unionByName(new)


def listing(catalog: DataFrame) -> DataFrame:
    """Baselines first, then uploads, with the number of listed columns."""
    return catalog.withColumn("column_count", F.size("column_list")).orderBy(
        "is_deletable", "dataset_id")


def remove(catalog: DataFrame, dataset_id: int) -> DataFrame:
    """The catalog without one uploaded dataset; baselines stay."""
    found = catalog.where(_is(dataset_id)).select("is_deletable").first()
    if found is None:
        raise ValueError("Dataset not found.")
    if not found["is_deletable"]:
        raise ValueError("External baseline benchmark datasets cannot be deleted.")
    return catalog.where(~_is(dataset_id))


def save(catalog: DataFrame, path: str, version: int) -> str:
    """Write one version of the catalog; a version in use is never overwritten."""
    target = f"{path}/version={version}"
    catalog.write.mode("errorifexists").parquet(target)
    return target


def load(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(schemas.CATALOG).parquet(target)


def _columns() -> list[str]:
    return [part.split()[0] for part in schemas.CATALOG.split(", ")]


def _is(dataset_id: int) -> Column:
    return F.col("dataset_id") == dataset_id
