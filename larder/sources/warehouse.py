"""The written star schema: full refresh, append, read, export."""

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.functions import calendar
from larder.operators import dimensions, totals
from larder.operators.fact import build_fact, surrogate_key
from larder.session import configure, scratch_dir
from larder.sources import audit, extracts

KEYS = {"item": "meal_id", "center": "center_id", "category": "category_id", "date": "date_id"}


@dataclass(frozen=True)
class Star:
    """The fact table and its four dimensions.

    `complete` names the dimensions that are known to have a member for every fact. `kept` holds
    the totals that loads and appends keep up to date, by name in totals.KEPT.
    """

    fact: DataFrame
    item: DataFrame
    center: DataFrame
    category: DataFrame
    date: DataFrame
    complete: frozenset[str] = field(default_factory=frozenset)
    kept: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    def join(self, *dims: str, known: Sequence[str] = ()) -> DataFrame:
        """Inner star join of the named dimensions.

        Facts without a member in a `known` dimension are left out too; that costs a join only
        if the load found such facts. No hints: the dimensions are files of known size, so Spark
        broadcasts the small ones and shuffles for the others, splitting hot keys.
        """
        rows = self.fact
        for dim in known:
            if dim not in dims and dim not in self.complete:
                members = getattr(self, dim).select(KEYS[dim])
                rows = rows.join(members, KEYS[dim], "left_semi")
        for dim in dims:
            rows = rows.join(getattr(self, dim), KEYS[dim])
        return rows

    def totals(self, *columns: str, known: Sequence[str] = ()) -> DataFrame:
        """Totals that have these columns, keys of the fact or columns of dimensions, to be totalled further.

        Facts without a member in a dimension that gives a column, or in a `known` one, are left out.
        The rows are those of the first kept set that leads to all columns and leaves out the same
        facts. Else the fact is totalled by the keys of up to two dimensions before their join; keys
        of three or more leave nearly one row a fact, which is totalled after it.
        """
        dims = self._giving(columns, self.fact.columns)
        wanted = {*known, *dims} - self.complete
        for name, by in totals.KEPT.items():
            joined = self._giving(columns, by)
            if name in self.kept and joined is not None:
                without = {*joined, *(KEYS if name == "group" else ())} - self.complete
                if without == wanted:
                    return self._with_members(self.kept[name], joined)
        facts = self.join(known=[d for d in known if d not in dims])
        if len(dims) > 2:
            return totals.by_key(self._with_members(facts, dims), *columns)
        keys = [c for c in columns if c in self.fact.columns]
        return self._with_members(
            totals.by_key(facts, *dict.fromkeys([*keys, *[KEYS[d] for d in dims]])), dims)

    def _giving(self, columns: Sequence[str], having: Sequence[str]) -> list[str] | None:
        """Dimensions that give the columns which rows do not have yet; None if their keys lack too."""
        dims = []
        for column in columns:
            if column not in having:
                found = [d for d, key in KEYS.items() if key in having and column in getattr(self, d).columns]
                if not found:
                    return None
                dims += [d for d in found[:1] if d not in dims]
        return dims

    def _with_members(self, rows: DataFrame, dims: Sequence[str]) -> DataFrame:
        for dim in dims:
            rows = rows.join(getattr(self, dim), KEYS[dim])
        return rows


def read(spark: SparkSession, path: str) -> Star:
    """The version published last under `path`."""
    path = f"{path}/{published(spark, path)}"
    orphans = spark.read.schema("dimension STRING, key BIGINT").parquet(f"{path}/orphans")
    lacking = {r.dimension for r in orphans.select("dimension").distinct().collect()}
    return Star(
        fact=spark.read.parquet(f"{path}/fact"),
        **{name: spark.read.parquet(f"{path}/{name}") for name in KEYS},
        complete=frozenset(KEYS) - lacking,
        kept=read_kept(spark, f"{path}/totals"),
    )


def read_kept(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The kept totals under a folder, of one load or of many batches."""
    rows = spark.read.parquet(path)
    return {name: rows.where(F.col("kept") == name).select(*by, *totals.SUMS)
            for name, by in totals.KEPT.items()}


def published(spark: SparkSession, path: str) -> str:
    versions = spark.read.schema("version STRING, published_at TIMESTAMP").parquet(
        f"{path}/versions")
    return versions.orderBy(F.desc("published_at"), F.desc("version")).first()["version"]


def publish(spark: SparkSession, path: str, version: str) -> None:
    spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("published_at"),
    ).coalesce(1).write.mode("append").parquet(f"{path}/versions")


def orphan_keys(star: Star) -> DataFrame:
    """Keys that facts use and a dimension lacks. Each key is one row before the join."""
    return reduce(DataFrame.unionByName, [
        star.fact.select(key).distinct().join(getattr(star, name), key, "left_anti")
        .select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("key"))
        for name, key in KEYS.items()
    ])


def write_fact(fact: DataFrame, path: str, mode: str) -> None:
    fact.withColumn("fact_year", calendar.year_of_date_id(F.col("date_id"))).write.mode(
        mode).partitionBy("fact_year").parquet(path)


def refresh(spark: SparkSession, path: str, meals: DataFrame, centers: DataFrame,
            orders: DataFrame, dates: DataFrame | None = None,
            day: str | None = None) -> DataFrame:
    """Full refresh: rebuild the dimensions and the fact under `path`, with audit rows.

    The tables are written as a new version, which replaces the one before when all of it is
    written. Readers of the old version are not disturbed; its folder can be deleted later.
    Orders are numbered by their id, unless they carry a fact_id. They are numbered before the
    fact is built, so that the rows are moved while they are narrow and joined once. The
    dimensions are written first, so that the fact build joins files of known size. The calendar
    spans `day` of `dates`, or is the base calendar. Returns the one-row run summary.
    """
    configure(spark)
    started = time.monotonic()
    root, version = path, f"version-{uuid.uuid4().hex[:12]}"
    path = f"{root}/{version}"
    if "fact_id" not in orders.columns:
        orders = surrogate_key(spark, orders, ["id"])
    record = "id" if "id" in orders.columns else "fact_id"
    orders = orders.withColumn("original_record_id", F.col(record))
    extracted = time.monotonic()

    built = {
        "item": dimensions.build_food_item(meals),
        "center": dimensions.build_center(centers),
        "category": dimensions.build_category(meals),
        "date": (dimensions.build_date(spark) if dates is None
                 else dimensions.build_date_between(dates, day)),
    }
    def write(name: str) -> int:
        seen = Observation(name)
        (built[name].observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(f"{path}/{name}"))
        return seen.get["n"]

    with ThreadPoolExecutor(len(built)) as pool:
        sizes = dict(zip(built, pool.map(write, built)))
    transformed = time.monotonic()

    seen = Observation("fact")
    rows = build_fact(orders, spark.read.parquet(f"{path}/item"),
                      spark.read.parquet(f"{path}/category"),
                      keep=["fact_id", "original_record_id"])
    write_fact(rows.observe(seen, F.count(F.lit(1)).alias("n")), f"{path}/fact", "overwrite")
    loaded = seen.get["n"]
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("fact", *KEYS)}
    orphan_keys(Star(**tables)).write.mode("overwrite").parquet(f"{path}/orphans")
    totals.kept_rows(*[tables[name] for name in ("fact", "item", "center")], *[
        tables[name].select(KEYS[name]) for name in ("category", "date")
    ]).write.mode("overwrite").parquet(f"{path}/totals")
    publish(spark, root, version)
    done = time.monotonic()

    audit.append(spark, f"{root}/audit_log", [
        ("EXTRACT", loaded, extracted - started, f"Read {loaded} order rows"),
        ("TRANSFORM", sum(sizes.values()), transformed - extracted, f"Built dimensions: {sizes}"),
        ("LOAD", loaded, done - transformed, f"Loaded {loaded} fact rows"),
    ])
    return audit.run_summary(spark, loaded, sizes, {
        "extract_sec": extracted - started,
        "transform_sec": transformed - extracted,
        "load_sec": done - transformed,
        "total_sec": done - started,
    })


def append(fact: DataFrame, path: str, batch_id: int) -> None:
    """Add rows as one batch folder; the same batch written again replaces itself."""
    fact.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def load_test_tables(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    lines = surrogate_key(spark, extracts.lines(spark, sf_dir), extracts.LOAD_ORDER,
                          size_by_count=True)
    return refresh(
        spark, path,
        meals=extracts.meals(spark, sf_dir),
        centers=extracts.centers(spark, sf_dir),
        orders=extracts.orders(spark, sf_dir, lines),
        dates=extracts.table(spark, sf_dir, "lineitem"),
        day="l_shipdate",
    )


_loaded: dict[tuple[str, str], tuple[str, Star]] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The warehouse of one set of test tables, loaded once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _loaded:
        path = scratch_dir(spark, "warehouse")
        load_test_tables(spark, sf_dir, path)
        _loaded[key] = path, read(spark, path)
    return _loaded[key][1]
