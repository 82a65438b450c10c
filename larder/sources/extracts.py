"""Raw extracts: the CSV files of the base data model and the TPC-H-like test tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import calendar, measures, ranks


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and a known schema; bad rows fail the read."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def bounded_scan(df: DataFrame, keys: Sequence[str], n: int | None) -> DataFrame:
    """The first n rows in key order, rows without a first key before all others; all if n is None.

    The n-th smallest first key is found first, so that only the rows up to it are sorted.
    """
    if n is None:
        return df.orderBy(*keys)
    first = F.col(keys[0])
    total, missing = df.agg(F.count(F.lit(1)), F.count_if(first.isNull())).first()
    if missing >= n:
        df = df.where(first.isNull())
    elif total > n:
        cutoff = ranks.kth_smallest(df, keys[0], {None: n - missing})[None]
        df = df.where(first.isNull() | (first <= F.lit(cutoff)))
    return df.orderBy(*keys).limit(n)


# --- the test tables as raw extracts ------------------------------------------------------------

# Category by brand number modulo 14, cuisine by size modulo 4,
# center type by supplier key modulo 3
CATEGORIES = ["Fish", "Seafood", "Salad", "Biryani", "Rice Bowl", "Soup", "Pasta", "Sandwich",
              "Pizza", "Desert", "Starters", "Other Snacks", "Extras", "Beverages"]
CUISINES = ["Thai", "Indian", "Italian", "Continental"]
CENTER_TYPES = ["TYPE_A", "TYPE_B", "TYPE_C"]

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate"]
# equal rows are told apart by where they were read, so that any number of copies can be split
LOAD_ORDER = [*LINE_KEYS, "source_file", "source_row"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def meals(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("meal_id"),
        F.format_string("%s #%d", "p_name", "p_partkey").alias("meal_name"),
        _pick(CATEGORIES, brand % 14).alias("category"),
        _pick(CUISINES, F.col("p_size") % 4).alias("cuisine"),
    )


def centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("center_id"),
            F.col("s_nationkey").alias("city_code"),
            F.col("n_regionkey").alias("region_code"),
            _pick(CENTER_TYPES, key % 3).alias("center_type"),
            ((key * 37 % 62 + 9) / F.lit(10.0)).alias("op_area"),
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"))


def orders(spark: SparkSession, sf_dir: str, line: DataFrame | None = None) -> DataFrame:
    """One order row per lineitem row (numbered, if `line` is)."""
    line = table(spark, sf_dir, "lineitem") if line is None else line
    numbers = [c for c in ("fact_id",) if c in line.columns]
    price = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_retailprice").cast(measures.PRICE).alias("base_price"))
    discount = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    return line.join(price, F.col("l_partkey") == F.col("p_partkey")).select(
        *numbers,
        calendar.weekly_date_id(F.col("l_shipdate")).alias("date_id"),
        F.col("l_partkey").alias("meal_id"),
        F.col("l_suppkey").alias("center_id"),
        F.round(F.col("base_price") * discount, 2).cast(measures.PRICE).alias("checkout_price"),
        "base_price",
        (F.col("l_returnflag") == "R").cast("int").alias("emailer_for_promotion"),
        ((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1)).cast("int")
        .alias("homepage_featured"),
        (F.col("l_quantity") * 10).cast("bigint").alias("num_orders"),
        measures.noise_sum(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                           F.col("l_linenumber"), F.col("l_quantity").cast("bigint"))
        .alias("noise_total"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feed(table(spark, sf_dir, "events"))


def as_feed(events: DataFrame) -> DataFrame:
    """The events as a daily feed with its own header spelling: no prices, some unknown centers."""
    return events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("Order Date"),
        F.get_json_object("props", "$.k").alias("Dish ID"),
        F.col("user_id").cast("string").alias("Hub ID"),
        F.greatest(F.lit(1), F.col("value").cast("int")).cast("string").alias("Num Orders"),
    )


# How the branches of a chain head their files
FEED_HEADERS = [["event_id", "Order Date", "Dish ID", "Hub ID", "Num Orders"],
                ["Sales", "Store ID", "event_id", "Food ID", "Timestamp", "Remarks"],
                ["Kitchen ID", "Day", "Orders", "Event ID", "Meal ID"]]
_FEED_FIELDS = {"event_id": "event_id", "Event ID": "event_id", "Order Date": "Order Date", "Timestamp": "Order Date",
                "Day": "Order Date", "Dish ID": "Dish ID", "Food ID": "Dish ID", "Meal ID": "Dish ID", "Hub ID": "Hub ID",
                "Store ID": "Hub ID", "Kitchen ID": "Hub ID", "Num Orders": "Num Orders", "Sales": "Num Orders", "Orders": "Num Orders"}


def land_feed_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The daily feed as CSV files in one folder, by branch under one of FEED_HEADERS each."""
    rows = feed(spark, sf_dir)
    for k, header in enumerate(FEED_HEADERS):
        rows.where(F.col("event_id") % len(FEED_HEADERS) == k).select(*[
            F.col(_FEED_FIELDS[c]).alias(c) if c in _FEED_FIELDS else F.lit('none, or "few"').alias(c)
            for c in header]).write.mode("append").csv(path, header=True, escape='"')


def baskets(spark: SparkSession, sf_dir: str, item: str = "p_type") -> DataFrame:
    """Order lines as (basket_id, item) rows."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("basket_id"), F.col(item).alias("item"))
    )


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with gaps: signups carry a week number instead of a date, errors neither."""
    kind, day = F.col("event_type"), F.col("ts")
    dated = ~kind.isin("signup", "error")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(dated, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("Timestamp"),
        F.when(kind == "signup", F.weekofyear(day).cast("string")).alias("Week No"),
        F.get_json_object("props", "$.k").alias("Food ID"),
        F.col("user_id").cast("string").alias("Kitchen ID"),
        F.col("value").cast("int").cast("string").alias("Sales"),
    )


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed as people write it: many ways to write a day, missing and unreadable values."""
    way, day = F.col("event_id") % 10, F.col("ts")
    patterns = {0: "M/d/yyyy", 1: "d MMMM yyyy", 2: "MMMM d, yyyy", 3: "yyyy/MM/dd",
                4: "yyyyMMdd", 5: "M/d/yyyy H:mm", 8: "MMM d, yyyy"}
    texts = {6: "NA", 7: "some day", 9: "NaN"}
    date = F.coalesce(*[F.when(way == k, F.date_format(day, p)) for k, p in patterns.items()],
                      *[F.when(way == k, F.lit(t)) for k, t in texts.items()])
    odd = F.create_map(*[F.lit(x) for pair in {0: "NaN", 1: "inf", 2: "N/A"}.items() for x in pair])
    return table(spark, sf_dir, "events").select(
        "event_id", date.alias("Date"),
        F.when(way == 6, F.weekofyear(day).cast("string")).otherwise(F.lit("null")).alias("Week"),
        F.coalesce(F.try_element_at(odd, (F.col("event_id") % 7).cast("int")),
                   F.col("value").cast("string")).alias("Orders"),
        F.get_json_object("props", "$.k").alias("Food ID"),
    )
