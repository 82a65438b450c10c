"""Incremental feeds with drifting headers: normalize, resolve, measure, append.

A feed is a frame of text columns under any of the accepted headers. Each step adds columns and
keeps the rows, so the same steps serve batches and streams.
"""

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import calendar, fixed, measures
from larder.operators import totals
from larder.operators.fact import surrogate_key
from larder.session import scratch_dir
from larder.sources import audit, catalog, schemas, warehouse
from larder.sources.warehouse import Star

# how people write days, tried in this order after ISO; month before day where both are possible
DATE_FORMATS = ["M/d/yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "yyyyMMdd",
                "M-d-yyyy", "d-M-yyyy", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy"]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Headers in lower case with underscores; two that become the same are an error."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"headers collide after normalization: {df.columns}")
    return df.toDF(*names)


def resolve_synonyms(df: DataFrame) -> DataFrame:
    """Rename the first accepted header of each meaning; other columns stay as they are."""
    renames = {}
    for meaning, accepted in fixed.FEED_SYNONYMS.items():
        match = next((c for c in accepted if c in df.columns), None)
        if match:
            renames[match] = meaning
    clash = (set(renames.values()) - set(renames)) & set(df.columns)
    return df.drop(*clash).withColumnsRenamed(renames)


def normalize(df: DataFrame, key: str | None = None) -> DataFrame:
    """Normalized feed with all nine meanings (null if absent), promotion flags and a row key.

    `key` names a unique whole-number column; without one the key is a hash of the row. Texts that
    stand for a missing value become null.
    """
    df = resolve_synonyms(normalize_headers(df))
    row_key = F.col(key).cast("bigint") if key else F.xxhash64(*df.columns)
    absent = F.lit(None).cast("string")

    def flag(name):
        return (_whole(F.col(name)).cast("int") if name in df.columns else F.lit(0)).alias(name)

    return df.select(
        row_key.alias("row_key"),
        *[(_given(F.col(m).cast("string")) if m in df.columns else absent).alias(m)
          for m in fixed.FEED_SYNONYMS],
        flag("emailer_for_promotion"), flag("homepage_featured"),
    )


def _given(text: Column) -> Column:
    """The text, or null if it says that the value is missing."""
    return F.when(~F.trim(text).isin(fixed.MISSING_VALUES), text)


def _whole(text: Column) -> Column:
    """Whole part of a number given as text, null if it is none or beyond whole numbers."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < 2.0 ** 63, F.floor(number)).try_cast("bigint")


# --- period -------------------------------------------------------------------------------------

def parsed_time(text: Column) -> Column:
    """The time that a text names in ISO or one of DATE_FORMATS, else null."""
    text = F.trim(text)
    return F.coalesce(F.try_to_timestamp(text),
                      *[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def _parsed_date(text: Column) -> Column:
    return parsed_time(text).cast("date")


def resolve_period(feed: DataFrame, dates: DataFrame) -> DataFrame:
    """date_id of each row: of its date, else of its week, else of the week after the last one.

    Dates and weeks of the calendar keep their ids; a week means its weekly member of the latest
    year. Rows whose date cannot be read get no id and the source 'unparseable'.
    """
    by_day = dates.groupBy(F.col("calendar_date").alias("day")).agg(
        F.max("date_id").alias("day_id"))
    by_week = dates.where("date_id <= 9999999").groupBy(
        F.col("week_number").alias("known_week")).agg(F.max("date_id").alias("week_id"))
    next_week = F.coalesce(dates.agg(F.max("week_number")).scalar(),
                           F.lit(fixed.FEED_DEFAULT_LAST_WEEK)) + 1
    has_date, week = F.col("date").isNotNull(), _whole(F.col("week")).cast("int")
    rows = feed.withColumns({
        "day": _parsed_date(F.col("date")),
        "week_number": F.when(~has_date, F.coalesce(week, next_week)),
        "period_source": F.when(has_date & _parsed_date(F.col("date")).isNull(), "unparseable")
        .when(has_date, "date").when(week.isNotNull(), "week").otherwise("next"),
    })
    return (
        rows.join(by_day, "day", "left")
        .join(by_week, F.col("week_number") == F.col("known_week"), "left")
        .withColumn(
            "date_id",
            F.when(F.col("period_source") == "date",
                   F.coalesce("day_id", calendar.daily_date_id(F.col("day"))))
            .when(F.col("period_source") != "unparseable",
                  F.coalesce("week_id", (F.col("week_number") + 202400).cast("bigint"))),
        )
        .drop("day_id", "week_id", "known_week")
    )


def new_dates(resolved: DataFrame, dates: DataFrame) -> DataFrame:
    """Calendar rows for the resolved periods that the calendar does not have yet.

    Days take their ISO week and true attributes; weeks are counted from the base calendar's
    start and know only Summer and Autumn.
    """
    periods = (
        resolved.where("date_id IS NOT NULL")
        .select("date_id", "day", "week_number").distinct()
        .join(dates.select("date_id"), "date_id", "left_anti")
    )
    start = F.lit(fixed.CALENDAR_START).cast("date")
    is_day = F.col("day").isNotNull()
    periods = periods.withColumn(
        "calendar_date", F.coalesce("day", F.date_add(start, (F.col("week_number") - 1) * 7)))
    known = calendar.attributes(F.col("calendar_date"))
    month = F.col("month_number")
    return periods.withColumn("month_number", known["month_number"]).select(
        "date_id",
        F.when(is_day, F.weekofyear("calendar_date")).otherwise(F.col("week_number"))
        .cast("int").alias("week_number"),
        "calendar_date",
        known["month_name"].alias("month_name"),
        "month_number",
        known["quarter"].alias("quarter"),
        F.when(is_day, known["year"]).otherwise(F.year(start)).alias("year"),
        F.when(is_day & (F.weekday("calendar_date") >= 5), 1).otherwise(0)
        .alias("is_weekend_peak"),
        F.when(is_day, known["season"])
        .otherwise(F.when(month.isin(6, 7, 8), "Summer").otherwise("Autumn")).alias("season"),
    )


# --- keys ---------------------------------------------------------------------------------------

def resolve_keys(feed: DataFrame, star: Star) -> DataFrame:
    """Meal, center and category of each row; unknown ones become the member of smallest id."""
    items = star.item.select(F.col("meal_id"), F.col("category"))
    centers = star.center.select("center_id")
    default_meal = items.agg(F.min("meal_id")).scalar()
    default_category = items.agg(F.min_by("category", "meal_id")).scalar()
    default_center = centers.agg(F.min("center_id")).scalar()
    first_category = star.category.agg(F.min("category_id")).scalar()
    categories = star.category.select("category_id",
                                      F.lower("category_name").alias("category_key"))
    return (
        feed.withColumns({"given_meal": _whole(F.col("meal")),
                          "given_center": _whole(F.col("center"))})
        .join(items, F.col("given_meal") == F.col("meal_id"), "left")
        .join(centers, F.col("given_center") == F.col("center_id"), "left")
        .withColumns({
            "meal_substituted": F.col("meal_id").isNull().cast("int"),
            "center_substituted": F.col("center_id").isNull().cast("int"),
            "category": F.when(F.col("meal_id").isNull(), default_category)
            .otherwise(F.col("category")),
        })
        .withColumns({
            "meal_id": F.coalesce("meal_id", default_meal),
            "center_id": F.coalesce("center_id", default_center),
            "category_key": F.lower("category"),
        })
        .join(categories, "category_key", "left")
        .withColumn("category_id", F.coalesce("category_id", first_category))
        .drop("given_meal", "given_center", "category_key")
    )


# --- measures -----------------------------------------------------------------------------------

def resolve_measures(feed: DataFrame) -> DataFrame:
    """Prices, quantities and derived measures; what is missing is imputed from the row key."""
    price = F.coalesce(F.col("price").try_cast(measures.PRICE),
                       F.lit(fixed.FEED_DEFAULT_PRICE).cast(measures.PRICE))
    base = F.coalesce(F.col("base").try_cast(measures.PRICE), F.greatest(
        F.col("checkout_price"), F.lit(fixed.FEED_DEFAULT_BASE).cast(measures.PRICE)))
    key, meal, center = F.col("row_key"), F.col("meal_id"), F.col("center_id")
    span = F.lit(fixed.FEED_SOLD_BELOW - fixed.FEED_SOLD_FROM)
    drawn = fixed.FEED_SOLD_FROM + F.pmod(
        F.pmod(key, span) * 7919 + F.pmod(meal, span) * 31 + F.pmod(center, span) * 17, span)
    noise = measures.noise(
        measures.noise_sum(key, meal, center, F.lit(1), F.col("sold_qty")), fixed.FEED_NOISE_STD)
    ratio = F.least(F.greatest(measures.prep_rate(F.col("category")) + noise,
                               F.lit(fixed.FEED_RATIO_MIN)), F.lit(fixed.FEED_RATIO_MAX))
    sold, prepared = _whole(F.col("sold")), _whole(F.col("prepared"))
    waste = F.coalesce(_whole(F.col("waste")), F.col("prepared_qty") - F.col("sold_qty"))
    rows = (
        feed.withColumns({
            "checkout_price": price,
            "sold_qty": F.when(sold.isNotNull(), F.greatest(sold, F.lit(1))).otherwise(drawn),
        })
        .withColumns({
            "base_price": base,
            "prepared_qty": F.when(prepared.isNotNull(), F.greatest(prepared, F.col("sold_qty")))
            .otherwise(F.rint(F.col("sold_qty") * ratio).cast("bigint")),
        })
        .withColumn("waste_qty", F.greatest(F.lit(0), waste).cast("bigint"))
    )
    return measures.with_measures(rows)


# --- whole feeds --------------------------------------------------------------------------------

def fact_rows(feed: DataFrame, star: Star, key: str | None = None) -> DataFrame:
    """Feed to fact rows with their row key; rows with an unreadable date are left out."""
    return _facts(resolve_period(normalize(feed, key), star.date), star)


def quarantined(feed: DataFrame, star: Star, key: str | None = None) -> DataFrame:
    """The rows `fact_rows` leaves out."""
    return _set_aside(resolve_period(normalize(feed, key), star.date))


def _facts(resolved: DataFrame, star: Star) -> DataFrame:
    resolved = resolved.where("date_id IS NOT NULL")
    return resolve_measures(resolve_keys(resolved, star)).select(
        "row_key", *schemas.FACT_COLUMNS, "meal_substituted", "center_substituted")


def _set_aside(resolved: DataFrame) -> DataFrame:
    return resolved.where("date_id IS NULL").select("row_key", *fixed.FEED_SYNONYMS)


def last_ids(star: Star) -> tuple[int, int, int]:
    """Rows, highest record id and highest fact id of the stored facts."""
    row = star.fact.agg(
        F.count(F.lit(1)),
        F.coalesce(F.max("original_record_id"), F.lit(fixed.FEED_FIRST_RECORD_ID)),
        F.coalesce(F.max("fact_id"), F.lit(0)),
    ).first()
    return tuple(row)


def append(spark: SparkSession, star: Star, feed: DataFrame, path: str, batch_id: int,
           key: str | None = None, last: tuple[int, int, int] | None = None,
           name: str = "upload") -> DataFrame:
    """Add a feed to the increments under `path` without touching what is there.

    The feed is read and resolved once. New calendar rows, numbered fact rows, quarantined rows and
    the feed's catalog entry are written under the batch's own folders, so an interrupted or repeated
    batch replaces itself. `last` is what `last_ids` gave, if it is known already. A feed without
    rows is an error. Returns the one-row result.
    """
    started = time.monotonic()
    before, last_record, last_fact = last or last_ids(star)
    at = scratch_dir(spark, "resolved")
    resolve_period(normalize(feed, key), star.date).write.parquet(at)
    resolved = spark.read.parquet(at)
    received, aside = resolved.agg(
        F.count(F.lit(1)), F.count_if(F.col("date_id").isNull())).first()
    if not received:
        raise ValueError("The feed has no rows.")
    warehouse.append(new_dates(resolved, star.date), f"{path}/date", batch_id)
    warehouse.append(_set_aside(resolved), f"{path}/quarantine", batch_id)
    entry = catalog.entry(feed, name, path, status="PROCESSED_IN_WAREHOUSE", records=received)
    warehouse.append(catalog.register(None, [entry]).withColumn(
        "dataset_id", F.lit(batch_id + 1).cast("bigint")), f"{path}/catalog", batch_id)
    # copies of a row have one key; where they were written tells them apart
    facts = _facts(resolved, star).select("*", F.monotonically_increasing_id().alias("place"))
    numbered = surrogate_key(spark, facts, ["row_key", "place"], "record").drop("place")
    warehouse.append(
        numbered.select(
            (F.col("record") + last_fact).alias("fact_id"),
            (F.col("record") + last_record).alias("original_record_id"),
            *numbered.columns[1:],
        ), f"{path}/fact", batch_id)
    written = spark.read.parquet(f"{path}/fact/batch_id={batch_id}")
    warehouse.append(totals.kept_rows(written, star.item, star.center), f"{path}/totals", batch_id)
    added = written.agg(
        F.count(F.lit(1)).alias("n"), F.sum("meal_substituted").alias("meals"),
        F.sum("center_substituted").alias("centers")).first()
    audit.append(spark, f"{path}/audit_log", [
        ("CONTINUOUS_INGEST", added["n"], time.monotonic() - started,
         f"Appended {added['n']} rows as batch {batch_id}")])
    return spark.createDataFrame(
        [(before, added["n"], before + added["n"], added["meals"] or 0, added["centers"] or 0,
          last_record + added["n"], aside)],
        "records_before BIGINT, records_added BIGINT, total_records BIGINT, "
        "meals_substituted BIGINT, centers_substituted BIGINT, last_record_id BIGINT, "
        "records_quarantined BIGINT")


def with_increments(spark: SparkSession, star: Star, path: str) -> Star:
    """The star together with everything appended under `path`.

    The kept totals are those of the star and of each batch, added up; no fact is read for them. An
    appended fact has a member in every dimension, so what the star has in full stays so.
    """
    fact = spark.read.parquet(f"{path}/fact")
    added = fact.withColumn("fact_year", calendar.year_of_date_id(F.col("date_id")))
    dates = spark.read.parquet(f"{path}/date").drop("batch_id").dropDuplicates(["date_id"])
    kept = {}
    if star.kept:
        batches = warehouse.read_kept(spark, f"{path}/totals")
        kept = {name: totals.merged(star.kept[name].unionByName(batches[name]), *by)
                for name, by in totals.KEPT.items()}
    return Star(
        fact=star.fact.unionByName(added.select(*star.fact.columns)),
        item=star.item, center=star.center, category=star.category,
        date=star.date.unionByName(dates),
        complete=star.complete,
        kept=kept,
    )
