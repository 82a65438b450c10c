"""Building the four dimensions from raw extracts."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import calendar, fixed


def build_category(meals: DataFrame, position: str = "meal_id") -> DataFrame:
    """Distinct categories, numbered by first appearance in the order of `position`.

    The window runs over one row per category, after the aggregation.
    """
    groups = F.create_map(*[
        x for name, (group, sensitivity) in fixed.FOOD_GROUPS.items()
        for x in (F.lit(name), F.struct(F.lit(group).alias("food_group"),
                                        F.lit(sensitivity).alias("spoilage_sensitivity")))
    ])
    known = F.try_element_at(groups, F.col("category"))
    group, sensitivity = fixed.DEFAULT_FOOD_GROUP
    return (
        meals.where("category IS NOT NULL")
        .groupBy("category").agg(F.min(position).alias("first_seen"))
        .select(
            F.row_number().over(Window.orderBy("first_seen", "category")).alias("category_id"),
            F.col("category").alias("category_name"),
            F.coalesce(known["food_group"], F.lit(group)).alias("food_group"),
            F.coalesce(known["spoilage_sensitivity"], F.lit(sensitivity))
            .alias("spoilage_sensitivity"),
        )
    )


def build_food_item(meals: DataFrame) -> DataFrame:
    """Names (given, else from the menu, else spelled from the row) and shelf-life rules."""
    menu = F.create_map(*[F.lit(x) for pair in fixed.MEAL_NAMES.items() for x in pair])
    spelled = F.format_string("%s %s #%d", "cuisine", "category", "meal_id")
    names = [F.try_element_at(menu, F.col("meal_id").cast("int")), spelled]
    if "meal_name" in meals.columns:
        names = [F.col("meal_name"), spelled]
    return meals.select(
        "meal_id",
        F.coalesce(*names).alias("item_name"),
        "category",
        "cuisine",
        _shelf_life(0).alias("perishability_tier"),
        _shelf_life(1).alias("shelf_life_days"),
        _shelf_life(2).alias("storage_type"),
    )


def _shelf_life(field: int) -> Column:
    rule = F
    for categories, *values in fixed.SHELF_LIFE_RULES:
        rule = rule.when(F.col("category").isin(categories), values[field])
    return rule.otherwise(fixed.DEFAULT_SHELF_LIFE[field])


def build_center(centers: DataFrame) -> DataFrame:
    tier = F
    for floor, name in fixed.CAPACITY_TIERS:
        tier = tier.when(F.col("op_area") >= floor, name)
    tier = tier.otherwise(fixed.DEFAULT_CAPACITY_TIER)
    return centers.withColumn("capacity_tier", tier).select(
        "center_id",
        F.format_string("%s Center #%d (City %d)", F.split("capacity_tier", " ")[0],
                        "center_id", "city_code").alias("center_name"),
        "city_code", "region_code", "center_type", "op_area", "capacity_tier",
    )


def build_date(spark: SparkSession, start: str = fixed.CALENDAR_START,
               weeks: int = fixed.CALENDAR_WEEKS) -> DataFrame:
    """A calendar of consecutive weeks from `start`, ids year * 100 + week."""
    day = F.date_add(F.lit(start).cast("date"), ((F.col("week_number") - 1) * 7).cast("int"))
    return _calendar(
        spark.range(1, weeks + 1).select(F.col("id").cast("int").alias("week_number"))
        .withColumns({"calendar_date": day,
                      "date_id": F.year(F.lit(start).cast("date")) * 100 + F.col("week_number")})
    )


def build_date_between(dates: DataFrame, day: str) -> DataFrame:
    """All weeks of the years that `day` spans, cut to its first and last week.

    One aggregation of one column; the calendar itself has at most 53 rows a year.
    """
    first_day = F.make_date("year", F.lit(1), F.lit(1))
    return _calendar(
        dates.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        .select("lo", "hi",
                F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(53))).alias("week_number"))
        .withColumns({
            "date_id": F.col("year") * 100 + F.col("week_number"),
            "calendar_date": F.date_add(first_day, (F.col("week_number") - 1) * 7),
        })
        .where(F.col("date_id").between(calendar.weekly_date_id(F.col("lo")),
                                        calendar.weekly_date_id(F.col("hi"))))
    )


def _calendar(weeks: DataFrame) -> DataFrame:
    attributes = calendar.attributes(F.col("calendar_date"))
    return weeks.select(
        F.col("date_id").cast("bigint").alias("date_id"),
        "week_number",
        "calendar_date",
        *[attributes[name].alias(name)
          for name in ["month_name", "month_number", "quarter", "year"]],
        (F.col("week_number") % 2 == 0).cast("int").alias("is_weekend_peak"),
        attributes["season"].alias("season"),
    )
