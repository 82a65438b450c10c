"""Queries on a star as SQL text with named values.

The tables are views under the names in VIEWS. A value stands in the text as :name and is passed
beside it: it becomes a literal of its own type and never part of the text.
"""

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from larder.sources.warehouse import Star

VIEWS = {"fact": "fact", "food_item": "item", "center": "center", "category": "category", "date_dim": "date"}


def frame(spark: SparkSession, star: Star, text: str, args: dict[str, Any] | None = None) -> DataFrame:
    """The result of a query, as a frame to go on with."""
    for view, table in VIEWS.items():
        getattr(star, table).createOrReplaceTempView(view)
    return spark.sql(text, args=args or {})


def rows(spark: SparkSession, star: Star, text: str, args: dict[str, Any] | None = None, limit: int | None = None) -> list[dict]:
    """The result as dictionaries; with a limit, at most so many."""
    found = frame(spark, star, text, args)
    return [r.asDict() for r in (found if limit is None else found.limit(limit)).collect()]


def scalar(spark: SparkSession, star: Star, text: str, args: dict[str, Any] | None = None) -> Any:
    """The first value of the first row; None if there is none."""
    row = frame(spark, star, text, args).first()
    return None if row is None else row[0]
