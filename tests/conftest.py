import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from pyspark.sql import SparkSession  # noqa: E402

from helpers import facts  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    """A small hand-made star: four meals, three centers, the base calendar."""
    from larder.operators import dimensions
    from larder.sources.warehouse import Star

    meals = spark.createDataFrame(
        [(1885, "Beverages", "Thai"), (1230, "Fish", "Continental"), (77, "Curry", "Indian"),
         (2664, "Soup", "Italian")], "meal_id BIGINT, category STRING, cuisine STRING")
    centers = spark.createDataFrame(
        [(55, 647, 56, "TYPE_C", 2.0), (13, 590, 56, "TYPE_B", 6.7), (20, 522, 56, "TYPE_A", 4.0)],
        "center_id BIGINT, city_code INT, region_code INT, center_type STRING, op_area DOUBLE")
    fact = facts(spark, [  # week, meal, center, sold, prepared
        (4, 1885, 55, 100, 104), (5, 1885, 55, 350, 400), (5, 1230, 13, 351, 400),
        (6, 1230, 13, 99, 110), (6, 2664, 20, 50, 50),
    ])
    return Star(fact=fact, item=dimensions.build_food_item(meals),
                center=dimensions.build_center(centers),
                category=dimensions.build_category(meals), date=dimensions.build_date(spark))
