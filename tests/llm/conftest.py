"""Small documents with every awkward case, and whole small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_small import AWKWARD, CLASHING, SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(AWKWARD, "doc_id bigint, text string")
    return rows.withColumns({c: F.lit("extra") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    from larder.llm.common import table

    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
