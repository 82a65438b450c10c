"""Queries with SQL against DuckDB."""

import pytest

from larder.llm.queries import ORACLE, QUERIES
from llm_small import SF_DIR
from oracle_check import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_names_are_the_operators_numbers():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
