"""Every query with an SQL counterpart gives exactly the rows DuckDB gives."""

import pytest
from oracle_check import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert differences(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) == []


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())
    llm = {"pipeline"} | {name for name in queries() if name.startswith("op")}
    assert set(queries()) - set(oracle_sql()) <= llm


def test_entry_gives_one_row(spark):
    assert entry(spark).count() == 1
