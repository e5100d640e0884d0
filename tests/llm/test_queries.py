"""Every registered query with SQL against DuckDB, the others against what their modules' tests state."""

import time

import duckdb
import pytest

from check import TABLES, compare
from navloom.llm import queries as llm


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_oracle(spark, con, sf_dir, name):
    ok, why, *_ = compare(llm.queries()[name](spark, sf_dir), con, llm.oracle_sql()[name], name, time.time())
    assert ok, why


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 14))
