"""Every registered query against its oracle in DuckDB on the smallest test tables."""

import os
import sys
import time

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from check import TABLES, compare
from navloom import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    assert name in ORACLES
    ok, why, *_ = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name], name, time.time())
    assert ok, why


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
