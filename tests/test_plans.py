"""What the plans of some queries must not do at size."""

import pytest

from navloom import catalog
from navloom.operators import joins


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_codes_travel_to_the_rows(spark, monkeypatch):
    """No row is shuffled by a code: a few codes would be a few tasks; a dictionary beyond the bound is joined as Spark likes."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "C")], "id long, CODE_A string")
        words = spark.createDataFrame([("X", "A", "first"), ("X", "B", "second"), ("Y", "A", "other")], "CATEGORY string, CODE string, TEXT string")
        found = joins.decode(rows, words.distinct(), {"CODE_A": "X"})
        assert "Exchange hashpartitioning(CODE_A" not in found._jdf.queryExecution().executedPlan().toString()
        want = [(1, "first"), (2, "second"), (3, None), (4, None)]
        assert sorted((r.id, r.CODE_A_TEXT) for r in found.collect()) == want
        monkeypatch.setattr(joins, "broadcast_checked", lambda df: None)
        assert sorted((r.id, r.CODE_A_TEXT) for r in joins.decode(rows, words, {"CODE_A": "X"}).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["l16_factor_exposure", "n06_excess_ir_drawdown"])
def test_holdings_and_histories_are_formed_once(spark, sf_dir, name):
    """Beside the holdings, or the histories of the funds, only days or a mean by day are read off the line items."""
    assert optimized(catalog.queries()[name](spark, sf_dir)).count("Relation [l_orderkey") <= 2


def test_factor_days_travel_to_the_funds(spark, sf_dir):
    assert optimized(catalog.queries()["o05_unconstrained_ols"](spark, sf_dir)).count("strategy=broadcast") >= 4  # two of them are the last day of a calendar
