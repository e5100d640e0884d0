"""Popularity of stocks: groupings asked for one by one, in blocks, and without storing the rows of all groupings."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from navloom.operators.packs import half_up
from navloom.plans import holdings as ho

DAY = dt.date(2024, 3, 31)


@pytest.fixture(scope="module")
def book(spark):
    held = [(DAY, f"f{k % 7}", f"s{k % 11}", "x" if k % 11 < 6 else "y", float(k % 5 + 1)) for k in range(60)]
    classes = [(f"f{k}", "AB"[k % 2], f"b{k % 3}", f"c{k}", None if k == 3 else f"m{k % 2}") for k in range(7)]
    return (
        spark.createDataFrame(held, "REPORT_DATE date, FUND_ID string, HOLDING_TICKER_SYMBOL string, INDUSTRY_NAME string, MARKET_VALUE double"),
        spark.createDataFrame(classes, "FUND_ID string, LEVEL_1 string, LEVEL_2 string, LEVEL_3 string, COMPANY string"),
    )


def _rows(df):
    return sorted(map(str, df.collect()))


def test_fitting_groups_are_not_stored(book, monkeypatch):
    monkeypatch.setattr(ho, "cut_lineage", lambda df: pytest.fail("the rows of all groupings were stored"))
    assert len({r["GROUP_SET"] for r in ho.popularity(*book).collect()}) == len(ho.POPULARITY_SETS)


def test_blocks_give_the_same_scores(book):
    whole = _rows(ho.popularity(*book))
    assert _rows(ho.popularity(*book, block_rows=3)) == whole and _rows(ho.popularity(*book, block_rows=20)) == whole


def test_one_grouping_alone(book):
    whole = ho.popularity(*book)
    assert _rows(ho.popularity(*book, sets=[["LEVEL_1"]])) == _rows(whole.where("GROUP_SET = 'LEVEL_1'"))
    held, classes = book
    assert _rows(ho.popularity(held, classes.where("LEVEL_1 = 'A'"), sets=[["LEVEL_1"]])) == _rows(whole.where("GROUP_SET = 'LEVEL_1' AND LEVEL_1 = 'A'"))


def test_rows_of_the_groupings_do_not_travel(book):
    plan = ho.popularity(*book)._jdf.queryExecution().executedPlan().toString()
    assert "_PACK" in plan and "Window" not in plan and "GROUP_SET" not in plan.split("Exchange", 1)[1]


def test_packed_and_native_scores_agree_on_odd_rows(spark, book):
    nan = float("nan")
    odd = [(DAY, "f1", "s1", None, 0.125), (DAY, "f1", None, "x", 2.675), (None, "f2", "s2", "x", 1e17), (DAY, "f3", "s3", "y", None), (DAY, "f4", "s4", "y", nan), (DAY, "f5", "s5", "y", nan), (DAY, "f5", "s5", "y", -1.005), (DAY, "f6", "s6", "x", -0.0), (DAY, "f0", "s6", "x", 0.0), (DAY, None, "s6", "x", 1.0), (DAY, "f2", "s8", "x", None)]
    held = book[0].union(spark.createDataFrame([*odd, *odd[:4]], book[0].schema))
    packed, native = (ho.popularity(held, book[1], block_rows=n) for n in (ho.GROUP_ROWS, 0))
    assert packed.dtypes == native.select(packed.columns).dtypes
    assert _rows(packed) == _rows(native.select(packed.columns))


def test_half_up_is_sparks_round(spark):
    x = [0.78125, 0.00105, 1.005, 2.675, -2.675, 1e15 + 0.3, 123456789.125, 0.285, 1.0 / 3, -0.0, 5e-5, 99.99995, float("inf")] + [k * 100 / 4480 for k in range(300)]
    for digits in (2, 4):
        want = [r[0] for r in spark.createDataFrame([(v,) for v in x], "v double").select(F.round("v", digits)).collect()]
        assert half_up(np.array(x), digits).tolist() == want


def test_crowding_weighs_scores_and_moves_a_holding_once(spark, book, monkeypatch):
    monkeypatch.setattr(ho, "spread", lambda df, *keys: df.repartition(3, *keys))
    held = book[0].union(spark.createDataFrame([(None, "f1", "s1", "x", 1.0), (DAY, "f1", None, "x", 1.0), (DAY, "f2", "s99", "x", 2.0)], book[0].schema))
    scores = spark.createDataFrame([(DAY, f"s{k}", 10.0 * k, None if k == 4 else float(k)) for k in range(6)] + [(None, "s1", 1.0, 1.0)], "REPORT_DATE date, HOLDING_TICKER_SYMBOL string, NUMBER_SCORE double, MARKET_VALUE_SCORE double")
    weigh = lambda df: df.dropna(subset=["REPORT_DATE", "FUND_ID"]).withColumn("RATIO_IN_NA", F.col("MARKET_VALUE") / F.sum("MARKET_VALUE").over(Window.partitionBy("REPORT_DATE", "FUND_ID")))
    known = {r["HOLDING_TICKER_SYMBOL"]: r for r in scores.collect() if r["REPORT_DATE"]}
    want = {}
    for fund in {r["FUND_ID"] for r in held.collect()}:
        mine = [(known[r["HOLDING_TICKER_SYMBOL"]], r["MARKET_VALUE"]) for r in held.collect() if r["FUND_ID"] == fund and r["REPORT_DATE"] and r["HOLDING_TICKER_SYMBOL"] in known]
        if mine:
            total = sum(v for _, v in mine)
            want[fund] = (sum((s["MARKET_VALUE_SCORE"] or 0) * v for s, v in mine) / total, sum(s["NUMBER_SCORE"] * v for s, v in mine) / total)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ho.crowding(held.repartition(3, "HOLDING_TICKER_SYMBOL"), scores, weigh)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["FUND_ID"]: (r["TOTAL_VALUE_SCORE"], r["NUMBER_SCORE"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    assert plan.count("Exchange") == 3 and plan.count("ENSURE_REQUIREMENTS") == 1  # by stock: holdings and scores; by fund: once
