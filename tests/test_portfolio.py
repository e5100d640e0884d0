"""Closed-form weight drift equals the day-by-day rule."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from navloom.operators.joins import band_join, densify, fan_out
from navloom.plans import portfolio as pf
from navloom.plans import risk as rk


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(11)
    days = pd.bdate_range("2024-01-01", periods=15)
    rets = pd.DataFrame([(t, d, rng.normal(0, 2)) for t in "ABC" for d in days if not (t == "B" and d == days[4])], columns=["TICKER_SYMBOL", "TRADE_DT", "RETURN_RATE"])
    targets = pd.DataFrame([("P", days[0], "A", 60.0), ("P", days[0], "B", 40.0), ("P", days[7], "B", 30.0), ("P", days[7], "C", 70.0), ("Q", days[3], "A", 100.0)], columns=["PORTFOLIO_NAME", "TRADE_DT", "TICKER_SYMBOL", "WEIGHT"])
    cal = pd.DataFrame({"TRADE_DT": days})
    frames = [spark.createDataFrame(p).withColumn("TRADE_DT", F.to_date("TRADE_DT")) for p in (targets, rets, cal)]
    return targets, rets, days, frames


def test_drift_equals_daily_loop(small):
    targets, rets, days, (t, r, c) = small
    got = pf.drifted_weights(t, r, c).toPandas()
    want = []
    for p, mine in targets.groupby("PORTFOLIO_NAME"):
        held = {}
        for d in days:
            new = mine[mine["TRADE_DT"] == d]
            if len(new):
                held = dict(zip(new["TICKER_SYMBOL"], new["WEIGHT"]))
            rate = {x.TICKER_SYMBOL: x.RETURN_RATE for x in rets[rets["TRADE_DT"] == d].itertuples()}
            grown = {k: w * (1 + rate.get(k, 0.0) / 100) for k, w in held.items()}
            total = sum(grown.values())
            for k, w in held.items():
                want.append((p, d.date(), k, w, grown[k] / total * 100))
            held = {k: v / total * 100 for k, v in grown.items()}
    want = pd.DataFrame(want, columns=["PORTFOLIO_NAME", "TRADE_DT", "TICKER_SYMBOL", "S", "E"])
    both = got.merge(want, on=["PORTFOLIO_NAME", "TRADE_DT", "TICKER_SYMBOL"])
    assert len(both) == len(want) == len(got)
    np.testing.assert_allclose(both["START_WEIGHT"], both["S"])
    np.testing.assert_allclose(both["END_WEIGHT"], both["E"])


def test_end_weights_sum_to_hundred_and_contributions_roll_up(small):
    *_, (t, r, c) = small
    weights = pf.drifted_weights(t, r, c)
    sums = [x[0] for x in weights.groupBy("PORTFOLIO_NAME", "TRADE_DT").agg(F.sum("END_WEIGHT")).select("sum(END_WEIGHT)").collect()]
    np.testing.assert_allclose(sums, 100.0)
    linked = pf.linked_contribution(pf.period_contribution(weights), ["PERIOD_RETURN_CONTRIBUTION"])
    classes = linked.select("TICKER_SYMBOL").distinct().withColumn("CLASS", F.lit("c"))
    rolled = pf.contribution_rollup(linked, classes, ["PERIOD_RETURN_CONTRIBUTION"]).toPandas()
    for _, g in rolled.groupby("PORTFOLIO_NAME"):
        total = g[(g["CLASS"] == "ALL")]["PERIOD_RETURN_CONTRIBUTION"].iloc[0]
        assert total == pytest.approx(g[g["TICKER_SYMBOL"] != "ALL"]["PERIOD_RETURN_CONTRIBUTION"].sum())


def test_weight_sum_check_fails_with_note(spark):
    h = spark.createDataFrame([("P", "A", 60.0), ("P", "B", 39.0), ("Q", "A", 100.0)], "PORTFOLIO_NAME string, TICKER_SYMBOL string, WEIGHT double")
    out = {r["PORTFOLIO_NAME"]: (r["RESULT"], r["NOTE"]) for r in rk.check_weight_sum(h).collect()}
    assert out["P"][0] == "失败" and out["P"][1] and out["Q"] == ("通过", None)


def test_band_join_takes_wide_open_and_odd_bands(spark):
    inf, nan = float("inf"), float("nan")
    values = [k / 2 for k in range(-8, 60)] + [1e12, -1e12, None, nan]
    rows = [(0.0, 4.5, "low"), (5.0, 12.0, "mid"), (11.0, 12.0, "both"), (20.0, inf, "open"), (-inf, -3.0, "below"), (-1e15, 1e15, "wide"), (None, 3.0, "none"), (nan, 3.0, "nan"), (9.0, 8.0, "empty")]
    rows += [(30 + k / 100, 30 + k / 100, f"p{k}") for k in range(3000)]
    found = band_join(spark.createDataFrame([(v,) for v in values], "x double"), spark.createDataFrame(rows, "MIN double, MAX double, LEVEL string"), "x").collect()
    want = []
    for v in values:
        hits = [n for a, b, n in rows if v is not None and v == v and a is not None and a == a and a <= v <= b]
        want += [(v, n) for n in hits] or [(v, None)]
    assert sorted(map(str, ((r["x"], r["LEVEL"]) for r in found))) == sorted(map(str, want))


def test_fan_out_takes_many_windows(spark, monkeypatch):
    import navloom.operators.joins as j

    days = pd.date_range("2024-01-01", "2024-04-30")
    panel = spark.createDataFrame(pd.DataFrame({"TICKER_SYMBOL": "t", "END_DATE": days.date, "NAV": 1.0}))
    spans = pd.DataFrame({"START_DATE": pd.to_datetime(["2024-01-10", "2024-02-29", "2024-03-05"]).date, "END_DATE": pd.to_datetime(["2024-03-05", "2024-03-01", "2024-01-01"]).date})
    windows = spark.createDataFrame(spans)
    out = fan_out(panel, windows)
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
    a = out.groupBy("WIN_START", "WIN_END").count().orderBy("WIN_START").collect()
    monkeypatch.setattr(j, "pin_small", lambda *_: None)
    b = fan_out(panel, windows).groupBy("WIN_START", "WIN_END").count().orderBy("WIN_START").collect()
    assert a == b and [r["count"] for r in a] == [56, 2]


def test_covariance_of_many_entities(spark):
    import numpy as np

    from navloom.operators.aggregates import annualised_covariance

    rng = np.random.default_rng(1)
    x = rng.normal(size=(6, 700))
    rows = [(f"e{k}", d, float(x[d, k])) for d in range(6) for k in range(700)] + [("e1", 9, 1.0), (None, 1, 2.0)]
    out = annualised_covariance(spark.createDataFrame(rows, "k string, d int, v double"), "k", "d", "v", 1).toPandas()
    assert len(out) == 700 * 700
    full = np.cov(x.T)
    got = np.empty((700, 700))
    got[out["A"].str[1:].astype(int), out["B"].str[1:].astype(int)] = out["COV"]
    np.testing.assert_allclose(got, full, atol=1e-10)


def test_densify_carries_values_to_the_last_day(spark):
    days = spark.createDataFrame(pd.DataFrame({"TRADE_DT": pd.bdate_range("2024-01-01", "2024-01-10").date}))
    panel = spark.createDataFrame(pd.DataFrame({"k": ["a", "a", "b", "a"], "d": pd.to_datetime(["2024-01-02", "2024-01-05", "2024-01-09", "2024-01-06"]).date, "v": [1.0, 2.0, 3.0, 9.0]}))
    rows = densify(panel, days, "k", "d", "v").orderBy("k", "d").collect()
    assert [(r["k"], r["d"].day, r["v"]) for r in rows] == [("a", 2, 1.0), ("a", 3, 1.0), ("a", 4, 1.0), ("a", 5, 2.0), ("a", 8, 2.0), ("a", 9, 2.0), ("a", 10, 2.0), ("b", 9, 3.0), ("b", 10, 3.0)]
