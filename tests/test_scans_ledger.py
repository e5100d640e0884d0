"""Blocked running totals and recurrences equal a sequential loop."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from navloom.operators.scans import linear_recurrence, numbered, running_total
from navloom.plans.ledger import positions


@pytest.mark.parametrize("block", [100_000, 7])
def test_recurrence_and_total(spark, block):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.choice(["hot", "a", "b"], 200, p=[0.6, 0.2, 0.2]), "t": np.arange(200), "m": rng.normal(0.9, 0.3, 200), "c": rng.normal(0, 1, 200)})
    rows = numbered(spark.createDataFrame(pdf), ["k"], [F.col("t")], block)
    rows = running_total(rows, ["k"], "c", "total")
    got = linear_recurrence(rows, ["k"], F.col("m"), F.col("c"), "x", block).toPandas().sort_values("t")
    state, sums, want, before, totals = {}, {}, [], [], []
    for r in pdf.itertuples():
        before.append(state.get(r.k, 0.0))
        state[r.k] = r.m * state.get(r.k, 0.0) + r.c
        sums[r.k] = sums.get(r.k, 0.0) + r.c
        want.append(state[r.k])
        totals.append(sums[r.k])
    np.testing.assert_allclose(got["x"], want, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["x_before"], before, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["total"], totals, rtol=1e-9, atol=1e-9)


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, k, 1.0) for k in range(40)] + [("a", k, 2.0) for k in range(40)], "k string, t int, c double")
    rows = running_total(numbered(df, ["k"], [F.col("t")], 7), ["k"], "c", "total")
    got = linear_recurrence(rows, ["k"], F.lit(1.0), F.col("c"), "x", 7).orderBy("k", "t").collect()
    assert [(r.k, r.total, r.x) for r in got] == [(None, k + 1.0, k + 1.0) for k in range(40)] + [("a", 2.0 * k + 2, 2.0 * k + 2) for k in range(40)]


def fold(pdf):
    out = []
    for _, g in pdf.sort_values(["date", "seq"]).groupby("ticker"):
        units = cost = 0.0
        for i, r in enumerate(g.itertuples()):
            value = round(r.quantity * r.price, 2)
            sold, u0, c0 = 0.0, units, cost
            if r.type == "Buy":
                units, cost = units + r.quantity, cost + value
            elif i:
                sold = r.quantity / u0 * c0 if u0 else 0.0
                units, cost = units - r.quantity, cost - sold
            out.append((r.seq, u0, units, c0, cost, sold))
    return pd.DataFrame(out, columns=["seq", "prev_units", "cml_units", "prev_cost", "cml_cost", "cost_transact"]).sort_values("seq")


@pytest.mark.parametrize("block", [100_000, 5])
def test_positions_equal_a_trade_by_trade_fold(spark, block):
    rng = np.random.default_rng(5)
    n = 120
    pdf = pd.DataFrame({
        "seq": np.arange(n), "date": pd.to_datetime("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 30, n)), "D"), "type": rng.choice(["Buy", "Sell"], n, p=[0.7, 0.3]),
        "ticker": rng.choice(["hot", "x"], n, p=[0.7, 0.3]), "quantity": rng.integers(10, 90, n).astype(float), "price": rng.integers(100, 900, n) / 4,
    })
    pdf.loc[pdf["type"] == "Sell", "quantity"] = (pdf["quantity"] // 10)
    df = spark.createDataFrame(pdf).withColumn("date", F.to_date("date"))
    got = positions(df, block).toPandas().sort_values("seq")
    want = fold(pdf)
    for c in want.columns:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), atol=2e-4)


def test_sale_before_purchase_costs_nothing(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "Sell", "t", 5.0, 10.0), (2, "2024-01-02", "Buy", "t", 10.0, 4.0), (3, "2024-01-03", "Sell", "t", 5.0, 6.0)], "seq long, date string, type string, ticker string, quantity double, price double")
    rows = positions(df.withColumn("date", F.to_date("date"))).orderBy("seq").collect()
    assert [r["cml_units"] for r in rows] == [0.0, 10.0, 5.0]
    assert rows[0]["cost_transact"] == 0.0 and rows[2]["cost_transact"] == 20.0 and rows[2]["gain_loss"] == 10.0


def test_a_long_recurrence_takes_time_in_proportion(spark):
    """One ticker of 2,000 to 200,000 rows."""
    import time

    spent = {}
    for n in (2_000, 20_000, 200_000):
        rows = spark.range(n).select(F.lit("t").alias("k"), F.col("id").alias("t"), (F.col("id") + 1).alias("RN"))
        started = time.perf_counter()
        last = linear_recurrence(rows, ["k"], F.lit(1.0), F.lit(1.0), "x").agg(F.max("x"), F.sum("x"), F.count("x")).first()
        spent[n] = time.perf_counter() - started
        assert tuple(last) == (n, n * (n + 1) / 2, n)
    assert spent[200_000] < 12 * spent[20_000] + 2
