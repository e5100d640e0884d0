"""Rank operators: the blocked path gives what the plain window and pandas give, also with one hot group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from navloom.operators import ranks


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    group = np.where(rng.random(n) < 0.4, "hot", np.char.add("g", rng.integers(0, 20, n).astype(str)))
    value = rng.integers(0, 400, n).astype(float)
    pdf = pd.DataFrame({"g": group, "v": value, "id": np.arange(n)})
    pdf.loc[rng.random(n) < 0.05, "v"] = np.nan
    pdf = pd.concat([pdf, pd.DataFrame({"g": ["lone"], "v": [1.0], "id": [n]})], ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return pdf, df


def collected(df, out):
    return df.select("id", out).toPandas().set_index("id")[out].sort_index()


@pytest.mark.parametrize("block_rows", [10**6, 50])
def test_percent_rank_mean_tie(skewed, block_rows):
    pdf, df = skewed
    got = collected(ranks.rank_pct(df, "v", ["g"], "r", block_rows=block_rows), "r")
    g = pdf.groupby("g")["v"]
    want = 100 * (np.floor(g.rank(ascending=False)) - 1) / (g.transform("count") - 1).replace(0, np.nan)
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float))


@pytest.mark.parametrize("block_rows", [10**6, 50])
def test_fraction_and_rows(skewed, block_rows):
    pdf, df = skewed
    got = collected(ranks.rank_fraction(df, "v", ["g"], "r", block_rows=block_rows), "r")
    np.testing.assert_allclose(got.to_numpy(float), pdf.groupby("g")["v"].rank(pct=True).to_numpy(float))
    rn = collected(ranks.row_numbers(df.where("v IS NOT NULL"), ["g"], [F.col("v"), F.col("id")], "r", block_rows=block_rows), "r")
    kept = pdf.dropna().sort_values(["g", "v", "id"])
    want = (kept.groupby("g").cumcount() + 1).set_axis(kept["id"]).sort_index()
    np.testing.assert_array_equal(rn.to_numpy(), want.to_numpy())


@pytest.mark.parametrize("block_rows", [10**6, 50])
def test_sql_percent_rank_counts_nulls(skewed, block_rows):
    pdf, df = skewed
    got = collected(ranks.percent_rank(df, "v", ["g"], "r", block_rows=block_rows), "r")
    filled = pdf["v"].fillna(-1)
    g = filled.groupby(pdf["g"])
    want = ((g.rank(method="min") - 1) / (g.transform("size") - 1).replace(0, np.nan)).fillna(0)
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float))


@pytest.mark.parametrize("block_rows", [10**6, 50])
def test_ntile_matches_sql(spark, skewed, block_rows):
    _, df = skewed
    kept = df.where("v IS NOT NULL")
    got = collected(ranks.ntile(kept, 10, ["g"], [F.col("v"), F.col("id")], "r", block_rows=block_rows), "r")
    want = collected(kept.selectExpr("id", "ntile(10) OVER (PARTITION BY g ORDER BY v, id) AS r"), "r")
    np.testing.assert_array_equal(got.to_numpy(), want.to_numpy())


@pytest.mark.parametrize("block_rows", [10**6, 50])
def test_quantiles(skewed, block_rows):
    pdf, df = skewed
    got = ranks.quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.9}, block_rows=block_rows).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["v"].quantile([0.25, 0.5, 0.9]).unstack().sort_index()
    np.testing.assert_allclose(got[["a", "b", "c"]].to_numpy(), want.to_numpy())


def test_one_value_may_fill_a_hot_group(spark):
    df = spark.range(2000).select(F.lit("hot").alias("g"), F.when(F.col("id") < 1500, 1.0).otherwise(F.col("id").cast("double")).alias("v"), "id")
    out = ranks.rank_fraction(df, "v", ["g"], "r", block_rows=100)
    assert out.where("v = 1.0").select("r").distinct().collect()[0][0] == pytest.approx(1501 / 2 / 2000)
    assert out.count() == 2000


def test_quantile_groups_are_equal_sized_and_small_groups_are_one(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(20)] + [("b", 1.0), ("b", 2.0)], "g string, v double")
    out = ranks.quantile_group(df, 5, ["g"], [F.col("v")], "q").groupBy("g", "q").count().collect()
    assert {(r["g"], r["q"]): r["count"] for r in out} == {("a", 1): 4, ("a", 2): 4, ("a", 3): 4, ("a", 4): 4, ("a", 5): 4, ("b", 1): 2}


@pytest.mark.parametrize("block_rows", [1_000_000, 5])
def test_quantiles_keep_null_groups_and_weigh_alike(spark, block_rows):
    rows = [(None, float(k * k % 37) / 7) for k in range(41)] + [("a", float(k)) for k in range(10)] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = ranks.quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.37, "q3": 0.9}, [F.count("v").alias("n")], block_rows=block_rows).collect()
    want = df.where("v IS NOT NULL").groupBy("g").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.37).alias("q2"), F.percentile("v", 0.9).alias("q3"), F.count("v").alias("n")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 2


def test_rolling_ranks_equal_slices_and_take_little_time(spark):
    import random
    import time

    import numpy as np

    rng = random.Random(4)
    values = [rng.choice([None, *range(30)]) if k % 7 else rng.random() * 30 for k in range(600)]
    rows = [("a", k, v) for k, v in enumerate(values)] + [("b", k, float(k % 5)) for k in range(40)]
    df = spark.createDataFrame([(t, k, None if v is None else float(v)) for t, k, v in rows], "t string, d int, v double").repartition(3)
    for down in (True, False):
        got = {(r.t, r.d): r.R for r in ranks.rolling_ranks(df, {"v": "R"}, ["t"], "d", 25, down).collect()}
        assert len(got) == len(rows)
        for t, k, v in rows:
            part = [x for name, j, x in rows if name == t and k - 25 < j <= k]
            if len(part) < 25 or None in part:
                assert got[t, k] is None
            else:
                ahead, ties = sum(x > v if down else x < v for x in part), part.count(v)
                assert got[t, k] == (ahead + (ties + 1) / 2) / 25
    days = np.random.default_rng(1).normal(size=20_000)
    started = time.perf_counter()
    out = ranks.rolling_rank(days, 850, True)
    assert time.perf_counter() - started < 2 and np.isnan(out[:849]).all() and out[-1] == ((days[-850:] > days[-1]).sum() + 1) / 850
