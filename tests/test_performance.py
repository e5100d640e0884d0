"""Hand-computed statistics: no drawdown, recovery, never recovered, uncovered windows, the two flavours."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from navloom.plans import performance as perf

DAYS = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8, 9)]


def panel(spark, **series):
    rows = [(k, d, float(v)) for k, values in series.items() for d, v in zip(DAYS, values)]
    return spark.createDataFrame(rows, "TICKER_SYMBOL string, END_DATE date, NAV double")


def test_panel_row(spark):
    df = panel(spark, up=[1, 2, 3, 4, 5, 6], dip=[10, 8, 10, 8, 9, 11], down=[10, 9, 8, 7, 6, 5])
    rows = {r["TICKER_SYMBOL"]: r for r in perf.window_stats(df).collect()}
    assert rows["up"]["MAXDD"] == 0 and rows["up"]["MAXDD_DATE"] is None and rows["up"]["CALMAR_RATIO_ANNUAL"] is None
    assert rows["dip"]["MAXDD"] == pytest.approx(20) and rows["dip"]["MAXDD_DATE"] == DAYS[3] and rows["dip"]["MAXDD_RECOVER"] == 4
    assert rows["down"]["MAXDD_RECOVER"] == perf.NEVER_RECOVERED and rows["down"]["CUM_RETURN"] == pytest.approx(-50)
    assert rows["up"]["OPERATION_DAYS"] == (DAYS[-1] - DAYS[1]).days + 1


def test_classic_takes_the_first_drawdown(spark):
    r = perf.classic_stats(panel(spark, dip=[10, 8, 10, 8, 9, 11])).first()
    assert r["MAXDD_DATE"] == DAYS[1] and r["MAXDD_RECOVER"] == 1


def test_strict_coverage_drops_partial_histories(spark):
    df = panel(spark, full=[1, 2, 3, 4, 5, 6]).union(panel(spark, late=[0, 2, 3, 4, 5, 6]).where("END_DATE > DATE '2024-01-02'"))
    windows = spark.createDataFrame([(DAYS[0], DAYS[-1])], "START_DATE date, END_DATE date")
    assert [r[0] for r in perf.window_stats(df, windows).select("TICKER_SYMBOL").collect()] == ["full"]
    assert perf.window_stats(df, windows, strict=False).count() == 2


def test_one_point_has_no_annual_return(spark):
    r = perf.window_stats(panel(spark, a=[3])).first()
    assert r["CUM_RETURN"] == 0 and r["ANNUAL_RETURN"] is None and r["VOLATILITY"] is None


def test_timing_model_recovers_its_coefficients(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(0, 0.01, 200)
    rf = 0.03 / 252
    y = 0.0002 + 0.8 * (x - rf) + 3.0 * (x - rf) ** 2 + rf
    days = pd.bdate_range("2023-01-02", periods=201).date
    pdf = pd.DataFrame({"TICKER_SYMBOL": "f", "END_DATE": days, "NAV": np.concatenate([[1.0], np.cumprod(1 + y)]), "BENCH_NAV": np.concatenate([[1.0], np.cumprod(1 + x)])})
    r = perf.timing_models(spark.createDataFrame(pdf)).first()
    assert r["QUAD_TIMING"] == pytest.approx(3.0, rel=1e-6) and r["QUAD_ALPHA"] == pytest.approx(1.0002**252 - 1, rel=1e-6)


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("classic", [True, False])
def test_scans_and_segments_agree(spark, monkeypatch, strict, classic):
    """Sparse days, missing and repeated values, windows inside a month, across months and beyond the panel; against slices too."""
    import random

    rng = random.Random(5)
    first = dt.date(2023, 11, 20)
    rows = []
    for k, chance in (("a", 0.9), ("b", 0.3), ("c", 0.05), ("d", 0.6)):
        rows += [(k, first + dt.timedelta(days=d), rng.choice([None, 8.0, 9.0, 10.0, 11.0, 12.0, 10.5])) for d in range(200) if rng.random() < chance]
    df = spark.createDataFrame(rows, "TICKER_SYMBOL string, END_DATE date, NAV double")
    ends = [(first + dt.timedelta(days=a), first + dt.timedelta(days=b)) for a, b in (sorted(rng.sample(range(-30, 230), 2)) for _ in range(80))]
    own = [r[1] for r in rows if r[0] == "a"]
    windows = spark.createDataFrame(ends + [(own[a], own[b]) for a, b in (sorted(rng.sample(range(len(own)), 2)) for _ in range(60))], "START_DATE date, END_DATE date")
    scanned = _by_window(perf.window_rows(df, windows, strict, classic))
    monkeypatch.setattr(perf, "SPANS", 0)
    merged = _by_window(perf.window_rows(df, windows, strict, classic))
    assert len(scanned) > 50 and scanned.keys() == merged.keys()
    for key, row in scanned.items():
        assert row == pytest.approx(merged[key], abs=1e-9), (key, row, merged[key])
        assert row[:2] + row[5:8] == _by_slices(rows, key, classic), key


def _by_window(rows):
    numbers = ["START_DATE", "LAST_DATE", "VOL", "FIRST_NAV", "LAST_NAV", "MDD", "MDD_DATE", "RECOVERY_DATE", "N_RET"]
    days = lambda v: v.toordinal() if isinstance(v, dt.date) else -1.0 if v is None else v
    return {(r.TICKER_SYMBOL, r.WIN_START, r.WIN_END): tuple(days(r[c]) for c in numbers) for r in rows.collect()}


def _by_slices(rows, key, classic):
    part = sorted((d, v) for k, d, v in rows if k == key[0] and key[1] <= d <= key[2])
    high, falls = None, []
    for d, v in part:
        if v is not None:
            high = v if high is None else max(high, v)
            falls.append((1 - v / high, d))
    deepest = max((f for f, _ in falls), default=None)
    hits = [d for f, d in falls if f == deepest] if deepest is not None and (classic or deepest != 0) else []
    day = (hits[0] if classic else hits[-1]) if hits else None
    back = next((d for f, d in falls if day and d > day and f == 0), None)
    number = lambda d: d.toordinal() if d else -1.0
    return (number(part[0][0]), number(part[-1][0]), -1.0 if deepest is None else deepest, number(day), number(back))


def test_named_benchmark_columns_travel_alone(spark, monkeypatch):
    from navloom.operators import segments

    df = panel(spark, a=[10, 8, 10, 8, 9, 11], b=[5, 6, 7, 6, 8, 9])
    df = df.join(df.groupBy("END_DATE").agg({"NAV": "avg"}).withColumnRenamed("avg(NAV)", "BENCH_NAV"), "END_DATE")
    windows = spark.createDataFrame([(DAYS[0], DAYS[-1]), (DAYS[1], DAYS[3])], "START_DATE date, END_DATE date")
    whole = perf.benchmark_stats(df, windows)
    key = ["TICKER_SYMBOL", "WIN_START", "WIN_END"]
    monkeypatch.setattr(segments, "spread", lambda *a: pytest.fail("the points were shuffled with all their sums"))
    for columns in (["UP_CAPTURE", "DOWN_CAPTURE"], ["STABILITY", "ALPHA_STABILITY"], ["ALPHA_MAXDD", "ALPHA_WIN_RATE", "BENCH_MAXDD", "IR"]):
        part = perf.benchmark_stats(df, windows, columns=columns)
        assert part.columns == key + columns
        got, want = (df.orderBy(key).toPandas() for df in (part, whole.select(part.columns)))
        pd.testing.assert_frame_equal(got, want, rtol=1e-9)
    assert perf.benchmark_stats(df, windows).count() == 4


@pytest.mark.parametrize("spans", [perf.SPANS, 0])
def test_user_metric_slices_windows(spark, monkeypatch, spans):
    """Days out of order or missing, windows that overlap, hold no day or end before they start; no row is multiplied."""
    monkeypatch.setattr(perf, "SPANS", spans)
    df = panel(spark, a=[1, 2, 4, 8, 16, 32], b=[3, 5, 3, 5, 3, 5]).orderBy("NAV", ascending=False)
    df = df.unionByName(spark.createDataFrame([("a", None, 99.0), (None, DAYS[1], None), ("b", DAYS[5] + dt.timedelta(1), None)], df.schema))
    first, second, late = (DAYS[0], DAYS[2]), (DAYS[1], DAYS[4]), (DAYS[4], dt.date(2024, 1, 31))
    windows = spark.createDataFrame([first, second, first, late, (DAYS[5], DAYS[0]), (dt.date(2024, 2, 1), dt.date(2024, 2, 9))], "START_DATE date, END_DATE date")

    def spread_days(days, values):
        known = values[values == values]
        return (days[-1] - days[0]) * 1000 + known[-1] - known[0] if len(known) else float("nan")

    found = perf.metric_per_window(df, windows, spread_days, "SPREAD")
    want = {("a", *first): 2003.0, ("a", *second): 5014.0, ("a", *late): 1016.0, ("b", *first): 2000.0, ("b", *second): 4998.0 + 0.0, ("b", *late): 2002.0, (None, *first): None, (None, *second): None}
    assert {(r[0], r[1], r[2]): r[3] for r in found.collect()} == want
    if spans:
        assert "Join" not in found._jdf.queryExecution().toString()
        assert perf.metric_per_window(df, windows.limit(0), spread_days, "SPREAD").count() == 0


def test_log_alpha_repeats_no_rows_before_its_sums(spark):
    from navloom.plans.alpha import log_alpha

    rows = [(f, d, r) for f, rs in {"a": (1.0, 2.0), "b": (3.0, 4.0), "c": (5.0, 9.0)}.items() for d, r in zip(DAYS, rs)]
    ret = spark.createDataFrame(rows, "TICKER_SYMBOL string, END_DATE date, RETURN_RATE double")
    types = spark.createDataFrame([("a", "x", "p"), ("b", "x", None), ("c", "y", "p")], "TICKER_SYMBOL string, L1 string, L2 string")
    found = log_alpha(ret, types, ["L1", "L2"])
    got = {(r.TICKER_SYMBOL, r.END_DATE, r.LEVEL): (r.LOG_ALPHA, r.CUM_ALPHA) for r in found.collect()}
    import math

    log = lambda x: 100 * math.log1p(x / 100)
    assert len(got) == 12 and got["a", DAYS[1], "L1"] == pytest.approx((log(2) - log(3), log(1) - log(2) + log(2) - log(3)))
    assert got["b", DAYS[1], "L2"] == pytest.approx((log(4), log(3) + log(4))) and got["c", DAYS[0], "L2"][0] == pytest.approx(log(5) - log(3))
    assert "Expand" not in found._jdf.queryExecution().toString()


def test_rolling_horizons_repeat_no_rows(spark):
    df = panel(spark, a=[1, 2, 1, 4, 2, 8], b=[5, 5, 5, 5, 5, 5]).orderBy("NAV").union(panel(spark, c=[3]))
    found = perf.rolling_horizons(df, {2: "two", 5: "five"})
    rows = {(r[0], r[1]): tuple(r)[2:] for r in found.collect()}
    assert rows["a", "two"] == pytest.approx((0.75, 1.0, 1.0, 0.75)) and rows["a", "five"] == pytest.approx((7.0, 7.0, 7.0, 1.0))
    assert rows["b", "two"] == (0.0, 0.0, 0.0, 0.0) and rows["c", "two"] == rows["c", "five"] == (None,) * 4
    assert "Expand" not in found._jdf.queryExecution().toString() and "percentile" not in found._jdf.queryExecution().toString()


def test_scans_make_plain_arrays(spark):
    """A fund's windows are numpy columns; missing days become nulls in Spark, not in a frame for each fund."""
    import numpy as np

    days, nav = np.arange(4, dtype=np.int64), np.array([1.0, 2.0, 1.5, np.nan])
    out = perf._scanned(days, nav, np.array([[0, 2], [0, 0]], dtype=np.int64), True, False)
    assert isinstance(out, dict) and {a.dtype.kind for a in out.values()} <= {"i", "f"}
    assert out["FALL_DAY"].tolist()[0] == 2 and out["FALL_BACK"].tolist()[0] == perf.NO_DAY and out["SECOND_DATE"].tolist() == [1, perf.NO_DAY]


def test_product_sheet_scans_only_the_windows_of_its_date(spark, sf_dir, monkeypatch):
    from navloom import catalog

    ends, real = [], perf.window_stats
    monkeypatch.setattr(perf, "window_stats", lambda nav, windows: ends.append(windows.select("END_DATE").distinct().count()) or real(nav, windows))
    catalog.queries()["m25_product_sheet"](spark, sf_dir)
    assert ends == [1]


def test_benchmark_points_are_sorted_once(spark):
    plan = perf.pair_points(panel(spark, a=[1, 2]).withColumn("BENCH_NAV", perf.F.lit(1.0)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_days_outside_short_windows_do_not_travel(spark):
    """Windows inside one month: the days lie by entity, and only those of months with such a window meet them by month."""
    days = pd.bdate_range("2024-01-01", "2024-04-30").date
    panel = pd.concat([pd.DataFrame({"TICKER_SYMBOL": t, "END_DATE": days, "NAV": np.random.default_rng(k).uniform(1, 2, len(days))}) for k, t in enumerate("ab")])
    panel["BENCH_NAV"] = panel["NAV"] * 0.5 + 1
    spans = [("2024-02-05", "2024-02-20"), ("2024-01-10", "2024-04-02"), ("2024-03-01", "2024-03-29")]
    windows = spark.createDataFrame([(pd.Timestamp(a).date(), pd.Timestamp(b).date()) for a, b in spans], "START_DATE date, END_DATE date")
    columns = ["BENCH_MAXDD", "ALPHA_MAXDD", "STABILITY"]
    ask = lambda: perf.benchmark_stats(spark.createDataFrame(panel).repartition(8, "TICKER_SYMBOL"), windows, columns=columns)
    rows = lambda df: sorted((*r[:3], *[round(v, 9) for v in r[3:]]) for r in df.collect())
    want = rows(ask())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ask()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert rows(out) == want and len(want) == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "array_contains(_MONTHS" in plan
