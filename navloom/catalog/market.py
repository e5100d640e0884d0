"""Bars, regressions and streaming jobs."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.functions.exprs import arg_max
from navloom.functions.series import by, daily_return
from navloom.operators import bars
from navloom.operators import regression as reg
from navloom.operators.calendars import trading_index
from navloom.operators.joins import densify
from navloom.session import shared_dir
from navloom.sources import fixtures as fx
from navloom.sources.ingest import read_dataset
from navloom.streaming import jobs

T, D = "TICKER_SYMBOL", "END_DATE"

# --- bars ---


def bar_view(minutes: int, src: str = "fx_min") -> str:
    end = f"time_bucket(INTERVAL {minutes} MINUTE, trade_time - INTERVAL 1 MICROSECOND) + INTERVAL {minutes} MINUTE"
    return f"SELECT code, {end} AS trade_time, arg_min(open, trade_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, trade_time) AS close, sum(turnover) AS turnover, sum(amount) AS amount FROM {src} GROUP BY 1, 2"


BARS = {
    "fx_min": "SELECT code, time_bucket(INTERVAL 1 MINUTE, trade_time - INTERVAL 1 MICROSECOND) + INTERVAL 1 MINUTE AS trade_time, arg_min(price, (trade_time, seq)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (trade_time, seq)) AS close, CAST(count(*) AS DOUBLE) AS turnover, sum(amount) AS amount FROM fx_ticks GROUP BY 1, 2",
    "fx_30": bar_view(30),
    "fx_hours": "SELECT code, max(trade_time) AS trade_time, arg_min(open, trade_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, trade_time) AS close, sum(turnover) AS turnover, sum(amount) AS amount FROM (SELECT *, (row_number() OVER (PARTITION BY code ORDER BY trade_time) - 1) // 2 AS G FROM fx_30) t GROUP BY code, G",
}
_BAR = "code, trade_time, open, high, low, close, turnover, round(amount, 4) AS amount"


def minute_bars(spark, sf):
    return bars.tick_bars(fx.view(spark, sf, "fx_ticks"), 1)


def _bar(df):
    return df.select("code", "trade_time", "open", "high", "low", "close", "turnover", F.round("amount", 4).alias("amount"))


@register("p01_minute_bars", f"SELECT {_BAR} FROM fx_min", BARS)
def p01_minute_bars(spark, sf):
    return _bar(minute_bars(spark, sf))


def _interval(n):
    @register(f"p01_bars_{n}min", f"SELECT {_BAR} FROM ({bar_view(n)}) b", BARS)
    def query(spark, sf):
        return _bar(bars.resample(minute_bars(spark, sf), f"{n}min"))


for _n in (5, 15, 30):
    _interval(_n)


@register("p02_bars_60min", f"SELECT {_BAR} FROM fx_hours", BARS)
def p02_bars_60min(spark, sf):
    return _bar(bars.resample(minute_bars(spark, sf), "60min"))


@register("p03_daily_bars", "SELECT code, CAST(trade_time AS DATE) AS trade_date, arg_min(open, trade_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, trade_time) AS close, sum(turnover) AS turnover, round(sum(amount), 4) AS amount FROM fx_min GROUP BY 1, 2", BARS)
def p03_daily_bars(spark, sf):
    return bars.resample(minute_bars(spark, sf), "day").withColumn("amount", F.round("amount", 4))


@register("p04_complete_sessions", "SELECT code, count(*) AS N FROM fx_min WHERE code IN (SELECT code FROM fx_min GROUP BY 1 HAVING count(*) % 2 = 0) GROUP BY 1", BARS)
def p04_complete_sessions(spark, sf):
    return bars.complete_sessions(minute_bars(spark, sf), rows=2).groupBy("code").agg(F.count(F.lit(1)).alias("N"))


# --- regressions ---

FACTORS = ["LARGE_GROWTH", "LARGE_VALUE", "MID_GROWTH", "MID_VALUE", "SMALL_GROWTH", "SMALL_VALUE", "CASH"]
_IDX = {f: f"S{i}" for i, f in enumerate(FACTORS)}
REG = {
    "fx_id": "SELECT s.TICKER_SYMBOL, d.TRADE_DT AS END_DATE, n.ADJ_NAV FROM (SELECT DISTINCT TICKER_SYMBOL FROM fx_nav_long) s CROSS JOIN fx_trading d ASOF JOIN (SELECT n.* FROM fx_nav_long n JOIN fx_trading t ON t.TRADE_DT = n.END_DATE) n ON n.TICKER_SYMBOL = s.TICKER_SYMBOL AND n.END_DATE <= d.TRADE_DT",
    "fx_ir": "SELECT TICKER_SYMBOL, END_DATE, X / lag(X) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1 AS R FROM (SELECT TICKER_SYMBOL, END_DATE, 100 + 20 * ADJ_NAV / (ADJ_NAV + 200) AS X FROM fx_id) t",
    "fx_xs": "SELECT END_DATE, " + ", ".join(f"max(R) FILTER (WHERE TICKER_SYMBOL = '{s}') AS {f}" for f, s in _IDX.items()) + " FROM fx_ir GROUP BY 1",
    "fx_regp": "SELECT f.TICKER_SYMBOL, f.END_DATE, f.RETURN_RATE / 100 AS RET, " + ", ".join(FACTORS) + " FROM fx_fund_ret f JOIN fx_xs x USING (END_DATE) WHERE RETURN_RATE IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in FACTORS),
"fx_rm": "SELECT *, IDX - lag(IDX, 59) OVER w AS GAP, lag(END_DATE, 59) OVER w AS WIN_START FROM fx_regp JOIN fx_trading ON TRADE_DT = END_DATE WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)",
    # three assets with weights that sum to one are two free ones, U and V, in a triangle: the optimum lies inside or on an edge
    "fx_qp": "SELECT * FROM (SELECT TICKER_SYMBOL, END_DATE AS WIN_END, WIN_START, GAP, var_pop(LARGE_GROWTH - CASH) OVER f AS A11, covar_pop(LARGE_GROWTH - CASH, SMALL_VALUE - CASH) OVER f AS A12, var_pop(SMALL_VALUE - CASH) OVER f AS A22, covar_pop(LARGE_GROWTH - CASH, RET - CASH) OVER f AS B1, covar_pop(SMALL_VALUE - CASH, RET - CASH) OVER f AS B2, avg(RET) OVER f AS MY, avg(LARGE_GROWTH) OVER f AS M1, avg(SMALL_VALUE) OVER f AS M2, avg(CASH) OVER f AS M3, var_pop(RET) OVER f AS YY, covar_pop(RET, LARGE_GROWTH) OVER f AS Y1, covar_pop(RET, SMALL_VALUE) OVER f AS Y2, covar_pop(RET, CASH) OVER f AS Y3, var_pop(LARGE_GROWTH) OVER f AS G11, var_pop(SMALL_VALUE) OVER f AS G22, var_pop(CASH) OVER f AS G33, covar_pop(LARGE_GROWTH, SMALL_VALUE) OVER f AS G12, covar_pop(LARGE_GROWTH, CASH) OVER f AS G13, covar_pop(SMALL_VALUE, CASH) OVER f AS G23 FROM fx_rm WINDOW f AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS 59 PRECEDING)) m WHERE GAP = 59",
    "fx_edges": "SELECT m.*, greatest(0, least(0.95, B1 / A11)) AS E1, greatest(0, least(0.95, B2 / A22)) AS E2, greatest(0, least(0.95, (B1 - B2 + 0.95 * (A22 - A12)) / (A11 - 2 * A12 + A22))) AS E3, (B1 * A22 - B2 * A12) / (A11 * A22 - A12 * A12) AS I1, (A11 * B2 - A12 * B1) / (A11 * A22 - A12 * A12) AS I2 FROM fx_qp m",
    "fx_points": "SELECT e.*, unnest([{'U': E1, 'V': 0.0::DOUBLE}, {'U': 0.0::DOUBLE, 'V': E2}, {'U': E3, 'V': 0.95 - E3}, {'U': I1, 'V': I2}]) AS P FROM fx_edges e",
    "fx_best": "SELECT TICKER_SYMBOL, WIN_START, WIN_END, arg_min(P.U, J) AS U, arg_min(P.V, J) AS V, any_value(MY) AS MY, any_value(M1) AS M1, any_value(M2) AS M2, any_value(M3) AS M3, any_value(YY) AS YY, any_value(Y1) AS Y1, any_value(Y2) AS Y2, any_value(Y3) AS Y3, any_value(G11) AS G11, any_value(G22) AS G22, any_value(G33) AS G33, any_value(G12) AS G12, any_value(G13) AS G13, any_value(G23) AS G23 FROM (SELECT *, (A11 * P.U * P.U + 2 * A12 * P.U * P.V + A22 * P.V * P.V) / 2 - B1 * P.U - B2 * P.V AS J FROM fx_points WHERE P.U >= 0 AND P.V >= 0 AND P.U + P.V <= 0.95 + 1e-12) q GROUP BY 1, 2, 3",
    "fx_fit": "SELECT *, 1 - U - V AS W, U * U * G11 + V * V * G22 + (1 - U - V) * (1 - U - V) * G33 + 2 * (U * V * G12 + U * (1 - U - V) * G13 + V * (1 - U - V) * G23) AS FITTED, U * Y1 + V * Y2 + (1 - U - V) * Y3 AS XY FROM fx_best",
}


def _reg_parts(spark, sf):
    """Returns of the funds, of the factors (a row for each trading day), and the numbered trading days."""
    cal = fx.calendar(spark, sf)
    nav = fx.view(spark, sf, "fx_fund_nav")
    y = nav.select(T, D, daily_return(F.col("NAV"), by([T], D)).alias("RET")).where("RET IS NOT NULL")
    days = fx.trading_days(cal)
    index = fx.view(spark, sf, "fx_nav_long").join(days.withColumnRenamed("TRADE_DT", D), D, "left_semi")
    index = densify(index, days, T, D, "ADJ_NAV")  # an index has a level on every trading day
    x = index.select(T, D, daily_return(100 + 20 * F.col("ADJ_NAV") / (F.col("ADJ_NAV") + 200), by([T], D)).alias("R"))
    wide = x.groupBy(D).agg(*[F.max(F.when(F.col(T) == s, F.col("R"))).alias(f) for f, s in _IDX.items()])
    return y, wide, trading_index(cal)


def _reg_inputs(spark, sf):
    """Fund and factor returns side by side, and the numbered trading days."""
    y, wide, index = _reg_parts(spark, sf)
    # a row for each trading day: the returns of the funds stay where their windows left them
    return y.join(F.broadcast(wide), D).dropna(), F.broadcast(index)


def _moments(spark, sf, factors=FACTORS):
    """Every end date: the last 60 trading days of every fund."""
    panel, days = _reg_inputs(spark, sf)
    return reg.rolling_moments(panel, days, factors, "RET")


@register(
    "o02_rolling_window_moments",
    "SELECT TICKER_SYMBOL, WIN_START, WIN_END, N, round(SR, 6) + 0.0 AS S_RET, round(SXY, 6) + 0.0 AS S_XY, round(SXX, 6) + 0.0 AS S_XX FROM (SELECT TICKER_SYMBOL, WIN_START, END_DATE AS WIN_END, GAP, count(*) OVER f AS N, sum(RET) OVER f AS SR, sum(RET * LARGE_GROWTH) OVER f AS SXY, sum(CASH * MID_VALUE) OVER f AS SXX FROM fx_rm WINDOW f AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS 59 PRECEDING)) t WHERE GAP = 59",
    REG,
)
def o02_rolling_window_moments(spark, sf):
    m = _moments(spark, sf)
    return rounded(m.select(T, "WIN_START", "WIN_END", "N", "S_RET", F.col("S_LARGE_GROWTH_RET").alias("S_XY"), F.col("S_MID_VALUE_CASH").alias("S_XX")))


def _problem(factors):
    return reg.style_problem(len(factors), factors.index("CASH"), 0.05)


@register("o01_constrained_style_regression", "SELECT TICKER_SYMBOL, WIN_START, END_DATE AS WIN_END, CAST(60 AS BIGINT) AS N, true AS FEASIBLE, true AS OPTIMAL FROM fx_rm WHERE GAP = 59", REG)
def o01_constrained_style_regression(spark, sf):
    """Seven styles; the returned weights are held against the optimality conditions, stated in the moments alone.

    Where a weight can fall, its slope must not exceed the slope of any weight that can rise.
    """
    y, wide, index = _reg_parts(spark, sf)
    sums = reg.moment_names(FACTORS, "RET")
    fit = reg.wide_fit(y, wide.join(index.withColumnRenamed("TRADE_DT", D), D), FACTORS, "RET", _problem(FACTORS), moments=True)
    return _held_against(fit.select(*reg.KEYS, "N", *sums, *FACTORS))


def _held_against(fit):
    """Whether the weights keep their bounds, and the optimality conditions; on arrays, as the many columns of a row are few steps of a batch there."""
    columns, k = [*FACTORS, "RET"], len(FACTORS)
    low = np.array([0.05 if f == "CASH" else 0.0 for f in FACTORS])

    def check(batches):
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(float)
            n = column("N")
            mean = {f: column(f"S_{f}") / n for f in columns}
            cov = np.empty((k, k + 1, len(n)))
            for i, f in enumerate(FACTORS):
                for j, g in list(enumerate(columns))[i:]:
                    cov[i, j] = column(f"S_{f}_{g}") / n - mean[f] * mean[g]
                    if j < k:
                        cov[j, i] = cov[i, j]
            w = np.stack([column(f) for f in FACTORS])
            slope = (cov[:, :k] * w).sum(axis=1) - cov[:, k]
            falls = np.where(w > low[:, None] + 1e-7, slope, -np.inf).max(axis=0)
            rises = np.where(w < 1 - 1e-7, slope, np.inf).min(axis=0)
            room = 1e-6 * cov[np.arange(k), np.arange(k)].sum(axis=0)
            inside = ((w >= low[:, None] - 1e-9) & (w <= 1 + 1e-9)).all(axis=0)
            feasible = inside & (np.abs(w.sum(axis=0) - 1) < 1e-9)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*reg.KEYS, "N")], pa.array(feasible), pa.array(falls <= rises + room)], names=[*reg.KEYS, "N", "FEASIBLE", "OPTIMAL"])

    return fit.mapInArrow(check, "TICKER_SYMBOL string, WIN_START date, WIN_END date, N bigint, FEASIBLE boolean, OPTIMAL boolean")


THREE = ["LARGE_GROWTH", "SMALL_VALUE", "CASH"]


def _three(spark, sf):
    return reg.constrained_fit(_moments(spark, sf, THREE), THREE, "RET", _problem(THREE))


@register("o06_three_asset_weights", "SELECT TICKER_SYMBOL, WIN_START, WIN_END, round(U, 4) + 0.0 AS LARGE_GROWTH, round(V, 4) + 0.0 AS SMALL_VALUE, round(W, 4) + 0.0 AS CASH FROM fx_fit", REG)
def o06_three_asset_weights(spark, sf):
    return rounded(_three(spark, sf).select(T, "WIN_START", "WIN_END", *THREE), 4)


@register(
    "o03_three_asset_diagnostics",
    "SELECT TICKER_SYMBOL, WIN_START, WIN_END, round(XY * XY / (FITTED * YY), 4) + 0.0 AS R_SQUARED, round(sqrt(greatest(YY - 2 * XY + FITTED, 0)) * sqrt(252) * 100, 3) + 0.0 AS RESIDUAL_VOL, round(MY - U * M1 - V * M2 - W * M3, 5) + 0.0 AS ALPHA FROM fx_fit",
    REG,
)
def o03_three_asset_diagnostics(spark, sf):
    f = _three(spark, sf)
    return f.select(T, "WIN_START", "WIN_END", *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in (("R_SQUARED", 4), ("RESIDUAL_VOL", 3), ("ALPHA", 5))])


# Funds whose returns are a known mix of factors.  A factor is a cosine or a sine of the trading day with a whole number of waves in 60
# days, so any 60 days in a row have the same moments, the rest of a return (one more wave) is orthogonal to all factors, and the optimum
# follows from the mix alone: the mix itself where it is allowed, else the nearest allowed point.

def waves(n: int) -> list[tuple[str, int]]:
    return [("cos" if k % 2 else "sin", 1 + k // 2) for k in range(n)]


REST = ("cos", 29)
_MIX = "SELECT concat('F', CAST(l_suppkey AS VARCHAR(10))) AS TICKER_SYMBOL, MIXED, CAST(l_suppkey % 11 AS DOUBLE) / 10000 AS A0, 0.3 + CAST(l_suppkey % 5 AS DOUBLE) / 10 AS REST FROM {lineitem} GROUP BY l_suppkey"
#: Seven styles: eight times the share of the fund's value in one part of the parts, less one, so that some are negative.
_SHARES = ", ".join(f"8 * CAST(sum(CASE WHEN l_partkey % 7 = {k} THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS DOUBLE) / CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) - 1 AS V{k}" for k in range(7))
#: Twenty styles of both signs, 31 industries that are shares of ninety per cent of the fund's value (some are zero), one country.
STYLES, INDUSTRIES = 20, 31
WIDE = [f"STYLE_{k}" for k in range(STYLES)] + [f"INDUSTRY_{k}" for k in range(INDUSTRIES)] + ["COUNTRY"]
_PARTS = ", ".join(
    [f"(CAST(count(CASE WHEN CAST(l_quantity AS BIGINT) % 20 = {k} THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) - 0.05) * 10 AS V{k}" for k in range(STYLES)]
    + [f"0.9 * CAST(count(CASE WHEN l_orderkey % 31 = {k} AND l_orderkey % 7 <> 3 THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS V{STYLES + k}" for k in range(INDUSTRIES)]
    + [f"CAST(1 AS DOUBLE) AS V{STYLES + INDUSTRIES}"]
)
MIXES = {"fx_style_mix": _MIX.replace("MIXED", _SHARES), "fx_wide_mix": _MIX.replace("MIXED", _PARTS)}


def _mixed(spark, sf, mix: str, columns: list[str]):
    """Returns of every fund on the days it has a value, and the factor returns of every trading day."""
    day = trading_index(fx.calendar(spark, sf))
    wave = lambda kind, n: F.lit(0.01) * getattr(F, kind)(2 * F.pi() * n * F.col("IDX") / 60)
    factors = day.select(F.col("TRADE_DT").alias(D), "IDX", wave(*REST).alias("_REST"), *[wave(k, n).alias(c) for c, (k, n) in zip(columns, waves(len(columns)))])
    if len(columns) > 7:  # an industry moves with its country
        factors = factors.withColumns({c: F.col(c) + F.col("COUNTRY") for c in columns if c.startswith("INDUSTRY")})
    exposures = spark.sql(MIXES[mix], lineitem=fx.view(spark, sf, "lineitem"))
    held = fx.view(spark, sf, "fx_fund_nav").select(T, D).join(exposures, T)
    dot = sum((F.col(f"V{k}") * F.col(c) for k, c in enumerate(columns)), F.col("A0") + F.col("REST") * F.col("_REST"))
    return held.join(F.broadcast(factors), D).select(T, D, dot.alias("RET")), factors


_V = "[" + ", ".join(f"V{k}" for k in range(7)) + "]"
STYLE = {
    "fx_style_mix": MIXES["fx_style_mix"],
    # nearest point with weights from the floors up that sum to one: what the largest ones exceed a common level by
    "fx_style_up": f"SELECT *, list_transform({_V}, lambda v, k: v - CASE WHEN k = 7 THEN 0.05 ELSE 0 END) AS U FROM fx_style_mix",
    "fx_style_cut": "SELECT *, list_max(list_transform(range(1, 8), lambda n: (list_sum(list_sort(U, 'DESC')[1:n]) - 0.95) / n)) AS LEVEL FROM fx_style_up",
    "fx_style_w": f"SELECT *, list_transform(U, lambda u, k: greatest(u - LEVEL, 0) + CASE WHEN k = 7 THEN 0.05 ELSE 0 END) AS W, {_V} AS V FROM fx_style_cut",
    "fx_style_days": "SELECT TICKER_SYMBOL, END_DATE, IDX - lag(IDX, 59) OVER w AS GAP, lag(END_DATE, 59) OVER w AS WIN_START FROM fx_fund_nav JOIN fx_trading ON TRADE_DT = END_DATE WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)",
    "fx_style_win": "SELECT d.TICKER_SYMBOL, WIN_START, END_DATE AS WIN_END, A0, REST, V, W, list_sum(list_transform(range(1, 8), lambda k: V[k] * W[k])) AS VW, list_sum(list_transform(W, lambda w: w * w)) AS WW, list_sum(list_transform(V, lambda v: v * v)) + REST * REST AS YY FROM fx_style_days d JOIN fx_style_w USING (TICKER_SYMBOL) WHERE GAP = 59",
}


def _style_fit(spark, sf):
    panel, factors = _mixed(spark, sf, "fx_style_mix", FACTORS)
    return reg.wide_fit(panel, factors, FACTORS, "RET", _problem(FACTORS))


@register("o01_style_weights", "SELECT TICKER_SYMBOL, WIN_START, WIN_END, true AS OPTIMAL, " + ", ".join(f"round(W[{k + 1}], 6) + 0.0 AS {f}" for k, f in enumerate(FACTORS)) + " FROM fx_style_win", STYLE)
def o01_style_weights(spark, sf):
    return rounded(_style_fit(spark, sf).select(T, "WIN_START", "WIN_END", "OPTIMAL", *FACTORS))


@register(
    "o03_fit_diagnostics",
    "SELECT TICKER_SYMBOL, WIN_START, WIN_END, round(VW * VW / (WW * YY), 6) + 0.0 AS R_SQUARED, round(0.01 * sqrt((YY - 2 * VW + WW) / 2) * sqrt(252) * 100, 5) + 0.0 AS RESIDUAL_VOL, round(A0, 7) + 0.0 AS ALPHA FROM fx_style_win",
    STYLE,
)
def o03_fit_diagnostics(spark, sf):
    f = _style_fit(spark, sf)
    return f.select(T, "WIN_START", "WIN_END", *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in (("R_SQUARED", 6), ("RESIDUAL_VOL", 5), ("ALPHA", 7))])


@register("o04_dominant_style", "SELECT TICKER_SYMBOL, WIN_END, lower(" + repr(FACTORS[:-1]) + "[list_position(R, list_max(R))]) AS STYLE FROM (SELECT *, list_transform(W[1:6], lambda w: round(w, 6)) AS R FROM fx_style_win) t", STYLE)
def o04_dominant_style(spark, sf):
    f = _style_fit(spark, sf).withColumns({c: F.round(c, 6) for c in FACTORS})
    return f.select(T, "WIN_END", F.lower(arg_max(FACTORS[:-1])).alias("STYLE"))


_WIDE_VAR = "(" + " + ".join([f"V{k} * V{k}" for k in range(STYLES + INDUSTRIES)] + ["COUNTRY * COUNTRY"]) + ")"
WIDE_FX = {
    "fx_wide_mix": MIXES["fx_wide_mix"],
    "fx_wide_days": "SELECT f.TICKER_SYMBOL, f.END_DATE, c.IF_WEEK_END, t.IDX - lag(t.IDX, 59) OVER w AS GAP, lag(f.END_DATE, 59) OVER w AS WIN_START FROM fx_fund_nav f JOIN fx_trading t ON t.TRADE_DT = f.END_DATE JOIN fx_calendar c ON c.TRADE_DT = f.END_DATE WINDOW w AS (PARTITION BY f.TICKER_SYMBOL ORDER BY f.END_DATE)",
    # industries and the country share the country's wave
    "fx_wide_win": "SELECT d.TICKER_SYMBOL, WIN_START, END_DATE AS WIN_END, m.* EXCLUDE (TICKER_SYMBOL), 1 + " + " + ".join(f"V{STYLES + k}" for k in range(INDUSTRIES)) + " AS COUNTRY FROM fx_wide_days d JOIN fx_wide_mix m USING (TICKER_SYMBOL) WHERE GAP = 59 AND IF_WEEK_END = 1",
}


@register(
    "o01_wide_factor_exposures",
    "SELECT TICKER_SYMBOL, WIN_START, WIN_END, true AS OPTIMAL, " + ", ".join(f"round(V{k}, 6) + 0.0 AS {f}" for k, f in enumerate(WIDE)) + f", round({_WIDE_VAR} / ({_WIDE_VAR} + REST * REST), 6) AS R_SQUARED, round(0.01 * REST / sqrt(2) * sqrt(252) * 100, 5) AS RESIDUAL_VOL, round(A0, 7) + 0.0 AS ALPHA FROM fx_wide_win",
    WIDE_FX,
)
def o01_wide_factor_exposures(spark, sf):
    """20 free styles, 31 industries from nought to one that add up to one at most, the country at one; every week end."""
    panel, factors = _mixed(spark, sf, "fx_wide_mix", WIDE)
    ends = fx.calendar(spark, sf).where("IF_WEEK_END = 1").select(F.col("TRADE_DT").alias(D))
    f = reg.wide_fit(panel, factors, WIDE, "RET", reg.factor_problem(STYLES, INDUSTRIES), ends, slack=True)
    digits = dict.fromkeys(WIDE, 6) | {"R_SQUARED": 6, "RESIDUAL_VOL": 5, "ALPHA": 7}
    return f.select(T, "WIN_START", "WIN_END", "OPTIMAL", *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in digits.items()])


@register(
    "o05_unconstrained_ols",
    "SELECT TICKER_SYMBOL, WIN_END, round(B, 5) + 0.0 AS BETA, round(A, 6) + 0.0 AS ALPHA, round(C * C, 5) + 0.0 AS R_SQUARED FROM (SELECT TICKER_SYMBOL, END_DATE AS WIN_END, GAP, regr_slope(RET, LARGE_GROWTH) OVER f AS B, regr_intercept(RET, LARGE_GROWTH) OVER f AS A, corr(RET, LARGE_GROWTH) OVER f AS C FROM fx_rm WINDOW f AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS 59 PRECEDING)) t WHERE GAP = 59",
    REG,
)
def o05_unconstrained_ols(spark, sf):
    m = _moments(spark, sf, ["LARGE_GROWTH"])
    n, sx, sy = F.col("N"), F.col("S_LARGE_GROWTH"), F.col("S_RET")
    xx, xy, yy = F.col("S_LARGE_GROWTH_LARGE_GROWTH") - sx * sx / n, F.col("S_LARGE_GROWTH_RET") - sx * sy / n, F.col("S_RET_RET") - sy * sy / n
    beta = F.try_divide(xy, xx)
    return m.select(T, "WIN_END", (F.round(beta, 5) + 0.0).alias("BETA"), (F.round(sy / n - beta * sx / n, 6) + 0.0).alias("ALPHA"), (F.round(F.try_divide(xy * xy, xx * yy), 5) + 0.0).alias("R_SQUARED"))


# --- streaming ---


def _fresh(spark, name):
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return f"{base}/data", f"{base}/checkpoint"


def _events(spark, sf, *columns):
    return jobs.file_stream(spark, f"{sf}/[e]vents.parquet").select(*columns) if columns else jobs.file_stream(spark, f"{sf}/[e]vents.parquet")


@register("s01_incremental_upsert", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def s01_incremental_upsert(spark, sf):
    path, checkpoint = _fresh(spark, "s01")
    stream = _events(spark, sf, "user_id", "event_id", "ts", "value")
    jobs.run(stream, checkpoint, jobs.upsert_latest(path, ["user_id"], ["ts", "event_id"]), "append")
    return read_dataset(spark, path).select("user_id", "event_id", "value")


@register("s02_tumbling_bars", f"SELECT code, trade_time, open, high, low, close, round(amount, 4) AS amount FROM ({bar_view(30, 'fx_min')}) b", BARS)
def s02_tumbling_bars(spark, sf):
    path, checkpoint = _fresh(spark, "s02")
    ticks = _events(spark, sf).select(F.col("event_type").alias("code"), F.col("ts").alias("trade_time"), F.col("event_id").alias("seq"), F.col("value").alias("price"), F.col("value").alias("amount"))
    jobs.run(jobs.tumbling_bars(ticks, 30), checkpoint, jobs.upsert_rows(path, ["code", "trade_time"]))
    out = read_dataset(spark, path)
    return out.withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz")).withColumn("amount", F.round("amount", 4))


@register(
    "s03_sliding_window_mean",
    "SELECT event_type, CAST(w AS DATE) AS WINDOW_START, round(avg(value), 6) AS MEAN, count(*) AS N FROM (SELECT *, unnest([CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 2 DAY, CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 1 DAY, CAST(CAST(ts AS DATE) AS TIMESTAMP)]) AS w FROM events) t GROUP BY 1, 2",
)
def s03_sliding_window_mean(spark, sf):
    path, checkpoint = _fresh(spark, "s03")
    out = jobs.sliding_mean(_events(spark, sf, "event_type", "ts", "value"), "ts", "value", "3 days", "1 day", ["event_type"])
    jobs.run(out, checkpoint, jobs.upsert_rows(path, ["event_type", "WINDOW_START"]))
    return read_dataset(spark, path).select("event_type", F.to_date("WINDOW_START").alias("WINDOW_START"), F.round("MEAN", 6).alias("MEAN"), "N")


@register("s04_stateful_drawdown", "SELECT user_id, event_id, max(value) OVER w AS HIGH, round(1 - value / max(value) OVER w, 6) + 0.0 AS DRAWDOWN FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def s04_stateful_drawdown(spark, sf):
    path, checkpoint = _fresh(spark, "s04")
    stream = jobs.with_event_time(_events(spark, sf, "user_id", "ts", "event_id", "value"), "ts")
    jobs.run_to_files(jobs.running_drawdown(stream, "user_id", "ts", "event_id", "value"), path, checkpoint)
    return rounded(spark.read.parquet(path))


@register("s04_unordered_batches", "SELECT user_id, event_id, max(value) OVER w AS HIGH, round(1 - value / max(value) OVER w, 6) + 0.0 AS DRAWDOWN FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def s04_unordered_batches(spark, sf):
    """The events come in four batches that are in no order of time; rows behind a late one are corrected."""
    source, path, checkpoint = f"{shared_dir(spark)}/s04-{uuid.uuid4().hex}", *_fresh(spark, "s04u")
    events = fx.table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    for part in range(4):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(source)
    stream = jobs.corrected_drawdown(jobs.file_stream(spark, source, 1), "user_id", "ts", "event_id", "value", delay="400 days")
    jobs.run(stream, checkpoint, jobs.upsert_rows(path, ["user_id", "event_id"]))
    return rounded(read_dataset(spark, path))


@register("s05_stream_static_join", "SELECT event_id, CAST(user_id AS VARCHAR) AS TICKER_SYMBOL, LEVEL_1, LEVEL_2 FROM events JOIN fx_type ON TICKER_SYMBOL = CAST(user_id AS VARCHAR)")
def s05_stream_static_join(spark, sf):
    path, checkpoint = _fresh(spark, "s05")
    stream = _events(spark, sf).select("event_id", F.col("user_id").cast("string").alias(T))
    jobs.run_to_files(jobs.enrich(stream, fx.view(spark, sf, "fx_type").select(T, "LEVEL_1", "LEVEL_2"), T), path, checkpoint)
    return spark.read.parquet(path)


@register("s06_duplicate_suppression", "SELECT event_id, user_id, value FROM events")
def s06_duplicate_suppression(spark, sf):
    path, checkpoint = _fresh(spark, "s06")
    twice = _events(spark, sf, "event_id", "user_id", "ts", "value")
    stream = jobs.without_duplicates(twice.union(_events(spark, sf, "event_id", "user_id", "ts", "value")), ["event_id"], "ts", "40 days")
    jobs.run_to_files(stream.select("event_id", "user_id", "value"), path, checkpoint)
    return spark.read.parquet(path)


@register("s07_late_corrections", "SELECT CAST(ts AS DATE) AS DAY, event_type, count(*) AS N, round(sum(value), 2) AS TOTAL FROM events GROUP BY 1, 2")
def s07_late_corrections(spark, sf):
    path, checkpoint = _fresh(spark, "s07")
    stream = _events(spark, sf, "event_id", "event_type", "value", F.to_date("ts").alias("DAY"))
    each = jobs.late_corrections(f"{path}/raw", f"{path}/daily", "DAY", ["event_id"], ["event_type"], [F.count(F.lit(1)).alias("N"), F.round(F.sum("value"), 2).alias("TOTAL")])
    jobs.run(stream, checkpoint, each, "append")
    return spark.read.schema("event_type string, N bigint, TOTAL double, DAY date").parquet(f"{path}/daily")


@register("s07_retracted_corrections", "SELECT CAST(ts AS DATE) AS DAY, event_type, count(*) AS N, round(sum(value), 2) + 0.0 AS TOTAL FROM events GROUP BY 1, 2")
def s07_retracted_corrections(spark, sf):
    """A first batch with wrong values and days here and there, a second one with the right rows of these keys."""
    source, path, checkpoint = f"{shared_dir(spark)}/s07-{uuid.uuid4().hex}", *_fresh(spark, "s07r")
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "value", F.to_date("ts").alias("DAY"))
    wrong, other = F.col("event_id") % 10 == 0, F.col("event_id") % 7 == 0
    first = events.withColumns({"value": F.when(wrong, F.col("value") + 1).otherwise(F.col("value")), "DAY": F.when(other, F.date_sub("DAY", 1)).otherwise(F.col("DAY"))})
    for part in (first, events.where(wrong | other)):
        part.coalesce(1).write.mode("append").parquet(source)
    each = jobs.late_deltas(f"{path}/raw", f"{path}/daily", ["event_id"], ["DAY", "event_type"], {"TOTAL": F.col("value")})
    jobs.run(jobs.file_stream(spark, source, 1), checkpoint, each, "append")
    found = read_dataset(spark, f"{path}/daily").where("N > 0")
    return found.select("DAY", "event_type", "N", (F.round("TOTAL", 2) + F.lit(0.0)).alias("TOTAL"))
