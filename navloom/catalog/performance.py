"""Performance statistics: the panel and the classic flavour."""

from __future__ import annotations

from pyspark.sql import functions as F

from navloom.catalog.base import nav_panel, register, rounded
from navloom.functions.exprs import clip_overflow
from navloom.operators.calendars import period_table, window_table
from navloom.operators.joins import fan_out
from navloom.operators.ranks import fits, peer_rank
from navloom.plans import performance as perf
from navloom.sources import fixtures as fx

TRAILING = 5  # fixed value: end dates that the daily run computes again
SPEC = {"WEEK": [1], "MONTH": [1, 2, 3, 6, 9], "YEAR": list(range(1, 11))}

STEPS_SQL = ", ".join(
    f"('近{n}{cn}', {months}, {days})"
    for n, cn, months, days in [(1, "周", 0, 7)]
    + [(n, "月", n, 0) for n in (1, 2, 3, 6, 9)]
    + [(n, "年", 12 * n, 0) for n in range(1, 11)]
)

WINDOW_VIEWS = {
    "fx_ends": f"SELECT TRADE_DT AS END_DATE FROM fx_trading ORDER BY TRADE_DT DESC LIMIT {TRAILING}",
    "fx_snap": "SELECT TRADE_DT AS DAY, CASE WHEN IF_TRADING_DAY = 1 THEN TRADE_DT ELSE PREV_TRADE_DATE END AS SNAP FROM fx_cal",
    "fx_steps": f"SELECT * FROM (VALUES {STEPS_SQL}) AS v(DATE_NAME, M, D)",
    "fx_windows": """
SELECT 'ALL' AS PORTFOLIO_NAME, DATE_NAME, START_DATE, END_DATE FROM (
  SELECT c.TRADE_DT AS END_DATE, u.DATE_NAME, CASE u.DATE_NAME WHEN '近1日' THEN PREV_TRADE_DATE WHEN 'WTD' THEN WEEK_END_DATE
     WHEN 'MTD' THEN MONTH_END_DATE WHEN 'QTD' THEN QUARTER_END_DATE ELSE YEAR_END_DATE END AS START_DATE
  FROM fx_cal c JOIN fx_ends e ON c.TRADE_DT = e.END_DATE, (VALUES ('近1日'), ('WTD'), ('MTD'), ('QTD'), ('YTD')) AS u(DATE_NAME)
  UNION ALL
  SELECT e.END_DATE, s.DATE_NAME, p.SNAP FROM fx_ends e, fx_steps s, fx_snap p
  WHERE p.DAY = CAST(e.END_DATE - to_months(s.M) - to_days(s.D) AS DATE)) t
WHERE START_DATE < END_DATE""",
    "fx_spans": "SELECT DISTINCT START_DATE AS WIN_START, END_DATE AS WIN_END FROM fx_windows",
}


def points_views(panel: str, prefix: str, spans: str) -> dict[str, str]:
    """Oracle views of the points and the statistics of one panel over one set of spans."""
    return {
        f"{prefix}_pts": f"""
SELECT n.TICKER_SYMBOL, s.WIN_START, s.WIN_END, n.END_DATE, n.NAV,
  lag(n.END_DATE) OVER w AS PREV_DATE, n.NAV / lag(n.NAV) OVER w - 1 AS RET, 1 - n.NAV / max(n.NAV) OVER (w ROWS UNBOUNDED PRECEDING) AS DD
FROM {panel} n JOIN {spans} s ON n.END_DATE BETWEEN s.WIN_START AND s.WIN_END
WINDOW w AS (PARTITION BY n.TICKER_SYMBOL, s.WIN_START, s.WIN_END ORDER BY n.END_DATE)""",
        f"{prefix}_dd": f"""
SELECT p.TICKER_SYMBOL, p.WIN_START, p.WIN_END, m.MDD, max(p.END_DATE) FILTER (WHERE p.DD = m.MDD AND m.MDD <> 0) AS LAST_DD,
  min(p.END_DATE) FILTER (WHERE p.DD = m.MDD) AS FIRST_DD
FROM {prefix}_pts p JOIN (SELECT TICKER_SYMBOL, WIN_START, WIN_END, max(DD) AS MDD FROM {prefix}_pts GROUP BY ALL) m USING (TICKER_SYMBOL, WIN_START, WIN_END)
GROUP BY ALL""",
        f"{prefix}_agg": f"""
SELECT p.TICKER_SYMBOL, p.WIN_START, p.WIN_END, d.MDD, d.LAST_DD, d.FIRST_DD,
  min(p.END_DATE) AS D0, max(p.END_DATE) AS D1, min(p.END_DATE) FILTER (WHERE p.PREV_DATE IS NOT NULL) AS D2,
  arg_max(p.NAV, p.END_DATE) / arg_min(p.NAV, p.END_DATE) - 1 AS CUM, stddev_samp(p.RET) AS VOL,
  min(p.END_DATE) FILTER (WHERE p.END_DATE >= d.LAST_DD AND p.DD = 0) AS REC_PANEL,
  min(p.END_DATE) FILTER (WHERE p.END_DATE > d.FIRST_DD AND p.DD = 0) AS REC_CLASSIC,
  avg(CASE WHEN p.RET > 0 THEN 1.0::DOUBLE WHEN p.RET IS NOT NULL THEN 0.0::DOUBLE END) AS WIN, quantile_cont(p.RET, 0.05) AS VAR5, count(p.RET) AS NR
FROM {prefix}_pts p JOIN {prefix}_dd d USING (TICKER_SYMBOL, WIN_START, WIN_END) GROUP BY ALL""",
        f"{prefix}_stats": f"""
SELECT *, CUM_RETURN / nullif(VOLATILITY, 0) AS SHARP_RATIO, ANNUAL_RETURN / nullif(ANNUAL_VOLATILITY, 0) AS SHARP_RATIO_ANNUAL,
  ANNUAL_RETURN / nullif(MAXDD, 0) AS CALMAR_RATIO_ANNUAL
FROM (SELECT TICKER_SYMBOL, D0 AS START_DATE, D1 AS END_DATE, WIN_START, WIN_END, CUM * 100 AS CUM_RETURN,
  CASE WHEN D1 - D2 + 1 > 0 THEN (pow(1 + CUM, 365 / (D1 - D2 + 1)) - 1) * 100 END AS ANNUAL_RETURN,
  VOL * 100 AS VOLATILITY, VOL * 100 * sqrt(252) AS ANNUAL_VOLATILITY, MDD * 100 AS MAXDD,
  CAST(coalesce(REC_PANEL - LAST_DD, 99999) AS INTEGER) AS MAXDD_RECOVER, LAST_DD AS MAXDD_DATE, CAST(greatest(0, D1 - D2 + 1) AS INTEGER) AS OPERATION_DAYS FROM {prefix}_agg) t""",
    }


def clip(col: str, digits: int = 4) -> str:
    return f"CASE WHEN abs({col}) <= 1e8 THEN round({col}, {digits}) + 0.0 END AS {col}"


STAT_COLS = ["CUM_RETURN", "ANNUAL_RETURN", "VOLATILITY", "ANNUAL_VOLATILITY", "MAXDD", "SHARP_RATIO", "SHARP_RATIO_ANNUAL", "CALMAR_RATIO_ANNUAL"]
CLIPPED = ", ".join(clip(c) for c in STAT_COLS)
FUND = {**WINDOW_VIEWS, **points_views("fx_fund_nav", "fx_f", "fx_spans")}
WHOLE = {
    "fx_n": "SELECT TICKER_SYMBOL, END_DATE, ADJ_NAV AS NAV FROM fx_nav",
    "fx_w_pts": """SELECT *, lag(END_DATE) OVER w AS PREV_DATE, NAV / lag(NAV) OVER w - 1 AS RET, 1 - NAV / max(NAV) OVER (w ROWS UNBOUNDED PRECEDING) AS DD
FROM (SELECT *, min(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS WIN_START, max(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS WIN_END FROM fx_n) t
WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)""",
    **{k: v for k, v in points_views("x", "fx_w", "x").items() if k != "fx_w_pts"},
}


def fund_windows(spark, sf):
    cal = fx.calendar(spark, sf)
    ends = cal.where("IF_TRADING_DAY = 1").select(F.col("TRADE_DT").alias("END_DATE")).orderBy(F.desc("END_DATE")).limit(TRAILING)
    return window_table(cal, ends, spec=SPEC)


def fund_stats(spark, sf):
    windows = fund_windows(spark, sf)
    return perf.window_stats(fx.view(spark, sf, "fx_fund_nav"), windows), windows


# --- flagship: statistics of every fund over every window, ranked inside its class ---

RANKED_VIEWS = {
    **FUND,
    "fx_named": "SELECT s.*, w.DATE_NAME, t.LEVEL_1, t.LEVEL_2 FROM fx_f_stats s JOIN fx_windows w ON s.START_DATE = w.START_DATE AND s.END_DATE = w.END_DATE JOIN fx_fund_type t USING (TICKER_SYMBOL) WHERE s.START_DATE = s.WIN_START AND s.END_DATE = s.WIN_END",
    "fx_ranked": """SELECT *, floor(rank() OVER (PARTITION BY END_DATE, DATE_NAME, LEVEL_1 ORDER BY V DESC) + (count(*) OVER (PARTITION BY END_DATE, DATE_NAME, LEVEL_1, V) - 1) / 2.0) AS RK,
  count(*) OVER (PARTITION BY END_DATE, DATE_NAME, LEVEL_1) AS N FROM (SELECT *, round(CUM_RETURN, 4) AS V FROM fx_named) t""",
}


@register(
    "performance_peer_rank",
    f"""SELECT TICKER_SYMBOL, LEVEL_1, DATE_NAME, START_DATE, END_DATE, {CLIPPED}, MAXDD_RECOVER, MAXDD_DATE,
 round(100 * (RK - 1) / nullif(N - 1, 0), 6) AS RANK_PCT, concat(CAST(CAST(RK AS BIGINT) AS VARCHAR), '/', CAST(N AS VARCHAR)) AS RANK_TEXT FROM fx_ranked""",
    RANKED_VIEWS,
)
def performance_peer_rank(spark, sf):
    stats, windows = fund_stats(spark, sf)
    classes = fx.view(spark, sf, "fx_fund_type").select("TICKER_SYMBOL", "LEVEL_1")
    named = rounded(perf.named_stats(stats, windows).join(classes, "TICKER_SYMBOL"), 4)
    group = ["END_DATE", "DATE_NAME", "LEVEL_1"]
    # a fund has one row per window, so the largest class bounds the groups; only the class table is measured
    small = fits(classes, ["LEVEL_1"])
    ranked = peer_rank(named, "CUM_RETURN", group, pct="RANK_PCT", text="RANK_TEXT", bounded=small)
    return ranked.select("TICKER_SYMBOL", "LEVEL_1", "DATE_NAME", "START_DATE", "END_DATE", *STAT_COLS, "MAXDD_RECOVER", "MAXDD_DATE", F.round("RANK_PCT", 6).alias("RANK_PCT"), "RANK_TEXT")


@register("j12_window_table", "SELECT PORTFOLIO_NAME, DATE_NAME, START_DATE, END_DATE FROM fx_windows", WINDOW_VIEWS)
def j12_window_table(spark, sf):
    return fund_windows(spark, sf)


@register(
    "k13_stats_many_windows",
    f"SELECT TICKER_SYMBOL, START_DATE, END_DATE, {CLIPPED}, MAXDD_RECOVER, MAXDD_DATE FROM fx_f_stats WHERE START_DATE = WIN_START AND END_DATE = WIN_END",
    FUND,
)
def k13_stats_many_windows(spark, sf):
    return rounded(fund_stats(spark, sf)[0].select(*perf.STORED), 4)


@register("c18_window_fan_out", "SELECT WIN_START, WIN_END, count(*) AS N, round(avg(NAV), 6) AS MEAN_NAV FROM fx_f_pts GROUP BY ALL", FUND)
def c18_window_fan_out(spark, sf):
    fanned = fan_out(fx.view(spark, sf, "fx_fund_nav"), fund_windows(spark, sf))
    return fanned.groupBy("WIN_START", "WIN_END").agg(F.count(F.lit(1)).alias("N"), F.round(F.avg("NAV"), 6).alias("MEAN_NAV"))


def whole_stats(spark, sf):
    return perf.window_stats(nav_panel(fx.view(spark, sf, "fx_nav")))


@register("k12_stats_row", f"SELECT TICKER_SYMBOL, START_DATE, END_DATE, {CLIPPED}, MAXDD_RECOVER, MAXDD_DATE FROM fx_w_stats", WHOLE)
def k12_stats_row(spark, sf):
    return rounded(whole_stats(spark, sf).select(*perf.STORED), 4)


@register("k01_operation_days", "SELECT TICKER_SYMBOL, OPERATION_DAYS FROM fx_w_stats", WHOLE)
def k01_operation_days(spark, sf):
    return whole_stats(spark, sf).select("TICKER_SYMBOL", "OPERATION_DAYS")


@register("k02_start_end_date", "SELECT TICKER_SYMBOL, min(END_DATE) AS START_DATE, max(END_DATE) AS END_DATE FROM fx_nav GROUP BY 1")
def k02_start_end_date(spark, sf):
    return fx.view(spark, sf, "fx_nav").groupBy("TICKER_SYMBOL").agg(F.min("END_DATE").alias("START_DATE"), F.max("END_DATE").alias("END_DATE"))


@register("k03_daily_return", "SELECT TICKER_SYMBOL, END_DATE, round((NAV / lag(NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1) * 100, 6) + 0.0 AS DAILY_RETURN FROM fx_fund_nav")
def k03_daily_return(spark, sf):
    return rounded(perf.daily_return(fx.view(spark, sf, "fx_fund_nav")))


@register("k04_daily_drawdown", "SELECT TICKER_SYMBOL, END_DATE, round((1 - NAV / max(NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS UNBOUNDED PRECEDING)) * 100, 6) + 0.0 AS DAILY_DRAWDOWN FROM fx_fund_nav")
def k04_daily_drawdown(spark, sf):
    return rounded(perf.daily_drawdown(fx.view(spark, sf, "fx_fund_nav")))


def _part(name, columns):
    rounded_sql = ", ".join(clip(c) if c in STAT_COLS else c for c in columns)

    @register(name, f"SELECT TICKER_SYMBOL, {rounded_sql} FROM fx_w_stats", WHOLE)
    def part(spark, sf):
        return rounded(whole_stats(spark, sf).select("TICKER_SYMBOL", *columns), 4)


_part("k05_cumulative_return", ["CUM_RETURN"])
_part("k06_annual_return", ["ANNUAL_RETURN"])
_part("k07_volatility", ["VOLATILITY", "ANNUAL_VOLATILITY"])
_part("k08_max_drawdown", ["MAXDD"])
_part("k09_max_drawdown_date", ["MAXDD_DATE"])
_part("k10_recovery_days", ["MAXDD_RECOVER"])
_part("k11_ratios", ["SHARP_RATIO", "SHARP_RATIO_ANNUAL", "CALMAR_RATIO_ANNUAL"])

PERIODS = ["近1周", "近1月", "近3月", "近6月", "近1年", "近2年", "近3年", "YTD", "QTD", "MTD", "WTD"]
INDICATORS = ["CUM_RETURN", "ANNUAL_VOLATILITY", "MAXDD", "SHARP_RATIO_ANNUAL"]


@register(
    "k15_wide_by_period",
    "SELECT END_DATE, TICKER_SYMBOL, INDICATOR, "
    + ", ".join(f'round(max(VALUE) FILTER (WHERE DATE_NAME = \'{p}\'), 4) AS "{p}"' for p in PERIODS)
    + f" FROM (UNPIVOT (SELECT END_DATE, TICKER_SYMBOL, DATE_NAME, {', '.join(clip(i) for i in INDICATORS)} FROM fx_named) ON {', '.join(INDICATORS)} INTO NAME INDICATOR VALUE VALUE) u GROUP BY ALL",
    RANKED_VIEWS,
)
def k15_wide_by_period(spark, sf):
    stats, windows = fund_stats(spark, sf)
    return rounded(perf.wide_by_period(perf.named_stats(stats, windows), INDICATORS, PERIODS), 4)


# --- classic flavour ---

BENCH_VIEWS = {
    "fx_bench": "SELECT END_DATE, avg(NAV) AS BENCH_NAV FROM fx_fund_nav GROUP BY 1",
    "fx_fb": "SELECT f.*, b.BENCH_NAV FROM fx_fund_nav f JOIN fx_bench b USING (END_DATE)",
    "fx_fbw": "SELECT *, min(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS WIN_START, max(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS WIN_END FROM fx_fb",
    "fx_bp0": """SELECT *, lag(END_DATE) OVER w AS PREV_DATE, NAV / lag(NAV) OVER w - 1 AS RET, BENCH_NAV / lag(BENCH_NAV) OVER w - 1 AS BRET,
  1 - BENCH_NAV / max(BENCH_NAV) OVER (w ROWS UNBOUNDED PRECEDING) AS BDD, row_number() OVER w - 1 AS T
FROM fx_fbw WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)""",
    "fx_bp1": "SELECT *, ln(1 + RET) AS LR, ln(1 + BRET) AS LB, RET - BRET AS AR, ln(1 + RET) - ln(1 + BRET) AS LA FROM fx_bp0",
    "fx_bp2": """SELECT *, sum(LR) OVER w AS CLR, sum(LA) OVER w AS CLA, CASE WHEN AR IS NOT NULL THEN exp(sum(ln(1 + AR)) OVER w) END AS ANAV
FROM fx_bp1 WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS UNBOUNDED PRECEDING)""",
    "fx_bp": "SELECT *, 1 - ANAV / max(ANAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS UNBOUNDED PRECEDING) AS ADD_ FROM fx_bp2",
    "fx_b": """SELECT TICKER_SYMBOL, WIN_START, WIN_END, min(END_DATE) FILTER (WHERE PREV_DATE IS NOT NULL) AS D2, max(END_DATE) AS D1,
  arg_max(NAV, END_DATE) / arg_min(NAV, END_DATE) - 1 AS CUM, arg_max(BENCH_NAV, END_DATE) / arg_min(BENCH_NAV, END_DATE) - 1 AS BCUM,
  stddev_samp(BRET) AS BVOL, max(BDD) AS BMDD, sum(LA) AS SLA, stddev_samp(AR) AS AVOL,
  sum(LR) FILTER (WHERE BRET > 0) AS ULR, sum(LB) FILTER (WHERE BRET > 0) AS ULB, count(*) FILTER (WHERE BRET > 0) AS UN,
  sum(LR) FILTER (WHERE BRET < 0) AS DLR, sum(LB) FILTER (WHERE BRET < 0) AS DLB, count(*) FILTER (WHERE BRET < 0) AS DN,
  pow(corr(CLR, T), 2) AS STAB, pow(sum(T * CLA), 2) / nullif(sum(T * T) FILTER (WHERE CLA IS NOT NULL) * sum(CLA * CLA), 0) AS ASTAB,
  avg(CASE WHEN LA > 0 THEN 1.0::DOUBLE WHEN LA IS NOT NULL THEN 0.0::DOUBLE END) AS AWIN, max(ADD_) AS AMDD
FROM fx_bp GROUP BY ALL""",
}


def bench_panel(spark, sf):
    nav = fx.view(spark, sf, "fx_fund_nav")
    return nav.join(F.broadcast(nav.groupBy("END_DATE").agg(F.avg("NAV").alias("BENCH_NAV"))), "END_DATE")  # a row for each calendar day


def _bench(name, columns: dict[str, str], digits=5):
    sql = ", ".join(f"round({expr}, {digits}) + 0.0 AS {c}" for c, expr in columns.items())

    @register(name, f"SELECT TICKER_SYMBOL, {sql} FROM fx_b WHERE D2 IS NOT NULL", BENCH_VIEWS)
    def bench(spark, sf):
        return rounded(perf.benchmark_stats(bench_panel(spark, sf)).select("TICKER_SYMBOL", *columns), digits)


_DAYS = "(D1 - D2 + 1)"
_UP, _DOWN = "((exp(ULR * 252 / nullif(UN, 0)) - 1) / nullif(exp(ULB * 252 / nullif(UN, 0)) - 1, 0))", "((exp(DLR * 252 / nullif(DN, 0)) - 1) / nullif(exp(DLB * 252 / nullif(DN, 0)) - 1, 0))"
_bench("k16_alpha", {"ALPHA": "CUM - BCUM", "ANNUAL_ALPHA": f"coalesce(CASE WHEN 1 + CUM - BCUM >= 0 THEN pow(1 + CUM - BCUM, 365 / {_DAYS}) - 1 END, 0)"})
_bench("k17_information_ratio", {"IR": f"coalesce((pow(exp(SLA), 365 / {_DAYS}) - 1) / nullif(AVOL * sqrt(252), 0), 0)"})
_bench(
    "k18_benchmark_metrics",
    {"BENCH_CUM_RETURN": "BCUM", "BENCH_ANNUAL_RETURN": f"pow(1 + BCUM, 365 / {_DAYS}) - 1", "BENCH_ANNUAL_VOLATILITY": "BVOL * sqrt(252)", "BENCH_MAXDD": "BMDD"},
)
_bench("k19_capture_ratios", {"UP_CAPTURE": f"coalesce({_UP}, 0)", "DOWN_CAPTURE": f"coalesce({_DOWN}, 0)", "UP_DOWN_CAPTURE": f"coalesce({_UP} / nullif({_DOWN}, 0), 0)"})
_bench("k20_stability", {"STABILITY": "coalesce(STAB, 0)"})
_bench("k21_alpha_stability", {"ALPHA_STABILITY": "ASTAB"})

CLASSIC = points_views("fx_fund_nav", "fx_c", "fx_whole")
CLASSIC = {
    "fx_c_pts": """SELECT *, lag(END_DATE) OVER w AS PREV_DATE, NAV / lag(NAV) OVER w - 1 AS RET, 1 - NAV / max(NAV) OVER (w ROWS UNBOUNDED PRECEDING) AS DD
FROM (SELECT *, min(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS WIN_START, max(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS WIN_END FROM fx_fund_nav) t
WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)""",
    **{k: v for k, v in CLASSIC.items() if k in ("fx_c_dd", "fx_c_agg")},
}


def classic_sql(prefix: str) -> str:
    return f"""
SELECT TICKER_SYMBOL, WIN_START, WIN_END, D0 AS START_DATE, D1 AS END_DATE, CUM AS CUM_RETURN, pow(1 + CUM, 365 / (D1 - D2 + 1)) - 1 AS ANNUAL_RETURN, VOL AS VOLATILITY,
  coalesce(VOL * sqrt(252), 0) AS ANNUAL_VOLATILITY, MDD AS MAXDD, FIRST_DD AS MAXDD_DATE, CAST(coalesce(REC_CLASSIC - FIRST_DD, 99999) AS INTEGER) AS MAXDD_RECOVER,
  WIN AS WIN_RATE, VAR5 AS VALUE_AT_RISK FROM {prefix}_agg WHERE NR > 0"""


def classic_select(prefix: str, columns: list[str], digits: int = 5) -> str:
    full = f"""(SELECT *, coalesce((ANNUAL_RETURN - 0.03) / nullif(ANNUAL_VOLATILITY, 0), 0) AS SHARP_RATIO, coalesce(ANNUAL_RETURN / nullif(MAXDD, 0), 0) AS CALMAR_RATIO
 FROM ({classic_sql(prefix)}) t) u"""
    plain = {"TICKER_SYMBOL", "START_DATE", "END_DATE", "MAXDD_DATE", "MAXDD_RECOVER", "WIN_START", "WIN_END"}
    cols = ", ".join(c if c in plain else f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)
    return f"SELECT {cols} FROM {full}"


def _classic(name, columns):
    columns = ["TICKER_SYMBOL", *columns]

    @register(name, classic_select("fx_c", columns), CLASSIC)
    def classic(spark, sf):
        return rounded(perf.classic_stats(fx.view(spark, sf, "fx_fund_nav"), risk_free=0.03).select(*columns), 5)


_classic("k22_win_rate", ["WIN_RATE"])
_classic("k24_calmar", ["CALMAR_RATIO"])
_classic("k25_value_at_risk", ["VALUE_AT_RISK"])
_classic("k34_sharpe_max_drawdown", ["SHARP_RATIO", "MAXDD"])
_classic(
    "k28_classic_stats_row",
    ["START_DATE", "END_DATE", "CUM_RETURN", "ANNUAL_RETURN", "VOLATILITY", "ANNUAL_VOLATILITY", "MAXDD", "MAXDD_DATE", "MAXDD_RECOVER", "SHARP_RATIO", "CALMAR_RATIO"],
)


@register("k22_alpha_win_rate", "SELECT TICKER_SYMBOL, round(AWIN, 5) AS ALPHA_WIN_RATE FROM fx_b WHERE D2 IS NOT NULL", BENCH_VIEWS)
def k22_alpha_win_rate(spark, sf):
    return rounded(perf.benchmark_stats(bench_panel(spark, sf)).select("TICKER_SYMBOL", "ALPHA_WIN_RATE"), 5)


@register("k23_alpha_drawdown", "SELECT TICKER_SYMBOL, round(AMDD, 5) + 0.0 AS ALPHA_MAXDD FROM fx_b WHERE D2 IS NOT NULL", BENCH_VIEWS)
def k23_alpha_drawdown(spark, sf):
    return rounded(perf.benchmark_stats(bench_panel(spark, sf)).select("TICKER_SYMBOL", "ALPHA_MAXDD"), 5)


def _ols(u: str, v: str) -> str:
    return f"""(SELECT TICKER_SYMBOL, BU, BV, MY - BU * MU - BV * MV AS A FROM (
 SELECT *, (VV * UY - UV * VY) / nullif(UU * VV - UV * UV, 0) AS BU, (UU * VY - UV * UY) / nullif(UU * VV - UV * UV, 0) AS BV FROM (
  SELECT TICKER_SYMBOL, avg(Y) AS MY, avg({u}) AS MU, avg({v}) AS MV, var_samp({u}) AS UU, var_samp({v}) AS VV, covar_samp({u}, {v}) AS UV, covar_samp({u}, Y) AS UY, covar_samp({v}, Y) AS VY
  FROM (SELECT TICKER_SYMBOL, RET - 0.03 / 252 AS Y, BRET - 0.03 / 252 AS X FROM fx_bp WHERE RET IS NOT NULL) p GROUP BY 1) m) s)"""


@register("k26_quadratic_timing", f"SELECT TICKER_SYMBOL, round(pow(1 + A, 252) - 1, 4) + 0.0 AS QUAD_ALPHA, round(BV, 4) + 0.0 AS QUAD_TIMING FROM {_ols('X', 'X * X')} z", BENCH_VIEWS)
def k26_quadratic_timing(spark, sf):
    return rounded(perf.timing_models(bench_panel(spark, sf)).select("TICKER_SYMBOL", "QUAD_ALPHA", "QUAD_TIMING"), 4)


@register("k27_updown_timing", f"SELECT TICKER_SYMBOL, round(pow(1 + A, 252) - 1, 4) + 0.0 AS UPDOWN_ALPHA, round(BV - BU, 4) + 0.0 AS UPDOWN_TIMING FROM {_ols('least(X, 0)', 'greatest(X, 0)')} z", BENCH_VIEWS)
def k27_updown_timing(spark, sf):
    return rounded(perf.timing_models(bench_panel(spark, sf)).select("TICKER_SYMBOL", "UPDOWN_ALPHA", "UPDOWN_TIMING"), 4)


# --- the same over every look-back window ---

_BY_WINDOW = "PARTITION BY TICKER_SYMBOL, WIN_START, WIN_END"
BENCH_WINDOWS = {
    **WINDOW_VIEWS,
    **{k: v.replace("PARTITION BY TICKER_SYMBOL", _BY_WINDOW).replace("pow(corr(CLR, T), 2)", "regr_r2(CLR, T)") for k, v in BENCH_VIEWS.items()},
    "fx_fbw": "SELECT f.*, WIN_START, WIN_END FROM fx_fb f JOIN fx_spans s ON f.END_DATE BETWEEN s.WIN_START AND s.WIN_END",
}


def _bench_window(name, columns: dict[str, str], digits=5):
    """Yearly figures of a few days overflow and are null, as in the stored tables."""
    sql = ", ".join(f"CASE WHEN abs({expr}) <= 1e8 THEN round({expr}, {digits}) + 0.0 END AS {c}" for c, expr in columns.items())

    @register(name, f"SELECT TICKER_SYMBOL, WIN_START, WIN_END, {sql} FROM fx_b WHERE D2 IS NOT NULL", BENCH_WINDOWS)
    def bench(spark, sf):
        stats = perf.benchmark_stats(bench_panel(spark, sf), fund_windows(spark, sf), columns=list(columns))
        return rounded(stats.select("TICKER_SYMBOL", "WIN_START", "WIN_END", *[clip_overflow(F.col(c)).alias(c) for c in columns]), digits)


_bench_window(
    "k16_window_benchmark_stats",
    {
        "BENCH_CUM_RETURN": "BCUM",
        "BENCH_ANNUAL_VOLATILITY": "BVOL * sqrt(252)",
        "BENCH_MAXDD": "BMDD",
        "ALPHA": "CUM - BCUM",
        "ALPHA_WIN_RATE": "AWIN",
        "ALPHA_MAXDD": "AMDD",
    },
)
_bench_window("k19_window_capture", {"UP_CAPTURE": f"coalesce(CASE WHEN UN > 0 THEN {_UP} END, 0)", "DOWN_CAPTURE": f"coalesce(CASE WHEN DN > 0 THEN {_DOWN} END, 0)"}, 4)
_bench_window("k20_window_stability", {"STABILITY": "coalesce(STAB, 0)", "ALPHA_STABILITY": "ASTAB"}, 4)


def _ols_window(u: str, v: str) -> str:
    inner = _ols(u, v).replace("SELECT TICKER_SYMBOL,", "SELECT TICKER_SYMBOL, WIN_START, WIN_END,").replace("GROUP BY 1)", "GROUP BY 1, 2, 3)")
    return inner.replace("nullif(UU * VV - UV * UV, 0)", f"(CASE WHEN UU * VV - UV * UV > {perf.FLAT} * UU * VV THEN UU * VV - UV * UV END)")


@register(
    "k26_window_timing_models",
    f"""SELECT q.TICKER_SYMBOL, q.WIN_START, q.WIN_END, round(pow(1 + q.A, 252) - 1, 3) + 0.0 AS QUAD_ALPHA, round(q.BV, 3) + 0.0 AS QUAD_TIMING, round(pow(1 + u.A, 252) - 1, 3) + 0.0 AS UPDOWN_ALPHA, round(u.BV - u.BU, 3) + 0.0 AS UPDOWN_TIMING
FROM {_ols_window('X', 'X * X')} q JOIN {_ols_window('least(X, 0)', 'greatest(X, 0)')} u USING (TICKER_SYMBOL, WIN_START, WIN_END) WHERE q.WIN_END - q.WIN_START > 100""",
    BENCH_WINDOWS,
)
def k26_window_timing_models(spark, sf):
    """Windows of more than a hundred days: below that the regressors hardly differ."""
    models = perf.timing_models(bench_panel(spark, sf), fund_windows(spark, sf).where(F.datediff("END_DATE", "START_DATE") > 100))
    return rounded(models, 3)


_HORIZON_SQL = " UNION ALL ".join(
    f"SELECT TICKER_SYMBOL, '{label}' AS HORIZON, NAV / lag(NAV, {n}) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1 AS R FROM fx_fund_nav" for n, label in perf.ROLLING_HORIZONS.items()
)


@register(
    "k29_rolling_horizons",
    f"""SELECT TICKER_SYMBOL, HORIZON, round(quantile_cont(R, 0.25), 6) + 0.0 AS P25, round(quantile_cont(R, 0.5), 6) + 0.0 AS MEDIAN, round(quantile_cont(R, 0.75), 6) + 0.0 AS P75,
 round(avg(CASE WHEN R > 0 THEN 1.0::DOUBLE WHEN R IS NOT NULL THEN 0.0::DOUBLE END), 6) AS WIN_RATE FROM ({_HORIZON_SQL}) t GROUP BY ALL""",
)
def k29_rolling_horizons(spark, sf):
    return rounded(perf.rolling_horizons(fx.view(spark, sf, "fx_fund_nav")))


@register(
    "k30_ic_analysis",
    """SELECT LEVEL_1, count(IC) AS N, round(avg(IC), 6) AS MEAN, round(abs(avg(IC)), 6) AS ABS_MEAN, round(stddev_pop(IC), 6) AS STD, round(avg(IC) / nullif(stddev_pop(IC), 0), 6) AS IR,
  round(avg(IC) / nullif(stddev_pop(IC), 0) * sqrt(count(IC)), 6) AS T_VALUE, round(avg(CASE WHEN IC > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS POSITIVE, round(avg(CASE WHEN IC < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS NEGATIVE
FROM (SELECT LEVEL_1, END_DATE, corr(R0, R1) AS IC FROM (
  SELECT t.LEVEL_1, n.END_DATE, ADJ_NAV / lag(ADJ_NAV) OVER w - 1 AS R0, lead(ADJ_NAV) OVER w / ADJ_NAV - 1 AS R1
  FROM fx_nav n JOIN fx_type t USING (TICKER_SYMBOL) WINDOW w AS (PARTITION BY n.TICKER_SYMBOL ORDER BY n.END_DATE)) p
  WHERE R0 IS NOT NULL AND R1 IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3) c GROUP BY 1""",
)
def k30_ic_analysis(spark, sf):
    from navloom.functions.series import by

    w = by(["TICKER_SYMBOL"], "END_DATE")
    p = fx.view(spark, sf, "fx_nav").withColumns(
        {"R0": F.col("ADJ_NAV") / F.lag("ADJ_NAV").over(w) - 1, "R1": F.lead("ADJ_NAV").over(w) / F.col("ADJ_NAV") - 1}
    )
    ic = p.dropna(subset=["R0", "R1"]).join(fx.view(spark, sf, "fx_type"), "TICKER_SYMBOL").groupBy("LEVEL_1", "END_DATE").agg(F.corr("R0", "R1").alias("IC"), F.count(F.lit(1)).alias("N"))
    return rounded(perf.ic_summary(ic.where("N >= 3"), ["LEVEL_1"]))


PERIOD_VIEWS = {
    "fx_periods": """SELECT DATE_NAME, START_DATE, max(TRADE_DT) AS END_DATE FROM (
 SELECT TRADE_DT, strftime(TRADE_DT, '%Y-%m') AS DATE_NAME, MONTH_END_DATE AS START_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1
 UNION ALL SELECT TRADE_DT, concat(year(TRADE_DT), '-Q', quarter(TRADE_DT)), QUARTER_END_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1
 UNION ALL SELECT TRADE_DT, concat(year(TRADE_DT), '年'), YEAR_END_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1) t WHERE START_DATE IS NOT NULL GROUP BY 1, 2""",
    "fx_pspans": "SELECT DISTINCT START_DATE AS WIN_START, END_DATE AS WIN_END FROM fx_periods",
    **points_views("fx_fund_nav", "fx_p", "fx_pspans"),
}
_PCOLS = ["TICKER_SYMBOL", "WIN_START", "WIN_END", "CUM_RETURN", "MAXDD", "MAXDD_DATE", "MAXDD_RECOVER", "ANNUAL_VOLATILITY"]


@register("k31_performance_by_period", f"SELECT s.* EXCLUDE (WIN_START, WIN_END), p.DATE_NAME FROM ({classic_select('fx_p', _PCOLS)}) s JOIN fx_periods p ON s.WIN_START = p.START_DATE AND s.WIN_END = p.END_DATE", PERIOD_VIEWS)
def k31_performance_by_period(spark, sf):
    periods = period_table(fx.calendar(spark, sf))
    stats = perf.classic_stats(fx.view(spark, sf, "fx_fund_nav"), periods, at_risk=False).select(*_PCOLS)
    labels = periods.select("DATE_NAME", F.col("START_DATE").alias("WIN_START"), F.col("END_DATE").alias("WIN_END"))
    return rounded(stats.join(labels, ["WIN_START", "WIN_END"]).drop("WIN_START", "WIN_END"), 5)


@register("j09_period_table", "SELECT DATE_NAME, START_DATE, END_DATE FROM fx_periods", PERIOD_VIEWS)
def j09_period_table(spark, sf):
    return period_table(fx.calendar(spark, sf))


@register(
    "k32_index_period_return",
    """SELECT n.TICKER_SYMBOL, p.DATE_NAME, round((arg_max(n.ADJ_NAV, n.END_DATE) / arg_min(n.ADJ_NAV, n.END_DATE) - 1) * 100, 4) + 0.0 AS CUM_RETURN
FROM fx_nav_long n JOIN fx_periods p ON n.END_DATE BETWEEN p.START_DATE AND p.END_DATE GROUP BY n.TICKER_SYMBOL, p.DATE_NAME, p.START_DATE, p.END_DATE HAVING min(n.END_DATE) = p.START_DATE AND max(n.END_DATE) = p.END_DATE""",
    PERIOD_VIEWS,
)
def k32_index_period_return(spark, sf):
    periods = period_table(fx.calendar(spark, sf))
    stats = perf.window_stats(nav_panel(fx.view(spark, sf, "fx_nav_long")), periods)
    return rounded(perf.named_stats(stats, periods).select("TICKER_SYMBOL", "DATE_NAME", "CUM_RETURN"), 4)


@register(
    "u01_metric_registry",
    """SELECT TICKER_SYMBOL, WIN_START, WIN_END, round(100 * MDD, 4) + 0.0 AS MAXDD, round(WIN, 4) AS WIN_RATE, round(100 * CUM, 4) + 0.0 AS CUM_RETURN FROM fx_f_agg WHERE D0 = WIN_START AND D1 = WIN_END""",
    FUND,
)
def u01_metric_registry(spark, sf):
    return rounded(perf.chosen_metrics(fx.view(spark, sf, "fx_fund_nav"), fund_windows(spark, sf), ["MAXDD", "WIN_RATE", "CUM_RETURN"]), 4)


def _mean_abs_move(days, nav):
    moves = abs(nav[1:] - nav[:-1])
    known = moves[moves == moves]  # not those beside a missing value
    return known.mean() if len(known) else float("nan")


@register(
    "k33_user_metric_per_window",
    """SELECT TICKER_SYMBOL, WIN_START, WIN_END, round(avg(abs(M)), 5) AS MEAN_ABS_MOVE FROM (SELECT *, NAV - lag(NAV) OVER (PARTITION BY TICKER_SYMBOL, WIN_START, WIN_END ORDER BY END_DATE) AS M FROM fx_f_pts) t GROUP BY ALL""",
    FUND,
)
def k33_user_metric_per_window(spark, sf):
    out = perf.metric_per_window(fx.view(spark, sf, "fx_fund_nav"), fund_windows(spark, sf), _mean_abs_move, "MEAN_ABS_MOVE")
    return rounded(out, 5)


@register(
    "k35_one_window_stats",
    classic_select("fx_f", ["TICKER_SYMBOL", "START_DATE", "END_DATE", "CUM_RETURN", "MAXDD", "CALMAR_RATIO"]) + " WHERE WIN_END = (SELECT max(END_DATE) FROM fx_ends) AND WIN_START = (SELECT YEAR_END_DATE FROM fx_cal WHERE TRADE_DT = (SELECT max(END_DATE) FROM fx_ends))",
    FUND,
)
def k35_one_window_stats(spark, sf):
    cal = fx.calendar(spark, sf)
    last = cal.where("IF_TRADING_DAY = 1").agg(F.max("TRADE_DT").alias("END_DATE"))
    ytd = cal.join(last, F.col("TRADE_DT") == F.col("END_DATE")).select(F.col("YEAR_END_DATE").alias("START_DATE"), "END_DATE")
    stats = perf.classic_stats(fx.view(spark, sf, "fx_fund_nav"), ytd, at_risk=False)
    return rounded(stats.select("TICKER_SYMBOL", "START_DATE", "END_DATE", "CUM_RETURN", "MAXDD", "CALMAR_RATIO"), 5)


PROVIDER_VIEWS = {
    "fx_prov": """SELECT 'fund' AS PROVIDER, TICKER_SYMBOL, END_DATE, NAV FROM fx_fund_nav
UNION ALL SELECT 'index', TICKER_SYMBOL, END_DATE, ADJ_NAV FROM fx_nav_long
UNION ALL SELECT 'short', TICKER_SYMBOL, END_DATE, ADJ_NAV FROM fx_nav
UNION ALL SELECT 'peer', t.LEVEL_1, n.END_DATE, avg(n.NAV) FROM fx_fund_nav n JOIN fx_fund_type t USING (TICKER_SYMBOL) GROUP BY 2, 3"""
}


@register("k14_nav_providers", "SELECT PROVIDER, TICKER_SYMBOL, min(END_DATE) AS FIRST_DATE, max(END_DATE) AS LAST_DATE, count(*) AS N, round(avg(NAV), 9) AS MEAN_NAV FROM fx_prov GROUP BY 1, 2", PROVIDER_VIEWS)
def k14_nav_providers(spark, sf):
    fund = fx.view(spark, sf, "fx_fund_nav")
    peer = fund.join(fx.view(spark, sf, "fx_fund_type"), "TICKER_SYMBOL").groupBy(F.col("LEVEL_1").alias("TICKER_SYMBOL"), "END_DATE").agg(F.avg("NAV").alias("NAV"))
    named = {"fund": fund, "index": nav_panel(fx.view(spark, sf, "fx_nav_long")), "short": nav_panel(fx.view(spark, sf, "fx_nav")), "peer": peer}
    frames = [perf.typed_panel(df).withColumn("PROVIDER", F.lit(n)) for n, df in named.items()]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    return union.groupBy("PROVIDER", "TICKER_SYMBOL").agg(
        F.min("END_DATE").alias("FIRST_DATE"), F.max("END_DATE").alias("LAST_DATE"), F.count(F.lit(1)).alias("N"), F.round(F.avg("NAV"), 9).alias("MEAN_NAV")
    )
