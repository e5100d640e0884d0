"""Portfolio jobs: roll-forward, contribution, turnover, limits, reports, ledger."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from navloom.catalog.base import half_up, register, rounded
from navloom.catalog.aggregates import COV_VIEWS, index_returns
from navloom.catalog.performance import WINDOW_VIEWS, clip, fund_windows, points_views
from navloom.functions.series import by, daily_return
from navloom.operators.aggregates import union_all
from navloom.operators.calendars import period_ends
from navloom.plans import alpha as al
from navloom.plans import ledger as lg
from navloom.plans import performance as perf
from navloom.plans import portfolio as pf
from navloom.plans import risk as rk
from navloom.session import cut_lineage
from navloom.sources import fixtures as fx

P, T, DAY, D = "PORTFOLIO_NAME", "TICKER_SYMBOL", "TRADE_DT", "END_DATE"

DRIFT = {
    "fx_reb": "SELECT *, lead(PS) OVER (PARTITION BY PORTFOLIO_NAME ORDER BY PS) AS NS FROM (SELECT DISTINCT PORTFOLIO_NAME, TRADE_DT AS PS FROM fx_targets) t",
    "fx_dw0": "SELECT t.PORTFOLIO_NAME, t.TICKER_SYMBOL, b.PS, t.WEIGHT, d.TRADE_DT, coalesce(r.RETURN_RATE, 0) AS R FROM fx_targets t JOIN fx_reb b ON b.PORTFOLIO_NAME = t.PORTFOLIO_NAME AND b.PS = t.TRADE_DT JOIN fx_trading d ON d.TRADE_DT >= b.PS AND d.TRADE_DT < coalesce(b.NS, DATE '2099-12-31') LEFT JOIN fx_ret r ON r.TICKER_SYMBOL = t.TICKER_SYMBOL AND r.TRADE_DT = d.TRADE_DT",
    "fx_dw1": "SELECT *, WEIGHT * exp(sum(ln(1 + R / 100)) OVER (PARTITION BY PORTFOLIO_NAME, PS, TICKER_SYMBOL ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)) AS G1 FROM fx_dw0",
    "fx_dw2": "SELECT *, coalesce(lag(G1) OVER (PARTITION BY PORTFOLIO_NAME, PS, TICKER_SYMBOL ORDER BY TRADE_DT), WEIGHT) AS G0 FROM fx_dw1",
    "fx_dw": "SELECT PORTFOLIO_NAME, TRADE_DT, TICKER_SYMBOL, PS, CASE WHEN TRADE_DT = PS THEN WEIGHT ELSE G0 / sum(G0) OVER q * 100 END AS SW, R, ln(1 + R / 100) * 100 AS LR, CASE WHEN TRADE_DT = PS THEN WEIGHT ELSE G0 / sum(G0) OVER q * 100 END * R / 100 AS WR, G1 / sum(G1) OVER q * 100 AS EW FROM fx_dw2 WINDOW q AS (PARTITION BY PORTFOLIO_NAME, TRADE_DT)",
    "fx_pret": "SELECT PORTFOLIO_NAME, TRADE_DT, sum(WR) AS RR FROM fx_dw GROUP BY 1, 2",
    "fx_pinfo": "SELECT PORTFOLIO_NAME, min(TRADE_DT) AS LISTED_DATE, CAST(length(PORTFOLIO_NAME) % 2 AS INTEGER) AS INCLUDE_QDII, CAST(length(PORTFOLIO_NAME) AS INTEGER) AS ORDER_ID FROM fx_targets GROUP BY 1",
    "fx_acc": "SELECT PORTFOLIO_NAME, TRADE_DT, (exp(sum(ln(1 + RR / 100)) OVER (PARTITION BY PORTFOLIO_NAME ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)) - 1) * 100 AS ACC FROM (SELECT p.PORTFOLIO_NAME, p.TRADE_DT, p.RR FROM fx_pret p JOIN fx_pinfo i USING (PORTFOLIO_NAME) WHERE p.TRADE_DT > i.LISTED_DATE UNION ALL SELECT PORTFOLIO_NAME, LISTED_DATE, 0 FROM fx_pinfo) t",
}


def index_rates(spark, sf):
    nav = fx.view(spark, sf, "fx_nav_long").join(fx.trading_days(fx.calendar(spark, sf)).withColumnRenamed(DAY, D), D, "left_semi")
    smooth = 100 + 20 * F.col("ADJ_NAV") / (F.col("ADJ_NAV") + 200)
    return nav.select(T, F.col(D).alias(DAY), (daily_return(smooth, by([T], D)) * 100).alias("RETURN_RATE")).where("RETURN_RATE IS NOT NULL")


def targets(spark, sf):
    """Target weights moved to the first trading day on or after their date."""
    weights = fx.view(spark, sf, "fx_weights")
    days = fx.trading_days(fx.calendar(spark, sf)).withColumnRenamed(DAY, "_T")
    since = F.coalesce(F.date_add(F.lag("_T").over(by([F.lit(0)], "_T")), 1), F.date_sub("_T", 366))  # one row per trading day
    moved = days.withColumn("_SINCE", since).select("_T", F.explode(F.sequence("_SINCE", "_T", F.expr("INTERVAL 1 DAY"))).alias(DAY))
    return weights.join(moved, DAY).select(P, F.col("_T").alias(DAY), T, "WEIGHT")


def drift_plan(spark, sf):
    return pf.drifted_weights(targets(spark, sf), index_rates(spark, sf), fx.trading_days(fx.calendar(spark, sf)))


def drifted(spark, sf):
    """The weights table that the jobs after the roll-forward read, several of them more than once."""
    return cut_lineage(drift_plan(spark, sf))


def pinfo(spark, sf):
    return targets(spark, sf).groupBy(P).agg(F.min(DAY).alias("LISTED_DATE")).withColumns({"INCLUDE_QDII": F.length(P) % 2, "ORDER_ID": F.length(P)})


def accumulated(spark, sf):
    ret = pf.daily_returns(drifted(spark, sf))
    return pf.accumulated(ret, {"RETURN_RATE": "ACCUMULATED"}, pinfo(spark, sf).select(P, "LISTED_DATE"))


_W6 = "PORTFOLIO_NAME, TRADE_DT, TICKER_SYMBOL, round(SW, 6) AS START_WEIGHT, round(R, 6) + 0.0 AS RETURN_RATE, round(LR, 6) + 0.0 AS LOG_RETURN, round(WR, 6) + 0.0 AS WEIGHT_RETURN, round(EW, 6) AS END_WEIGHT"


@register("m01_weight_drift", f"SELECT {_W6} FROM fx_dw", DRIFT)
def m01_weight_drift(spark, sf):
    return rounded(drift_plan(spark, sf).drop("PERIOD_START"))


@register("a13_insert_select_upsert", "SELECT PORTFOLIO_NAME, TRADE_DT, round(RR, 6) + 0.0 AS RETURN_RATE, round(ln(1 + RR / 100) * 100, 6) + 0.0 AS LOG_RETURN_RATE FROM fx_pret", DRIFT)
def a13_insert_select_upsert(spark, sf):
    from navloom.sources.ingest import merge_rows

    computed = pf.daily_returns(drifted(spark, sf))
    stored = computed.where("TRADE_DT < DATE '1999-01-01'").withColumn("RETURN_RATE", F.lit(0.0))
    return rounded(merge_rows(stored, computed, [P, DAY], [DAY]))


@register("m02_portfolio_daily_return", "SELECT PORTFOLIO_NAME, TRADE_DT, round(RR, 6) + 0.0 AS RETURN_RATE, round(ln(1 + RR / 100) * 100, 6) + 0.0 AS LOG_RETURN_RATE FROM fx_pret", DRIFT)
def m02_portfolio_daily_return(spark, sf):
    return rounded(pf.daily_returns(drifted(spark, sf)))


MIX = {
    **DRIFT,
    "fx_mix": "SELECT PORTFOLIO_NAME, CODE, TYPE, 100 * CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY PORTFOLIO_NAME, TYPE) AS DOUBLE) AS WEIGHT FROM (SELECT c_mktsegment AS PORTFOLIO_NAME, concat('S', CAST(c_nationkey % 3 AS VARCHAR(5))) AS CODE, CASE WHEN c_nationkey % 3 = 0 THEN 'FUND_MEDIAN' ELSE 'TO_CLIENT' END AS TYPE, count(*) AS n FROM customer GROUP BY 1, 2, 3) t",
    "fx_bret": "SELECT r.TRADE_DT, m.PORTFOLIO_NAME, sum(CASE WHEN TYPE = 'TO_CLIENT' THEN WEIGHT * RETURN_RATE / 100 ELSE 0 END) AS INNER_RET, sum(CASE WHEN TYPE = 'FUND_MEDIAN' THEN WEIGHT * RETURN_RATE / 100 ELSE 0 END) AS MEDIAN_RET FROM fx_mix m JOIN fx_ret r ON r.TICKER_SYMBOL = m.CODE AND r.RETURN_RATE IS NOT NULL GROUP BY 1, 2",
}


def blended(spark, sf):
    c = fx.table(spark, sf, "customer")
    counted = c.groupBy(F.col("c_mktsegment").alias(P), F.concat(F.lit("S"), (F.col("c_nationkey") % 3).cast("string")).alias("BENCHMARK_CODE"), F.when(F.col("c_nationkey") % 3 == 0, "FUND_MEDIAN").otherwise("TO_CLIENT").alias("BENCHMARK_TYPE")).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.groupBy(P, "BENCHMARK_TYPE").agg(F.sum("_n").alias("_t"))
    mix = counted.join(total, [P, "BENCHMARK_TYPE"]).withColumn("WEIGHT", 100 * F.col("_n") / F.col("_t"))
    return pf.blended_benchmark(mix, index_rates(spark, sf), {"TO_CLIENT": "BENCHMARK_RET_INNER", "FUND_MEDIAN": "FUND_MEDIAN_RET"})


@register("m03_blended_benchmark", "SELECT TRADE_DT, PORTFOLIO_NAME, round(INNER_RET, 6) + 0.0 AS BENCHMARK_RET_INNER, round(MEDIAN_RET, 6) + 0.0 AS FUND_MEDIAN_RET FROM fx_bret", MIX)
def m03_blended_benchmark(spark, sf):
    return rounded(blended(spark, sf))


@register("m04_compounded_accumulation", "SELECT PORTFOLIO_NAME, TRADE_DT, round(ACC, 5) + 0.0 AS ACCUMULATED FROM fx_acc", DRIFT)
def m04_compounded_accumulation(spark, sf):
    return rounded(accumulated(spark, sf).drop("RETURN_RATE"), 5)


BACK = {
    **DRIFT,
    "fx_tt": "SELECT 'T1' AS TEST_CODE, * FROM fx_targets UNION ALL SELECT 'T2', PORTFOLIO_NAME, TRADE_DT, TICKER_SYMBOL, 100.0::DOUBLE / count(*) OVER (PARTITION BY PORTFOLIO_NAME, TRADE_DT) FROM fx_targets",
    "fx_t0": "SELECT t.TEST_CODE, t.PORTFOLIO_NAME, t.TICKER_SYMBOL, b.PS, t.WEIGHT, d.TRADE_DT, coalesce(r.RETURN_RATE, 0) AS R FROM fx_tt t JOIN fx_reb b ON b.PORTFOLIO_NAME = t.PORTFOLIO_NAME AND b.PS = t.TRADE_DT JOIN fx_trading d ON d.TRADE_DT >= b.PS AND d.TRADE_DT < coalesce(b.NS, DATE '2099-12-31') LEFT JOIN fx_ret r ON r.TICKER_SYMBOL = t.TICKER_SYMBOL AND r.TRADE_DT = d.TRADE_DT",
    "fx_t1": "SELECT *, WEIGHT * exp(sum(ln(1 + R / 100)) OVER (PARTITION BY TEST_CODE, PORTFOLIO_NAME, PS, TICKER_SYMBOL ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)) AS G1 FROM fx_t0",
    "fx_t2": "SELECT TEST_CODE, PORTFOLIO_NAME, TRADE_DT, sum(G0 * R) / sum(G0) AS RR FROM (SELECT *, coalesce(lag(G1) OVER (PARTITION BY TEST_CODE, PORTFOLIO_NAME, PS, TICKER_SYMBOL ORDER BY TRADE_DT), WEIGHT) AS G0 FROM fx_t1) z GROUP BY 1, 2, 3",
}


@register(
    "m05_backtest",
    "SELECT TEST_CODE, PORTFOLIO_NAME, TRADE_DT, round(exp(sum(ln(1 + RR / 100)) OVER w), 6) AS NAV, round(exp(sum(ln(1 + B / 100)) OVER w), 6) AS BENCH_NAV FROM (SELECT t.*, coalesce(r.RETURN_RATE, 0) AS B FROM fx_t2 t LEFT JOIN fx_ret r ON r.TRADE_DT = t.TRADE_DT AND r.TICKER_SYMBOL = 'S1') z WINDOW w AS (PARTITION BY TEST_CODE, PORTFOLIO_NAME ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)",
    BACK,
)
def m05_backtest(spark, sf):
    t = targets(spark, sf)
    sizes = t.groupBy(P, DAY).agg((100.0 / F.count(F.lit(1))).alias("_E"))
    equal = t.join(sizes, [P, DAY]).select(F.lit("T2").alias("TEST_CODE"), P, DAY, T, F.col("_E").alias("WEIGHT"))
    both = t.withColumn("TEST_CODE", F.lit("T1")).unionByName(equal)
    rates = index_rates(spark, sf)
    out = pf.backtest(both, rates, fx.trading_days(fx.calendar(spark, sf)), rates.where("TICKER_SYMBOL = 'S1'"))
    return rounded(out.select("TEST_CODE", P, DAY, "NAV", "BENCH_NAV"))


PROVIDERS = {
    **BACK,
    **MIX,
    "fx_six": """SELECT 'fund' AS PROVIDER, TICKER_SYMBOL, END_DATE, NAV FROM fx_fund_nav
UNION ALL SELECT 'portfolio', PORTFOLIO_NAME, TRADE_DT, 1 + ACC / 100 FROM fx_acc
UNION ALL SELECT 'derived portfolio', PORTFOLIO_NAME, TRADE_DT, exp(sum(ln(1 + RR / 100)) OVER (PARTITION BY PORTFOLIO_NAME ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)) FROM fx_t2 WHERE TEST_CODE = 'T2'
UNION ALL SELECT 'inner benchmark', PORTFOLIO_NAME, TRADE_DT, exp(sum(ln(1 + INNER_RET / 100)) OVER (PARTITION BY PORTFOLIO_NAME ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)) FROM fx_bret
UNION ALL SELECT 'outer benchmark', TICKER_SYMBOL, END_DATE, ADJ_NAV FROM fx_nav_long
UNION ALL SELECT 'peer portfolio', t.LEVEL_1, n.END_DATE, avg(n.NAV) FROM fx_fund_nav n JOIN fx_fund_type t USING (TICKER_SYMBOL) GROUP BY 2, 3""",
}


def nav_providers(spark, sf):
    """NAV rows of the six providers in one panel."""
    fund = fx.view(spark, sf, "fx_fund_nav")
    peer = fund.join(fx.view(spark, sf, "fx_fund_type"), T).groupBy(F.col("LEVEL_1").alias(T), D).agg(F.avg("NAV").alias("NAV"))
    days, rates = fx.trading_days(fx.calendar(spark, sf)), index_rates(spark, sf)
    t = targets(spark, sf)
    sizes = t.groupBy(P, DAY).agg((100.0 / F.count(F.lit(1))).alias("WEIGHT"))
    equal = t.drop("WEIGHT").join(sizes, [P, DAY]).select(F.lit("T2").alias("TEST_CODE"), P, DAY, T, "WEIGHT")
    derived = pf.backtest(equal, rates, days, rates.where("TICKER_SYMBOL = 'S1'")).select(F.col(P).alias(T), F.col(DAY).alias(D), "NAV")
    inner = blended(spark, sf).select(F.col(P).alias(T), F.col(DAY).alias(D), F.exp(F.sum(F.log1p(F.col("BENCHMARK_RET_INNER") / 100)).over(by([P], DAY).rowsBetween(Window.unboundedPreceding, 0))).alias("NAV"))
    outer = fx.view(spark, sf, "fx_nav_long").select(T, D, F.col("ADJ_NAV").alias("NAV"))
    named = {"fund": fund, "portfolio": portfolio_nav(spark, sf), "derived portfolio": derived, "inner benchmark": inner, "outer benchmark": outer, "peer portfolio": peer}
    return union_all([perf.typed_panel(df).withColumn("PROVIDER", F.lit(n)) for n, df in named.items()])


@register("k14_six_nav_providers", f"SELECT PROVIDER, TICKER_SYMBOL, END_DATE, {half_up('NAV', 6)} AS NAV FROM fx_six", PROVIDERS)
def k14_six_nav_providers(spark, sf):
    return rounded(nav_providers(spark, sf).select("PROVIDER", T, D, "NAV"))


CONTRIB = {
    **DRIFT,
    "fx_a0": "SELECT TICKER_SYMBOL, TRADE_DT, ln(1 + RETURN_RATE / 100) * 100 - avg(ln(1 + RETURN_RATE / 100) * 100) OVER (PARTITION BY TRADE_DT) AS LA FROM fx_ret WHERE RETURN_RATE IS NOT NULL",
    "fx_pc": "SELECT w.PORTFOLIO_NAME, w.TICKER_SYMBOL, w.PS, min(w.TRADE_DT) AS D0, max(w.TRADE_DT) AS D1, arg_min(SW, w.TRADE_DT) AS SW, arg_max(EW, w.TRADE_DT) AS EW, (exp(sum(LR) / 100) - 1) * 100 AS SR, (exp(sum(coalesce(a.LA, 0)) / 100) - 1) * 100 AS SA FROM fx_dw w LEFT JOIN fx_a0 a ON a.TICKER_SYMBOL = w.TICKER_SYMBOL AND a.TRADE_DT = w.TRADE_DT GROUP BY 1, 2, 3",
    "fx_lk": "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, (exp(sum(ln(1 + SW * SR / 10000))) - 1) * 100 AS RC, (exp(sum(ln(1 + SW * SA / 10000))) - 1) * 100 AS AC, (exp(sum(ln(1 + SR / 100))) - 1) * 100 AS SR FROM fx_pc GROUP BY 1, 2",
}


def contributions(spark, sf):
    rates = index_rates(spark, sf)
    logs = rates.select(T, DAY, (F.log1p(F.col("RETURN_RATE") / 100) * 100).alias("L"))
    mean = logs.groupBy(DAY).agg(F.avg("L").alias("M"))
    alpha = logs.join(mean, DAY).select(T, DAY, (F.col("L") - F.col("M")).alias("LOG_ALPHA"))
    return pf.period_contribution(drifted(spark, sf), alpha)


@register("m06_period_contribution", "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, PS AS PERIOD_START, D0 AS START_TRADE_DT, D1 AS END_TRADE_DT, round(SW, 5) AS START_WEIGHT, round(EW, 5) AS END_WEIGHT, round(SR, 5) + 0.0 AS SUM_PERIOD_RETURN, round(SA, 5) + 0.0 AS SUM_PERIOD_ALPHA, round(SW * SR / 100, 5) + 0.0 AS PERIOD_RETURN_CONTRIBUTION, round(SW * SA / 100, 5) + 0.0 AS PERIOD_ALPHA_CONTRIBUTION FROM fx_pc", CONTRIB)
def m06_period_contribution(spark, sf):
    return rounded(contributions(spark, sf), 5)


_LINK = ["SUM_PERIOD_RETURN", "PERIOD_RETURN_CONTRIBUTION", "PERIOD_ALPHA_CONTRIBUTION"]


@register(
    "m07_linked_contribution",
    "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, round(SR, 4) + 0.0 AS SUM_PERIOD_RETURN, round(RC, 4) + 0.0 AS PERIOD_RETURN_CONTRIBUTION, round(AC, 4) + 0.0 AS PERIOD_ALPHA_CONTRIBUTION, round(RC / sum(RC) OVER (PARTITION BY PORTFOLIO_NAME) * 100, 4) + 0.0 AS PERIOD_RETURN_CONTRIBUTION_PCT FROM fx_lk",
    CONTRIB,
)
def m07_linked_contribution(spark, sf):
    return rounded(pf.linked_contribution(contributions(spark, sf), _LINK).drop("PERIOD_ALPHA_CONTRIBUTION_PCT"), 4)


@register(
    "m07_contribution_rollup",
    "SELECT PORTFOLIO_NAME, coalesce(CLASS, 'ALL') AS CLASS, coalesce(TICKER_SYMBOL, 'ALL') AS TICKER_SYMBOL, round(sum(RC), 4) + 0.0 AS PERIOD_RETURN_CONTRIBUTION FROM (SELECT *, CASE WHEN TICKER_SYMBOL < 'S5' THEN 'low' ELSE 'high' END AS CLASS FROM fx_lk) t GROUP BY ROLLUP (PORTFOLIO_NAME, CLASS, TICKER_SYMBOL) HAVING PORTFOLIO_NAME IS NOT NULL",
    CONTRIB,
)
def m07_contribution_rollup(spark, sf):
    linked = pf.linked_contribution(contributions(spark, sf), _LINK)
    classes = linked.select(T).distinct().withColumn("CLASS", F.when(F.col(T) < "S5", "low").otherwise("high"))
    return rounded(pf.contribution_rollup(linked, classes, ["PERIOD_RETURN_CONTRIBUTION"]), 4)


TURN = {
    **DRIFT,
    "fx_turn": "SELECT PORTFOLIO_NAME, TRADE_DT, sum(abs(N - O)) / 2 AS TURNOVER FROM (SELECT coalesce(n.PORTFOLIO_NAME, o.PORTFOLIO_NAME) AS PORTFOLIO_NAME, coalesce(n.TRADE_DT, o.TRADE_DT) AS TRADE_DT, coalesce(n.SW, 0) AS N, coalesce(o.EW, 0) AS O FROM (SELECT * FROM fx_dw w WHERE TRADE_DT = PS AND EXISTS (SELECT 1 FROM fx_reb b WHERE b.PORTFOLIO_NAME = w.PORTFOLIO_NAME AND b.PS < w.PS)) n FULL JOIN (SELECT w.PORTFOLIO_NAME, w.TICKER_SYMBOL, c.TRADE_DT, w.EW FROM fx_dw w JOIN fx_cal c ON c.PREV_TRADE_DATE = w.TRADE_DT JOIN fx_reb b ON b.PORTFOLIO_NAME = w.PORTFOLIO_NAME AND b.PS = c.TRADE_DT) o ON o.PORTFOLIO_NAME = n.PORTFOLIO_NAME AND o.TICKER_SYMBOL = n.TICKER_SYMBOL AND o.TRADE_DT = n.TRADE_DT) t GROUP BY 1, 2",
}


@register("m08_rebalance_turnover", "SELECT PORTFOLIO_NAME, TRADE_DT, round(TURNOVER, 5) AS TURNOVER FROM fx_turn", TURN)
def m08_rebalance_turnover(spark, sf):
    return rounded(pf.turnover(drifted(spark, sf), fx.calendar(spark, sf)), 5)


@register("m08_turnover_over_range", "SELECT PORTFOLIO_NAME, round(sum(TURNOVER), 5) AS TURNOVER FROM fx_turn WHERE TRADE_DT > DATE '1996-06-30' AND TRADE_DT <= DATE '1999-06-30' GROUP BY 1", TURN)
def m08_turnover_over_range(spark, sf):
    turns = pf.turnover(drifted(spark, sf), fx.calendar(spark, sf))
    return rounded(pf.turnover_between(turns, F.to_date(F.lit("1996-06-30")), F.to_date(F.lit("1999-06-30"))), 5)


PROPOSED = {
    "fx_prop": "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT FROM fx_weights WHERE TRADE_DT = DATE '1999-01-01'",
    "fx_curr": "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT FROM fx_weights WHERE TRADE_DT = DATE '1998-01-01'",
    "fx_pt": "SELECT PORTFOLIO_NAME, sum(abs(coalesce(n.WEIGHT, 0) - coalesce(o.WEIGHT, 0))) / 2 AS TURNOVER FROM fx_prop n FULL JOIN (SELECT * FROM fx_curr WHERE PORTFOLIO_NAME IN (SELECT PORTFOLIO_NAME FROM fx_prop)) o USING (PORTFOLIO_NAME, TICKER_SYMBOL) GROUP BY 1",
}


def proposal(spark, sf):
    w = fx.view(spark, sf, "fx_weights")
    prop = w.where("TRADE_DT = DATE '1999-01-01'").drop(DAY)
    return prop, w.where("TRADE_DT = DATE '1998-01-01'").drop(DAY)


@register("m09_proposed_turnover", "SELECT PORTFOLIO_NAME, round(TURNOVER, 6) AS TURNOVER FROM fx_pt", PROPOSED)
def m09_proposed_turnover(spark, sf):
    return rounded(pf.proposed_turnover(*proposal(spark, sf)))


def compliance_views(holding: str) -> dict[str, str]:
    return {
        **TURN,
        **PROPOSED,
        "fx_h": f"SELECT PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT, CASE WHEN TICKER_SYMBOL = 'S1' THEN 'S9' END AS ALTERNATIVE FROM {holding}",
        "fx_pool": "SELECT concat('S', k) AS TICKER_SYMBOL, CASE WHEN k < 5 THEN '核心池' ELSE '优选池' END AS TRANCHE, CAST(1 + k % 5 AS DOUBLE) AS MEDIAN, 100.0::DOUBLE AS FIRST_BUY, CASE WHEN k % 4 = 0 THEN 'ALPHA' WHEN k % 4 = 1 THEN 'BETA' ELSE 'GAMMA' END AS COMPANY, CASE WHEN k % 2 = 0 THEN 'EQUITY' ELSE 'BOND' END AS ASSET_TYPE FROM (SELECT DISTINCT s_suppkey % 10 AS k FROM supplier) s WHERE k <> 7",
        "fx_ci": "SELECT DISTINCT c_mktsegment AS PORTFOLIO_NAME, CASE WHEN c_mktsegment < 'F' THEN 'R3' ELSE 'R2' END AS RISK_LEVEL, CASE WHEN c_mktsegment < 'F' THEN 1200.0::DOUBLE ELSE 1000.0::DOUBLE END AS FIRST_BUY FROM customer",
        "fx_c1": "SELECT PORTFOLIO_NAME, '校验组合权重之和' AS CHK, round(sum(WEIGHT) - 100, 4) = 0 AS OK, '权重之和不为100' AS NOTE FROM fx_h GROUP BY 1",
        "fx_c2": "SELECT PORTFOLIO_NAME, '校验基金是否在池及比例', max(BAD) = 0, concat('不在池内或超过上限: ', coalesce(string_agg(DISTINCT CASE WHEN BAD = 1 THEN T END, ',' ORDER BY CASE WHEN BAD = 1 THEN T END), '')) FROM (SELECT u.PORTFOLIO_NAME, u.T, CASE WHEN p.TRANCHE IS NULL OR u.WEIGHT > CASE p.TRANCHE WHEN '优选池' THEN 10 ELSE 20 END THEN 1 ELSE 0 END AS BAD FROM (SELECT PORTFOLIO_NAME, WEIGHT, TICKER_SYMBOL AS T FROM fx_h UNION ALL SELECT PORTFOLIO_NAME, WEIGHT, ALTERNATIVE FROM fx_h WHERE ALTERNATIVE IS NOT NULL) u LEFT JOIN fx_pool p ON p.TICKER_SYMBOL = u.T) b GROUP BY 1",
        "fx_c3": "SELECT h.PORTFOLIO_NAME, '校验关联基金权重', round(sum(CASE WHEN p.COMPANY IN ('ALPHA', 'BETA') THEN WEIGHT ELSE 0 END), 6) <= 40, '关联方基金超过40%' FROM fx_h h LEFT JOIN fx_pool p USING (TICKER_SYMBOL) GROUP BY 1",
        "fx_c4": "SELECT s.PORTFOLIO_NAME, '校验风险等级是否一致', coalesce(LV = RISK_LEVEL, false), concat('预期', RISK_LEVEL, ',实际', coalesce(LV, '无')) FROM (SELECT PORTFOLIO_NAME, CASE WHEN S BETWEEN 0 AND 2.5 THEN 'R2' WHEN S BETWEEN 2.5 AND 5 THEN 'R3' END AS LV FROM (SELECT h.PORTFOLIO_NAME, sum(WEIGHT * MEDIAN) / 100 AS S FROM fx_h h LEFT JOIN fx_pool p USING (TICKER_SYMBOL) GROUP BY 1) z) s JOIN fx_ci i ON i.PORTFOLIO_NAME = s.PORTFOLIO_NAME",
        "fx_c5": "SELECT PORTFOLIO_NAME, '校验资产配置是否符合说明书要求', max(BAD) = 0, concat(coalesce(string_agg(CASE WHEN BAD = 1 THEN A END, ',' ORDER BY A), ''), '不符合要求') FROM (SELECT PORTFOLIO_NAME, A, CASE WHEN (A = 'EQUITY' AND W BETWEEN 39.99 AND 60.01) OR (A = 'BOND' AND W BETWEEN 19.99 AND 45.01) THEN 0 ELSE 1 END AS BAD FROM (SELECT h.PORTFOLIO_NAME, p.ASSET_TYPE AS A, sum(WEIGHT) AS W FROM fx_h h LEFT JOIN fx_pool p USING (TICKER_SYMBOL) GROUP BY 1, 2) q) r GROUP BY 1",
        "fx_c6": "SELECT h.PORTFOLIO_NAME, '检验过去1年换手率', coalesce(t.V, 0) <= 200, concat('过去1年换手率', printf('%.2f', coalesce(t.V, 0)), '%') FROM (SELECT DISTINCT PORTFOLIO_NAME FROM fx_h) h LEFT JOIN (SELECT PORTFOLIO_NAME, sum(TURNOVER) AS V FROM fx_turn WHERE TRADE_DT > DATE '1998-01-05' AND TRADE_DT <= DATE '1999-01-05' GROUP BY 1) t USING (PORTFOLIO_NAME)",
        "fx_c7": "SELECT n.PORTFOLIO_NAME, '校验起投金额', NEED <= i.FIRST_BUY, concat('首次买入金额', printf('%.2f', NEED), '大于', printf('%.2f', i.FIRST_BUY)) FROM (SELECT h.PORTFOLIO_NAME, max(p.FIRST_BUY / WEIGHT) * 100 AS NEED FROM fx_h h JOIN fx_pool p USING (TICKER_SYMBOL) GROUP BY 1) n JOIN fx_ci i USING (PORTFOLIO_NAME)",
        "fx_checks": 'SELECT PORTFOLIO_NAME, CHK AS "CHECK", CASE WHEN OK THEN \'通过\' ELSE \'失败\' END AS RESULT, CASE WHEN NOT OK THEN NOTE END AS NOTE FROM (' + " UNION ALL ".join(f"SELECT * FROM fx_c{i}" for i in range(1, 8)) + ") u",
    }


def _compliance(spark, sf, holdings):
    h = holdings.withColumn("ALTERNATIVE", F.when(F.col(T) == "S1", "S9"))
    k = fx.table(spark, sf, "supplier").select((F.col("s_suppkey") % 10).alias("k")).distinct().where("k <> 7")
    pool = k.select(
        F.concat(F.lit("S"), F.col("k").cast("string")).alias(T), F.when(F.col("k") < 5, "核心池").otherwise("优选池").alias("TRANCHE"), (1 + F.col("k") % 5).cast("double").alias("MEDIAN"), F.lit(100.0).alias("FIRST_BUY"),
        F.when(F.col("k") % 4 == 0, "ALPHA").when(F.col("k") % 4 == 1, "BETA").otherwise("GAMMA").alias("MANAGEMENT_COMPANY_NAME"), F.when(F.col("k") % 2 == 0, "EQUITY").otherwise("BOND").alias("ASSET_TYPE"),
    )
    segments = fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias(P)).distinct()
    low = F.col(P) < "F"
    info = segments.select(P, F.when(low, "R3").otherwise("R2").alias("RISK_LEVEL"), F.when(low, 1200.0).otherwise(1000.0).alias("FIRST_BUY"))
    bands = spark.createDataFrame([(0.0, 2.5, "R2"), (2.5, 5.0, "R3")], "MIN double, MAX double, LEVEL string")
    limits = segments.select(P, F.inline(F.array(F.struct(F.lit("EQUITY").alias("ASSET_TYPE"), F.lit(40.0).alias("MIN"), F.lit(60.0).alias("MAX")), F.struct(F.lit("BOND").alias("ASSET_TYPE"), F.lit(20.0).alias("MIN"), F.lit(45.0).alias("MAX")))))
    turns = pf.turnover_between(pf.turnover(drifted(spark, sf), fx.calendar(spark, sf)), F.to_date(F.lit("1998-01-05")), F.to_date(F.lit("1999-01-05")))
    return rk.compliance(h, pool, pool.select(T, "MANAGEMENT_COMPANY_NAME"), ["ALPHA", "BETA"], bands, info, pool.select(T, "ASSET_TYPE"), limits, turns)


@register("m10_compliance_checks", 'SELECT PORTFOLIO_NAME, "CHECK", RESULT, NOTE FROM fx_checks', compliance_views("fx_weights WHERE TRADE_DT = DATE '1999-01-01'"))
def m10_compliance_checks(spark, sf):
    return _compliance(spark, sf, fx.view(spark, sf, "fx_weights").where("TRADE_DT = DATE '1999-01-01'").drop(DAY))


@register("m11_check_proposed", 'SELECT c.PORTFOLIO_NAME, "CHECK", RESULT, NOTE, round(p.TURNOVER, 4) AS PENDING_TURNOVER FROM fx_checks c JOIN fx_pt p USING (PORTFOLIO_NAME)', compliance_views("fx_prop"))
def m11_check_proposed(spark, sf):
    prop, current = proposal(spark, sf)
    pending = pf.proposed_turnover(prop, current).select(P, F.round("TURNOVER", 4).alias("PENDING_TURNOVER"))
    return _compliance(spark, sf, prop).join(pending, P)


@register(
    "m12_risk_decomposition",
    "SELECT w.PORTFOLIO_NAME, w.TICKER_SYMBOL, round(s.S, 4) AS PORTFOLIO_STD, round(m.M / s.S, 4) + 0.0 AS MARGINAL, round(w.WEIGHT / 100 * m.M / s.S, 4) + 0.0 AS CONTRIBUTION FROM fx_wt w JOIN fx_mw m USING (PORTFOLIO_NAME, TICKER_SYMBOL) JOIN (SELECT PORTFOLIO_NAME, sqrt(sum(WEIGHT / 100 * M)) AS S FROM fx_wt JOIN fx_mw USING (PORTFOLIO_NAME, TICKER_SYMBOL) GROUP BY 1) s USING (PORTFOLIO_NAME)",
    {**COV_VIEWS, "fx_wt": "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT FROM fx_weights WHERE TRADE_DT = DATE '1999-01-01'", "fx_mw": "SELECT w.PORTFOLIO_NAME, c.A AS TICKER_SYMBOL, sum(c.COV * w.WEIGHT / 100) AS M FROM fx_wt w JOIN fx_cov c ON c.B = w.TICKER_SYMBOL GROUP BY 1, 2"},
)
def m12_risk_decomposition(spark, sf):
    w = fx.view(spark, sf, "fx_weights").where("TRADE_DT = DATE '1999-01-01'").select(P, T, (F.col("WEIGHT") / 100).alias("WEIGHT"))
    return rounded(rk.decomposition(w, index_returns(spark, sf), D, "R").select(P, T, "PORTFOLIO_STD", "MARGINAL", "CONTRIBUTION"), 4)


# --- reports ---

PEER = {
    **DRIFT,
    **WINDOW_VIEWS,
    "fx_pnav": "SELECT PORTFOLIO_NAME AS TICKER_SYMBOL, TRADE_DT AS END_DATE, 1 + ACC / 100 AS NAV FROM fx_acc",
    **points_views("fx_pnav", "fx_q", "fx_spans"),
    **points_views("fx_fund_nav", "fx_f", "fx_spans"),
    **{
        f"fx_m{n}": f"SELECT TICKER_SYMBOL, START_DATE, END_DATE, INDICATOR, VALUE FROM (UNPIVOT (SELECT TICKER_SYMBOL, START_DATE, END_DATE, {', '.join(clip(c) for c in pf.PEER_MEASURES)} FROM fx_{n}_stats WHERE START_DATE = WIN_START AND END_DATE = WIN_END) ON {', '.join(pf.PEER_MEASURES)} INTO NAME INDICATOR VALUE VALUE) u"
        for n in ("q", "f")
    },
    "fx_segs": "SELECT PORTFOLIO_NAME, CAST(row_number() OVER (ORDER BY PORTFOLIO_NAME) - 1 AS BIGINT) AS K FROM (SELECT DISTINCT c_mktsegment AS PORTFOLIO_NAME FROM customer) c",
    "fx_peers": "SELECT m.*, s.PORTFOLIO_NAME FROM fx_mf m JOIN fx_segs s ON s.K = CAST(substr(m.TICKER_SYMBOL, 2) AS BIGINT) % 5",
    "fx_allp": "SELECT *, CASE WHEN INDICATOR IN ('MAXDD', 'ANNUAL_VOLATILITY') THEN -VALUE ELSE VALUE END AS V FROM (SELECT * FROM fx_peers UNION ALL SELECT *, TICKER_SYMBOL FROM fx_mq) u",
    "fx_prank": "SELECT *, floor(rank() OVER (PARTITION BY PORTFOLIO_NAME, START_DATE, END_DATE, INDICATOR ORDER BY V DESC) + (count(*) OVER (PARTITION BY PORTFOLIO_NAME, START_DATE, END_DATE, INDICATOR, V) - 1) / 2.0) AS RK, count(V) OVER (PARTITION BY PORTFOLIO_NAME, START_DATE, END_DATE, INDICATOR) AS N FROM fx_allp",
}
_NAMES = "CASE p.INDICATOR " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pf.MEASURE_NAMES.items()) + " END"


def portfolio_nav(spark, sf):
    return accumulated(spark, sf).select(F.col(P).alias(T), F.col(DAY).alias(D), (1 + F.col("ACCUMULATED") / 100).alias("NAV"))


def segments(spark, sf):
    seg = fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias(P)).distinct()
    return seg.withColumn("K", F.row_number().over(by([F.lit(0)], P)) - 1)  # five market segments


@register(
    "m13_peer_table",
    f"SELECT p.TICKER_SYMBOL, p.START_DATE, p.END_DATE, {_NAMES} AS INDICATOR, w.DATE_NAME AS CYCLE, p.VALUE AS PORTFOLIO_VALUE, round(100 * (RK - 1) / nullif(N - 1, 0), 5) AS PEER_RANK_PCT, concat(CAST(CAST(RK AS BIGINT) AS VARCHAR), '/', CAST(N AS VARCHAR)) AS PEER_RANK, round(m.MED, 6) + 0.0 AS PEER_MEDIAN FROM fx_prank p JOIN fx_windows w ON w.START_DATE = p.START_DATE AND w.END_DATE = p.END_DATE LEFT JOIN (SELECT PORTFOLIO_NAME, START_DATE, END_DATE, INDICATOR, quantile_cont(VALUE, 0.5) AS MED FROM fx_peers GROUP BY ALL) m ON m.PORTFOLIO_NAME = p.PORTFOLIO_NAME AND m.START_DATE = p.START_DATE AND m.END_DATE = p.END_DATE AND m.INDICATOR = p.INDICATOR WHERE p.TICKER_SYMBOL = p.PORTFOLIO_NAME AND p.VALUE IS NOT NULL",
    PEER,
)
def m13_peer_table(spark, sf):
    windows = fund_windows(spark, sf)
    own = rounded(perf.window_stats(portfolio_nav(spark, sf), windows), 4)
    funds = rounded(perf.window_stats(fx.view(spark, sf, "fx_fund_nav"), windows), 4)
    peers = funds.withColumn("K", F.substring(T, 2, 10).cast("bigint") % 5).join(segments(spark, sf), "K").drop("K")
    out = pf.peer_table(own, peers, windows, {})
    return out.select(T, "START_DATE", D, "INDICATOR", "CYCLE", "PORTFOLIO_VALUE", F.round("PEER_RANK_PCT", 5).alias("PEER_RANK_PCT"), "PEER_RANK", (F.round("PEER_MEDIAN", 6) + 0.0).alias("PEER_MEDIAN"))


@register("m14_rebased_series", "SELECT f.TICKER_SYMBOL, f.END_DATE, round(NAV / first_value(NAV) OVER w, 6) AS NAV, round(B / first_value(B) OVER w, 6) AS BENCH_NAV, round(NAV / first_value(NAV) OVER w - B / first_value(B) OVER w, 6) + 0.0 AS ALPHA FROM (SELECT n.*, avg(NAV) OVER (PARTITION BY END_DATE) AS B FROM fx_fund_nav n) f WINDOW w AS (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)")
def m14_rebased_series(spark, sf):
    nav = fx.view(spark, sf, "fx_fund_nav")
    both = nav.join(nav.groupBy(D).agg(F.avg("NAV").alias("BENCH_NAV")), D)
    out = al.rebased(both, ["NAV", "BENCH_NAV"])
    return rounded(out.select(T, D, "NAV", "BENCH_NAV", (F.col("NAV") - F.col("BENCH_NAV")).alias("ALPHA")))


@register(
    "m15_portfolio_vs_index",
    "SELECT PORTFOLIO_NAME AS TICKER_SYMBOL, TRADE_DT AS END_DATE, round(sum(L) OVER w, 5) + 0.0 AS CUM_RET, round(sum(I) OVER w, 5) + 0.0 AS CUM_INDEX, round(sum(L - I) OVER w, 5) + 0.0 AS CUM_ALPHA FROM (SELECT p.PORTFOLIO_NAME, p.TRADE_DT, CASE WHEN p.TRADE_DT > i.LISTED_DATE THEN ln(1 + p.RR / 100) * 100 ELSE 0 END AS L, CASE WHEN p.TRADE_DT > i.LISTED_DATE THEN ln(1 + r.RETURN_RATE / 100) * 100 ELSE 0 END AS I FROM fx_pret p JOIN fx_pinfo i USING (PORTFOLIO_NAME) JOIN fx_ret r ON r.TRADE_DT = p.TRADE_DT AND r.TICKER_SYMBOL = 'S1' WHERE r.RETURN_RATE IS NOT NULL) t WINDOW w AS (PARTITION BY PORTFOLIO_NAME ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)",
    DRIFT,
)
def m15_portfolio_vs_index(spark, sf):
    info = pinfo(spark, sf).select(P, "LISTED_DATE")
    after = F.when(F.col(DAY) > F.col("LISTED_DATE"), F.col("RETURN_RATE")).otherwise(0.0)
    ret = pf.daily_returns(drifted(spark, sf)).join(info, P).select(F.col(P).alias(T), F.col(DAY).alias(D), after.alias("RETURN_RATE"))
    index = index_rates(spark, sf).where("TICKER_SYMBOL = 'S1'").select(F.col(DAY).alias(D), "RETURN_RATE")
    return rounded(al.fund_vs_index(ret, index), 5)


_CYCLES = ["近1周", "近1月", "近3月", "近6月", "YTD", "近1年", "成立日"]
SHEET = {
    **PEER,
    "fx_spans": "SELECT DISTINCT START_DATE AS WIN_START, END_DATE AS WIN_END FROM (SELECT START_DATE, END_DATE FROM fx_windows UNION ALL SELECT LISTED_DATE, END_DATE FROM fx_pinfo, fx_ends) u",
    "fx_lab": "SELECT 'ALL' AS O, DATE_NAME, START_DATE, END_DATE FROM fx_windows UNION ALL SELECT PORTFOLIO_NAME, '成立日', LISTED_DATE, END_DATE FROM fx_pinfo, fx_ends",
    "fx_shown": "SELECT i.*, CASE WHEN INCLUDE_QDII = 1 THEN (SELECT END_DATE FROM fx_ends ORDER BY END_DATE DESC LIMIT 1 OFFSET 1) ELSE (SELECT max(END_DATE) FROM fx_ends) END AS E FROM fx_pinfo i",
    "fx_sheet": "SELECT s.PORTFOLIO_NAME, s.E AS END_DATE, s.LISTED_DATE, " + ", ".join(f'max(q.CUM_RETURN) FILTER (WHERE l.DATE_NAME = \'{c}\') AS "{c}"' for c in _CYCLES) + ", max(q.MAXDD) FILTER (WHERE l.DATE_NAME = '成立日') AS \"最大回撤\" FROM fx_shown s JOIN fx_q_stats q ON q.TICKER_SYMBOL = s.PORTFOLIO_NAME AND q.END_DATE = s.E AND q.START_DATE = q.WIN_START AND q.WIN_END = q.END_DATE JOIN fx_lab l ON l.START_DATE = q.START_DATE AND l.END_DATE = q.END_DATE AND l.O IN ('ALL', s.PORTFOLIO_NAME) GROUP BY 1, 2, 3",
}


@register(
    "m16_daily_sheet",
    "SELECT s.PORTFOLIO_NAME, s.END_DATE, s.LISTED_DATE, " + ", ".join(f'round("{c}", 4) + 0.0 AS "{c}"' for c in [*_CYCLES, "最大回撤"]) + ", CASE WHEN h.NOW_ >= h.HIGH THEN '是' ELSE '否' END AS \"是否新高\" FROM fx_sheet s JOIN (SELECT a.PORTFOLIO_NAME, max(ACC) AS HIGH, arg_max(ACC, a.TRADE_DT) AS NOW_ FROM fx_acc a JOIN fx_shown s ON s.PORTFOLIO_NAME = a.PORTFOLIO_NAME AND a.TRADE_DT <= s.E GROUP BY 1) h USING (PORTFOLIO_NAME)",
    SHEET,
)
def m16_daily_sheet(spark, sf):
    info = pinfo(spark, sf)
    cal = fx.calendar(spark, sf)
    last = cal.where("IF_TRADING_DAY = 1").orderBy(F.desc(DAY)).limit(2).select(DAY).collect()
    day, prev = F.lit(last[0][0]), F.lit(last[1][0])
    listed = info.select(P, F.lit("成立日").alias("DATE_NAME"), F.col("LISTED_DATE").alias("START_DATE"))
    from navloom.catalog.performance import SPEC
    from navloom.operators.calendars import window_table

    ends = cal.where(F.col(DAY).isin(last[0][0], last[1][0])).select(F.col(DAY).alias(D))
    windows = window_table(cal, ends, listed, spec=SPEC)
    stats = perf.window_stats(portfolio_nav(spark, sf), windows)
    labels = windows.select(F.col(P).alias("_O"), F.col("DATE_NAME").alias("CYCLE"), "START_DATE", D)
    named = stats.join(labels, ["START_DATE", D]).where((F.col("_O") == "ALL") | (F.col("_O") == F.col(T))).select(F.col(T).alias(P), D, "CYCLE", "CUM_RETURN", "MAXDD")
    info = info.withColumn("DELISTED_DATE", F.lit(None).cast("date"))
    return rounded(pf.daily_sheet(accumulated(spark, sf), named, info, _CYCLES, day, prev), 4)


@register("m17_holding_returns", "SELECT r.TICKER_SYMBOL, r.TRADE_DT, round(RETURN_RATE, 6) + 0.0 AS RETURN_RATE, h.PORTFOLIOS FROM fx_ret r JOIN (SELECT TICKER_SYMBOL, string_agg(DISTINCT PORTFOLIO_NAME, ',' ORDER BY PORTFOLIO_NAME) AS PORTFOLIOS FROM fx_weights WHERE TRADE_DT = DATE '1999-01-01' GROUP BY 1) h USING (TICKER_SYMBOL) WHERE RETURN_RATE IS NOT NULL")
def m17_holding_returns(spark, sf):
    held = fx.view(spark, sf, "fx_weights").where("TRADE_DT = DATE '1999-01-01'")
    return rounded(pf.holding_returns(held, index_rates(spark, sf)))


PRODUCTS = {
    "fx_prod": "SELECT concat('S', k) AS TICKER_SYMBOL, 10000.0::DOUBLE * (1 + k) AS MAX_IND, 50000.0::DOUBLE * (10 - k) AS MAX_INST, 10.0::DOUBLE * (1 + k % 3) AS FIRST_BUY, CAST(k % 3 AS INTEGER) AS DELAY_DATE, (1 + k % 4) / 8.0::DOUBLE AS FEE_7D, 20.0::DOUBLE + k AS SHARE_IND, 15.0::DOUBLE + k * 2 AS SHARE_INST, 0.5::DOUBLE + k / 16.0 AS MANAGEMENT_FEE, k / 32.0::DOUBLE AS SALE_FEE, CASE WHEN k > 1 THEN 1 ELSE 0 END AS IF_IN_TRANCHE FROM (SELECT DISTINCT s_suppkey % 10 AS k FROM supplier) s",
    "fx_hh": "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT, CASE WHEN TICKER_SYMBOL < 'S4' THEN 'S9' END AS ALTERNATIVE FROM fx_weights WHERE TRADE_DT = DATE '1999-01-01'",
}


def _products(spark, sf):
    k = F.col("k")
    base = fx.table(spark, sf, "supplier").select((F.col("s_suppkey") % 10).alias("k")).distinct()
    return base.select(
        F.concat(F.lit("S"), k.cast("string")).alias(T), (10000.0 * (1 + k)).alias("MAX_IND"), (50000.0 * (10 - k)).alias("MAX_INST"), (10.0 * (1 + k % 3)).alias("FIRST_BUY"), (k % 3).cast("int").alias("DELAY_DATE"), ((1 + k % 4) / 8).alias("FEE_7D"),
        (20.0 + k).alias("SHARE_IND"), (15.0 + k * 2).alias("SHARE_INST"), (0.5 + k / 16).alias("MANAGEMENT_FEE"), (k / 32).alias("SALE_FEE"), F.when(k > 1, 1).otherwise(0).alias("IF_IN_TRANCHE"),
    )


def _held(spark, sf):
    return fx.view(spark, sf, "fx_weights").where("TRADE_DT = DATE '1999-01-01'").drop(DAY).withColumn("ALTERNATIVE", F.when(F.col(T) < "S4", "S9"))


@register(
    "m18_purchase_limits",
    "SELECT h.PORTFOLIO_NAME, round(min(p.MAX_IND / WEIGHT * 100) / 10000, 2) AS DAILY_INDIVIDUAL, round(min(p.MAX_INST / WEIGHT * 100) / 10000, 2) AS DAILY_INSTITUTION, round(min(CASE WHEN p.MAX_IND >= coalesce(a.MAX_IND, 0) THEN p.MAX_IND ELSE p.MAX_IND + a.MAX_IND END / WEIGHT * 100) / 10000, 2) AS DAILY_INDIVIDUAL_ALT, round(min(CASE WHEN p.MAX_INST >= coalesce(a.MAX_INST, 0) THEN p.MAX_INST ELSE p.MAX_INST + a.MAX_INST END / WEIGHT * 100) / 10000, 2) AS DAILY_INSTITUTION_ALT, round(max(p.FIRST_BUY / WEIGHT * 100), 2) AS FIRST_BUY, max(p.DELAY_DATE) AS DELAY_DATE, round(sum(WEIGHT * p.FEE_7D) / 100, 2) AS FEE_7D FROM fx_hh h JOIN fx_prod p USING (TICKER_SYMBOL) LEFT JOIN fx_prod a ON a.TICKER_SYMBOL = h.ALTERNATIVE GROUP BY 1",
    PRODUCTS,
)
def m18_purchase_limits(spark, sf):
    return pf.purchase_limits(_held(spark, sf), _products(spark, sf))


@register(
    "m19_fee_income",
    "SELECT PORTFOLIO_NAME, OI AS OFFSET_IND, II AS INCOME_IND, SI AS SALE_INCOME, round(0.6 + II + SI, 4) AS TOTAL_IND, round(0.6 + IN_ + SI, 4) AS TOTAL_INST, round(0.6 - OI, 4) AS COST_IND FROM (SELECT PORTFOLIO_NAME, round(sum(WEIGHT * (SHARE_IND - MI) * MANAGEMENT_FEE / 10000), 4) AS OI, round(sum(WEIGHT * MI * MANAGEMENT_FEE / 10000), 4) AS II, round(sum(WEIGHT * MN * MANAGEMENT_FEE / 10000), 4) AS IN_, round(sum(WEIGHT * SALE_FEE / 100), 4) AS SI FROM fx_hh JOIN fx_prod USING (TICKER_SYMBOL), (SELECT min(SHARE_IND) AS MI, min(SHARE_INST) AS MN FROM fx_prod WHERE IF_IN_TRANCHE = 1) m GROUP BY 1) t",
    PRODUCTS,
)
def m19_fee_income(spark, sf):
    info = fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias(P)).distinct().withColumn("PORTFOLIO_MANAGEMENT_FEE", F.lit(0.6))
    out = pf.fee_income(_held(spark, sf), _products(spark, sf), info)
    return rounded(out.select(P, "OFFSET_IND", "INCOME_IND", "SALE_INCOME", "TOTAL_IND", "TOTAL_INST", "COST_IND"), 4)


ALLOC = {
    "fx_sig": "SELECT c.TRADE_DT, (extract(day FROM c.TRADE_DT) * 7 + extract(month FROM c.TRADE_DT) * 13) % 101 AS S, (extract(day FROM c.TRADE_DT) * 11) % 103 AS B FROM fx_calendar c WHERE IF_WEEK_END = 1 OR IF_MONTH_END = 1",
    "fx_lv": "SELECT TRADE_DT, " + ", ".join(f"max(NAV) FILTER (WHERE TICKER_SYMBOL = 'S{i}') AS V{i}" for i in (1, 2, 3)) + " FROM (SELECT n.TICKER_SYMBOL, d.TRADE_DT, last_value(n.X IGNORE NULLS) OVER (PARTITION BY n.TICKER_SYMBOL ORDER BY d.TRADE_DT) AS NAV FROM (SELECT TICKER_SYMBOL, END_DATE, 100 + 20 * ADJ_NAV / (ADJ_NAV + 200) AS X FROM fx_nav_long) n JOIN fx_sig d ON d.TRADE_DT = n.END_DATE) z GROUP BY 1 HAVING V1 IS NOT NULL AND V2 IS NOT NULL AND V3 IS NOT NULL",
    "fx_ar": "SELECT TRADE_DT, " + ", ".join(f"coalesce(V{i} / lag(V{i}) OVER (ORDER BY TRADE_DT) - 1, 0) AS R{i}" for i in (1, 2, 3)) + " FROM fx_lv",
    "fx_al1": "SELECT s.TRADE_DT, R1 AS STOCK, R2 AS CASH, 0.1 * R1 + 0.9 * R3 AS BP, S, B, CASE WHEN S > 30 AND S < 70 THEN 0.5 WHEN S < 30 THEN 0.5 + ceil((30 - S) / 5.0) * 0.05 ELSE 0.5 - ceil((S - 70) / 5.0) * 0.05 END AS SS FROM fx_sig s JOIN fx_ar r USING (TRADE_DT)",
    "fx_al2": "SELECT *, CASE WHEN S > 70 AND B > 90 THEN 1 - SS WHEN B > 90 THEN (1 - SS) * 0.5 ELSE 0 END AS CS FROM fx_al1",
    "fx_al3": "SELECT *, coalesce(lag(CS) OVER w, 0) * CASH + coalesce(lag(SS) OVER w, 0) * STOCK + coalesce(lag(1 - CS - SS) OVER w, 0) * BP AS PR FROM fx_al2 WINDOW w AS (ORDER BY TRADE_DT)",
}


@register("m20_temperature_allocation", "SELECT TRADE_DT, round(SS, 4)::DOUBLE AS STOCK_SHARE, round(CS, 4)::DOUBLE + 0.0 AS CASH_SHARE, round(PR, 6) + 0.0 AS PORTFOLIO, round(exp(sum(ln(1 + PR)) OVER w), 6) AS NAV, round(exp(sum(ln(1 + STOCK)) OVER w), 6) AS STOCK_NAV FROM fx_al3 WINDOW w AS (ORDER BY TRADE_DT ROWS UNBOUNDED PRECEDING)", ALLOC)
def m20_temperature_allocation(spark, sf):
    cal = fx.calendar(spark, sf)
    ends = period_ends(cal, "w").union(period_ends(cal, "m")).distinct()
    d, m = F.dayofmonth(DAY), F.month(DAY)
    signals = ends.select(DAY, ((d * 7 + m * 13) % 101).cast("double").alias("STOCK_TEMPERATURE"), ((d * 11) % 103).cast("double").alias("BOND_TEMPERATURE"))
    nav = fx.view(spark, sf, "fx_nav_long").withColumnRenamed(D, DAY).join(ends, DAY, "left_semi")
    x = 100 + 20 * F.col("ADJ_NAV") / (F.col("ADJ_NAV") + 200)
    wide = nav.groupBy(DAY).agg(*[F.max(F.when(F.col(T) == f"S{i}", x)).alias(f"V{i}") for i in (1, 2, 3)]).dropna()
    w = by([F.lit(0)], DAY)
    r = wide.select(DAY, *[F.coalesce(daily_return(F.col(f"V{i}"), w), F.lit(0.0)).alias(f"R{i}") for i in (1, 2, 3)])
    returns = r.select(DAY, F.col("R1").alias("STOCK"), F.col("R2").alias("CASH"), (0.1 * F.col("R1") + 0.9 * F.col("R3")).alias("BOND_PLUS"))
    out = pf.temperature_allocation(signals, returns).select(DAY, F.round("STOCK_SHARE", 4).alias("STOCK_SHARE"), (F.round("CASH_SHARE", 4) + 0.0).alias("CASH_SHARE"), "PORTFOLIO", "NAV", "STOCK_NAV")
    return rounded(out)


# --- ledger ---

LEDGER = {
    "fx_l0": "SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date, seq) AS RN, " + half_up("quantity * price", 2) + " AS V FROM fx_ledger",
    "fx_lrec": """WITH RECURSIVE r AS (
  SELECT ticker, RN, seq, date, type, quantity, price, V, CASE WHEN type = 'Buy' THEN quantity ELSE 0 END AS U1, CASE WHEN type = 'Buy' THEN V ELSE 0 END AS C1, 0.0::DOUBLE AS U0, 0.0::DOUBLE AS C0, 0.0::DOUBLE AS SOLD FROM fx_l0 WHERE RN = 1
  UNION ALL SELECT l.ticker, l.RN, l.seq, l.date, l.type, l.quantity, l.price, l.V, round(CASE WHEN l.type = 'Buy' THEN r.U1 + l.quantity ELSE r.U1 - l.quantity END, 4),
    CASE WHEN l.type = 'Buy' THEN r.C1 + l.V ELSE r.C1 - coalesce(l.quantity / nullif(r.U1, 0), 0) * r.C1 END, r.U1, r.C1, CASE WHEN l.type = 'Sell' THEN coalesce(l.quantity / nullif(r.U1, 0), 0) * r.C1 ELSE 0 END
  FROM r JOIN fx_l0 l ON l.ticker = r.ticker AND l.RN = r.RN + 1)
SELECT * FROM r""",
    "fx_lp": "SELECT seq, date, type, ticker, quantity, price, CASE WHEN type = 'Buy' THEN -V ELSE V END AS cashflow, round(U0, 4) + 0.0 AS prev_units, round(U1, 4) + 0.0 AS cml_units, C0, C1, SOLD, CASE WHEN type = 'Sell' THEN V - SOLD ELSE 0 END AS G FROM fx_lrec",
}


@register(
    "m21_average_cost_ledger",
    "SELECT seq, date, type, ticker, cashflow, prev_units, cml_units, round(C0, 4) + 0.0 AS prev_cost, round(C1, 4) + 0.0 AS cml_cost, round(SOLD, 4) + 0.0 AS cost_transact, round(G, 4) + 0.0 AS gain_loss FROM fx_lp",
    LEDGER,
)
def m21_average_cost_ledger(spark, sf):
    t = lg.positions(fx.view(spark, sf, "fx_ledger"))
    cols = ["prev_cost", "cml_cost", "cost_transact", "gain_loss"]
    return t.select("seq", "date", "type", "ticker", "cashflow", (F.col("prev_units") + 0.0).alias("prev_units"), (F.col("cml_units") + 0.0).alias("cml_units"), *[(F.round(c, 4) + 0.0).alias(c) for c in cols])


VALUE = {
    **LEDGER,
    "fx_day": "SELECT ticker, date, sum(cashflow) AS cf, arg_max(cml_units, seq) AS u, arg_max(C1, seq) AS c, sum(G) AS g FROM fx_lp GROUP BY 1, 2",
    "fx_px": "SELECT TICKER_SYMBOL AS ticker, END_DATE AS date, ADJ_NAV AS p FROM fx_nav WHERE TICKER_SYMBOL IN (SELECT ticker FROM fx_day)",
    "fx_val": "SELECT ticker, date, p, coalesce(last_value(u IGNORE NULLS) OVER w, 0) AS u, coalesce(last_value(c IGNORE NULLS) OVER w, 0) AS c, sum(coalesce(cf, 0)) OVER w AS cf FROM (SELECT * FROM fx_px FULL JOIN fx_day USING (ticker, date)) t WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)",
}


def _prices(spark, sf):
    return fx.view(spark, sf, "fx_nav").select(F.col(T).alias("ticker"), F.col(D).alias("date"), F.col("ADJ_NAV").alias("adj_close"))


@register("m22_daily_valuation", "SELECT ticker, date, round(u, 4) + 0.0 AS cml_units, round(c, 4) + 0.0 AS cml_cost, round(cf, 2) + 0.0 AS cashflow, round(u * p, 6) + 0.0 AS mktvalue FROM fx_val", VALUE)
def m22_daily_valuation(spark, sf):
    v = lg.daily_valuation(lg.positions(fx.view(spark, sf, "fx_ledger")), _prices(spark, sf))
    return v.select("ticker", "date", (F.round("cml_units", 4) + 0.0).alias("cml_units"), (F.round("cml_cost", 4) + 0.0).alias("cml_cost"), (F.round("cashflow", 2) + 0.0).alias("cashflow"), (F.round(F.col("cml_units") * F.col("adj_close"), 6) + 0.0).alias("mktvalue"))


@register(
    "m22_portfolio_value",
    "SELECT t.date, round(t.v, 1) AS portf_value, round(i.p, 9) AS index_value FROM (SELECT date, sum(coalesce(round(u * p, 3), 0)) AS v FROM fx_val GROUP BY 1) t JOIN (SELECT END_DATE AS date, avg(ADJ_NAV) AS p FROM fx_nav GROUP BY 1) i USING (date)",
    VALUE,
)
def m22_portfolio_value(spark, sf):
    v = lg.daily_valuation(lg.positions(fx.view(spark, sf, "fx_ledger")), _prices(spark, sf))
    index = _prices(spark, sf).groupBy("date").agg(F.avg("adj_close").alias("adj_close"))
    out = lg.portfolio_value(v, index)
    return out.select("date", F.round("portf_value", 1).alias("portf_value"), F.round("index_value", 9).alias("index_value"))


POS = {
    **LEDGER,
    "fx_pos": "SELECT l.ticker, c.c_mktsegment AS sector, n.n_name AS industry, u, c1, round(u * p, 2) AS mv FROM (SELECT ticker, arg_max(cml_units, (date, seq)) AS u, arg_max(round(C1, 4), (date, seq)) AS c1 FROM fx_lp GROUP BY 1) l JOIN (SELECT TICKER_SYMBOL AS ticker, arg_max(ADJ_NAV, END_DATE) AS p FROM fx_nav GROUP BY 1) x USING (ticker) LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = l.ticker LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE u > 0",
}


def _current(spark, sf):
    last = _prices(spark, sf).groupBy("ticker").agg(F.max_by("adj_close", "date").alias("adj_close"))
    sectors = fx.view(spark, sf, "fx_type").select(F.col(T).alias("ticker"), F.col("LEVEL_1").alias("sector"), F.col("LEVEL_2").alias("industry"))
    return lg.current_positions(lg.positions(fx.view(spark, sf, "fx_ledger")), last, sectors)


@register("m23_current_positions", "SELECT ticker, sector, industry, round(u, 4) AS units, round(mv, 1) AS mktvalue, round(mv - c1, 1) + 0.0 AS unrealised, round(mv / sum(mv) OVER () * 100, 4) AS weight FROM fx_pos", POS)
def m23_current_positions(spark, sf):
    out = _current(spark, sf)
    return out.select("ticker", "sector", "industry", F.round("units", 4).alias("units"), F.round("mktvalue", 1).alias("mktvalue"), (F.round(F.col("mktvalue") - F.col("cost"), 1) + 0.0).alias("unrealised"), "weight")


@register("m23_sector_rollup", "SELECT sector, industry, count(*) AS n, round(sum(mv), 1) AS mktvalue FROM fx_pos GROUP BY ROLLUP (sector, industry)", POS)
def m23_sector_rollup(spark, sf):
    out = lg.sector_rollup(_current(spark, sf), ["sector", "industry"])
    return out.select("sector", "industry", "n", F.round("mktvalue", 1).alias("mktvalue"))


# --- remaining reports ---

FLOW = {
    "fx_flow": "SELECT o_orderkey AS K, o_custkey AS CLIENT, c_mktsegment AS PORTFOLIO_NAME, n_name AS BRANCH, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '首次签约' WHEN '2' THEN '追加投资' WHEN '3' THEN '定投' WHEN '4' THEN '减少投资' ELSE '解约' END AS TRADE_TYPE, o_totalprice AS AMOUNT, CAST(o_orderdate AS DATE) AS DAY FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
}


def _flow(spark, sf):
    o = fx.table(spark, sf, "orders").join(fx.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(fx.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    first = F.substring("o_orderpriority", 1, 1)
    kind = F.when(first == "1", "首次签约").when(first == "2", "追加投资").when(first == "3", "定投").when(first == "4", "减少投资").otherwise("解约")
    return o.select(F.col("o_custkey").alias("CLIENT"), F.col("c_mktsegment").alias(P), F.col("n_name").alias("BRANCH"), kind.alias("TRADE_TYPE"), F.col("o_totalprice").alias("AMOUNT"), F.to_date("o_orderdate").alias("DAY"))


@register("m24_order_flow", "SELECT BRANCH, CLIENT, PORTFOLIO_NAME, DAY, round(sum(AMOUNT) / 10000, 6) AS AMOUNT FROM fx_flow WHERE TRADE_TYPE IN ('首次签约', '追加投资', '定投') AND PORTFOLIO_NAME <> 'MACHINERY' GROUP BY 1, 2, 3, 4 HAVING sum(AMOUNT) / 10000 >= 20", FLOW)
def m24_order_flow(spark, sf):
    return rounded(pf.order_flow(_flow(spark, sf), ["BRANCH", "CLIENT", P, "DAY"], ["MACHINERY"], 20.0))


@register("m24_redemptions", "SELECT PORTFOLIO_NAME, round(sum(CAST(round(AMOUNT * 100) AS BIGINT))::DOUBLE / 1000000, 4) AS AMOUNT FROM fx_flow WHERE TRADE_TYPE IN ('减少投资', '解约') GROUP BY 1", FLOW)
def m24_redemptions(spark, sf):
    return rounded(pf.redemptions(_flow(spark, sf)), 4)


SHEET_CYCLES = ["近1月", "近3月", "近1年"]
PSHEET = {
    **WINDOW_VIEWS,
    **points_views("fx_fund_nav", "fx_f", "fx_spans"),
    "fx_r0": "SELECT s.TICKER_SYMBOL, w.DATE_NAME, round(s.CUM_RETURN, 4) AS V, t.LEVEL_1, t.LEVEL_2 FROM fx_f_stats s JOIN fx_windows w ON w.START_DATE = s.START_DATE AND w.END_DATE = s.END_DATE JOIN fx_fund_type t USING (TICKER_SYMBOL) WHERE s.START_DATE = s.WIN_START AND s.END_DATE = s.WIN_END AND s.END_DATE = (SELECT max(END_DATE) FROM fx_ends)",
    "fx_rr": "SELECT *, CASE WHEN LEVEL_1 < 'B' THEN concat(CAST(CAST(floor(rank() OVER (PARTITION BY DATE_NAME, LEVEL_1 ORDER BY V DESC) + (count(*) OVER (PARTITION BY DATE_NAME, LEVEL_1, V) - 1) / 2.0) AS BIGINT) AS VARCHAR), '/', count(*) OVER (PARTITION BY DATE_NAME, LEVEL_1)) ELSE concat(CAST(CAST(floor(rank() OVER (PARTITION BY DATE_NAME, LEVEL_1, LEVEL_2 ORDER BY V DESC) + (count(*) OVER (PARTITION BY DATE_NAME, LEVEL_1, LEVEL_2, V) - 1) / 2.0) AS BIGINT) AS VARCHAR), '/', count(*) OVER (PARTITION BY DATE_NAME, LEVEL_1, LEVEL_2)) END AS RK FROM fx_r0",
}


@register(
    "m25_product_sheet",
    "SELECT n.TICKER_SYMBOL, n.END_DATE, round(n.NAV, 6) AS NAV, a.NET_ASSET, " + ", ".join(f'max(r.V) FILTER (WHERE r.DATE_NAME = \'{c}\') AS "{c}", max(r.RK) FILTER (WHERE r.DATE_NAME = \'{c}\') AS "{c}_排名"' for c in SHEET_CYCLES)
    + " FROM (SELECT TICKER_SYMBOL, max(END_DATE) AS END_DATE, arg_max(NAV, END_DATE) AS NAV FROM fx_fund_nav GROUP BY 1) n LEFT JOIN (SELECT FUND_ID, arg_max(NET_ASSET, REPORT_DATE) AS NET_ASSET FROM fx_snapshot GROUP BY 1) a ON a.FUND_ID = n.TICKER_SYMBOL LEFT JOIN fx_rr r ON r.TICKER_SYMBOL = n.TICKER_SYMBOL GROUP BY 1, 2, 3, 4",
    PSHEET,
)
def m25_product_sheet(spark, sf):
    from navloom.plans.scoring import performance_ranks

    last = fx.calendar(spark, sf).where("IF_TRADING_DAY = 1").agg(F.max(DAY).alias(D))
    windows = fund_windows(spark, sf).join(F.broadcast(last), D, "left_semi")  # those that end on the sheet's date
    nav = fx.view(spark, sf, "fx_fund_nav")
    stats = cut_lineage(rounded(perf.named_stats(perf.window_stats(nav, windows), windows), 4).select(T, D, "DATE_NAME", "CUM_RETURN"))
    types = fx.view(spark, sf, "fx_fund_type")
    long = stats.select(T, D, F.lit("CUM").alias("INDICATOR"), F.col("DATE_NAME").alias("PERIOD"), F.col("CUM_RETURN").alias("VALUE"))
    ranked = performance_ranks(long, types, ["LEVEL_1", "LEVEL_2"], [], as_text=True).withColumnRenamed("PERIOD", "DATE_NAME")
    level_of = types.select(T, F.when(F.col("LEVEL_1") < "B", "LEVEL_1").otherwise("LEVEL_2").alias("LEVEL"))
    assets = fx.view(spark, sf, "fx_snapshot").withColumnRenamed("FUND_ID", T)
    out = pf.product_sheet(nav, assets, stats, ranked, level_of, SHEET_CYCLES)
    return out.withColumn("NAV", F.round("NAV", 6)).select(T, D, "NAV", "NET_ASSET", *SHEET_CYCLES, *[f"{c}_排名" for c in SHEET_CYCLES])


@register("m26_event_monitor", "SELECT concat('S', user_id % 10) AS TICKER_SYMBOL, CAST(ts AS DATE) AS EVENT_DATE, event_id, event_type, h.PORTFOLIOS FROM events JOIN (SELECT TICKER_SYMBOL, string_agg(DISTINCT PORTFOLIO_NAME, ',' ORDER BY PORTFOLIO_NAME) AS PORTFOLIOS FROM fx_weights WHERE TRADE_DT = DATE '1999-01-01' GROUP BY 1) h ON h.TICKER_SYMBOL = concat('S', user_id % 10) WHERE CAST(ts AS DATE) >= DATE '2024-01-25'")
def m26_event_monitor(spark, sf):
    ev = fx.table(spark, sf, "events").select(F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias(T), F.to_date("ts").alias("EVENT_DATE"), "event_id", "event_type")
    held = fx.view(spark, sf, "fx_weights").where("TRADE_DT = DATE '1999-01-01'")
    return pf.event_monitor(ev, held, F.to_date(F.lit("2024-01-25")))


@register(
    "m27_money_flow",
    "SELECT END_DATE, NET, round(avg(NET) OVER (ORDER BY END_DATE ROWS 4 PRECEDING), 4) AS MA5, round(avg(NET) OVER (ORDER BY END_DATE ROWS 19 PRECEDING), 4) AS MA20, round(avg(NET) OVER (ORDER BY END_DATE ROWS 59 PRECEDING), 4) AS MA60 FROM (SELECT CAST(l_shipdate AS DATE) AS END_DATE, CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT)) AS DOUBLE) AS NET FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1) t ORDER BY END_DATE DESC LIMIT 5",
)
def m27_money_flow(spark, sf):
    line = fx.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias(D), "l_returnflag", "l_quantity")
    north = line.where("l_returnflag = 'A'").select(D, F.col("l_quantity").alias("NET"))
    south = line.where("l_returnflag = 'R'").select(D, (-F.col("l_quantity")).alias("NET"))
    return rounded(pf.money_flow([north, south]), 4)


@register("m28_valid_windows", "SELECT i.PORTFOLIO_NAME, w.DATE_NAME, w.START_DATE, w.END_DATE FROM fx_windows w JOIN fx_pinfo i ON w.START_DATE >= i.LISTED_DATE WHERE w.DATE_NAME <> '近1日'", {**DRIFT, **WINDOW_VIEWS})
def m28_valid_windows(spark, sf):
    return pf.valid_windows(fund_windows(spark, sf), pinfo(spark, sf))


@register(
    "m29_report_with_older_rank",
    "SELECT a.TICKER_SYMBOL, a.END_DATE, round(a.ADJ_NAV, 6) AS ADJ_NAV, o.RK AS OLDER_RANK, o.END_DATE AS RANK_DATE FROM fx_nav a LEFT JOIN (SELECT TICKER_SYMBOL, END_DATE, rank() OVER (ORDER BY ADJ_NAV DESC) AS RK FROM fx_nav WHERE END_DATE = DATE '2024-01-27') o USING (TICKER_SYMBOL) WHERE a.END_DATE = DATE '2024-01-29'",
)
def m29_report_with_older_rank(spark, sf):
    from navloom.operators.ranks import sql_rank

    nav = fx.view(spark, sf, "fx_nav")
    older = sql_rank(nav.where("END_DATE = DATE '2024-01-27'"), [D], [-F.col("ADJ_NAV")], "RANK")
    return rounded(pf.report_with_older_rank(nav.where("END_DATE = DATE '2024-01-29'"), older, [T]))


@register("m30_rebalance_dates", "SELECT DISTINCT PORTFOLIO_NAME, TRADE_DT FROM fx_targets WHERE TRADE_DT > DATE '1996-01-01' AND TRADE_DT <= DATE '1999-12-31'", DRIFT)
def m30_rebalance_dates(spark, sf):
    return pf.rebalance_dates(targets(spark, sf), F.to_date(F.lit("1996-01-01")), F.to_date(F.lit("1999-12-31")))

