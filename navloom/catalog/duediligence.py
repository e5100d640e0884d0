"""Due-diligence scores of all funds, and the ways user functions plug in."""

from __future__ import annotations

from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.catalog.performance import BENCH_VIEWS, CLASSIC, bench_panel, classic_sql
from navloom.operators import ranks
from navloom.plans import duediligence as dd
from navloom.plans import performance as perf
from navloom.sources import fixtures as fx

T = "TICKER_SYMBOL"
TODAY = "DATE '2001-10-31'"

INPUT = {
    "fx_dd": """SELECT concat('F', CAST(s_suppkey AS VARCHAR(10))) AS TICKER_SYMBOL, s_name AS SEC_SHORT_NAME, n_name AS MANAGEMENT_COMPANY_NAME,
 CASE s_suppkey % 5 WHEN 0 THEN '主动权益' WHEN 1 THEN '主动债券' WHEN 2 THEN '指数' WHEN 3 THEN '货币' ELSE '商品' END AS LEVEL_SUM,
 CASE s_suppkey % 7 WHEN 0 THEN '指数增强' WHEN 1 THEN '短债' ELSE '普通' END AS LEVEL_2, CASE s_suppkey % 3 WHEN 0 THEN 'QDII' ELSE 'CN' END AS LEVEL_1,
 CAST(s_suppkey % 13 * 5 AS INT) AS COMPANY_PLACE, CAST(s_suppkey % 17 AS DOUBLE) / 2 AS MANAGER_YEARS, CAST(s_suppkey % 6 AS DOUBLE) AS LOSS_SCORE, CAST(s_suppkey % 4 AS DOUBLE) AS POOL_YEARS,
 CAST(s_suppkey * 31 % 251 AS DOUBLE) / 2 AS FUND_ASSET, CAST(s_suppkey * 7 % 41 - 20 AS DOUBLE) / 100 AS EXCESS, CAST(s_suppkey * 11 % 37 AS DOUBLE) / 20 AS DRAWDOWN_RATIO, CAST(s_suppkey * 13 % 29 AS DOUBLE) / 8 AS IR,
 CAST(s_suppkey * 17 % 101 AS DOUBLE) AS RETURN_RANK, CAST(s_suppkey * 19 % 101 AS DOUBLE) AS DRAWDOWN_RANK, CAST(s_suppkey * 23 % 101 AS DOUBLE) AS SHARPE_RANK, CAST(s_suppkey * 29 % 71 AS DOUBLE) / 8 AS TRACKING_ERROR,
 CAST(s_suppkey % 9 AS DOUBLE) / 10 AS TOTAL_FEE, CASE s_suppkey % 2 WHEN 0 THEN '优选池' ELSE '核心池' END AS TRANCHE, CAST(s_suppkey % 5 AS DOUBLE) / 2 AS FUND_YEARS, CAST(s_suppkey * 37 % 67 AS DOUBLE) AS MANAGER_ASSET,
 s_acctbal AS NET_ASSET, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS IS_MAIN, s_suppkey AS K
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "fx_tpl": "SELECT *, CASE WHEN LEVEL_SUM IN ('指数', '商品') OR LEVEL_2 = '指数增强' THEN '指数和商品' ELSE LEVEL_SUM END AS TEMPLATE FROM fx_dd",
    "fx_parts": """SELECT *, CASE WHEN TEMPLATE IN ('主动权益', '主动债券') THEN CASE WHEN COMPANY_PLACE <= 10 THEN 10 WHEN COMPANY_PLACE <= 20 THEN 8 WHEN COMPANY_PLACE <= 50 THEN 5 ELSE 0 END WHEN TEMPLATE = '指数和商品' THEN CASE WHEN COMPANY_PLACE <= 20 THEN 20 WHEN COMPANY_PLACE <= 30 THEN 15 WHEN COMPANY_PLACE <= 40 THEN 10 WHEN COMPANY_PLACE <= 50 THEN 5 ELSE 0 END ELSE CASE WHEN COMPANY_PLACE <= 20 THEN 5 WHEN COMPANY_PLACE <= 50 THEN 3 ELSE 0 END END AS C1,
 CASE WHEN TEMPLATE IN ('主动权益', '主动债券') THEN CASE WHEN MANAGER_YEARS <= 1 THEN 0 WHEN MANAGER_YEARS > 5 THEN 5 ELSE MANAGER_YEARS END ELSE 0 END AS C2,
 CASE TEMPLATE WHEN '主动权益' THEN CASE WHEN FUND_ASSET <= 20 THEN 10 WHEN FUND_ASSET > 120 THEN 0 ELSE 12 - 0.1 * FUND_ASSET END
  WHEN '主动债券' THEN least(10, CASE WHEN LEVEL_2 = '短债' THEN CASE WHEN FUND_ASSET <= 5 THEN 0 ELSE (FUND_ASSET - 5) / 5 END ELSE CASE WHEN FUND_ASSET <= 10 THEN 10 ELSE (FUND_ASSET - 10) / 10 END END)
  WHEN '指数和商品' THEN CASE WHEN LEVEL_2 = '指数增强' THEN CASE WHEN FUND_ASSET <= 10 THEN 20 ELSE greatest(0, 20 - (FUND_ASSET - 10) / 10) END WHEN LEVEL_1 = 'QDII' THEN CASE WHEN FUND_ASSET > 5 THEN 30 WHEN FUND_ASSET > 2 THEN 15 ELSE 0 END ELSE CASE WHEN FUND_ASSET > 40 THEN 30 WHEN FUND_ASSET > 15 THEN 15 ELSE 0 END END
  ELSE CASE WHEN FUND_ASSET >= 200 THEN 15 WHEN FUND_ASSET >= 100 THEN 10 WHEN FUND_ASSET >= 50 THEN 5 ELSE 0 END END AS C3,
 CASE TEMPLATE WHEN '主动权益' THEN greatest(0, least(15, 7 + EXCESS / 0.02)) WHEN '主动债券' THEN CASE WHEN RETURN_RANK <= 20 THEN 15 WHEN RETURN_RANK <= 50 THEN 10 WHEN RETURN_RANK <= 70 THEN 5 ELSE 0 END
  WHEN '指数和商品' THEN CASE WHEN LEVEL_2 = '指数增强' THEN least(30, CASE WHEN EXCESS <= 0 THEN 0 ELSE EXCESS * 400 END) WHEN LEVEL_1 = 'QDII' THEN least(20, CASE WHEN TRACKING_ERROR > 6 THEN 0 ELSE (6 - TRACKING_ERROR) / 0.1 END) ELSE least(20, CASE WHEN TRACKING_ERROR > 3 THEN 0 ELSE (3 - TRACKING_ERROR) / 0.1 END) END
  ELSE CASE WHEN RETURN_RANK <= 30 THEN 10 WHEN RETURN_RANK <= 50 THEN 5 ELSE 0 END END AS C4,
 CASE TEMPLATE WHEN '主动权益' THEN greatest(0, least(15, 10 + (0.9 - DRAWDOWN_RATIO) / 0.05)) WHEN '主动债券' THEN CASE WHEN DRAWDOWN_RANK <= 20 THEN 10 WHEN DRAWDOWN_RANK <= 50 THEN 8 WHEN DRAWDOWN_RANK <= 70 THEN 5 ELSE 0 END ELSE 0 END AS C5,
 CASE TEMPLATE WHEN '主动权益' THEN greatest(0, least(5, (IR - 1) / 0.5)) WHEN '主动债券' THEN CASE WHEN SHARPE_RANK <= 20 THEN 10 WHEN SHARPE_RANK <= 50 THEN 8 WHEN SHARPE_RANK <= 70 THEN 5 ELSE 0 END WHEN '货币' THEN CASE WHEN TOTAL_FEE <= 0.4 THEN 50 WHEN TOTAL_FEE <= 0.5 THEN 30 WHEN TOTAL_FEE <= 0.6 THEN 20 ELSE 0 END ELSE 0 END AS C6,
 CASE WHEN TEMPLATE IN ('主动权益', '主动债券') THEN 35 + LOSS_SCORE WHEN TEMPLATE = '指数和商品' THEN 30 ELSE 20 END AS C7,
 CASE WHEN TEMPLATE IN ('主动权益', '主动债券') THEN CASE WHEN POOL_YEARS < 1 THEN 0 WHEN POOL_YEARS > 2 THEN 10 ELSE 5 END ELSE 0 END AS C8 FROM fx_tpl""",
    "fx_scored": "SELECT *, C1 + C2 + C3 + C4 + C5 + C6 + C7 + C8 AS TOTAL FROM fx_parts",
}


def _funds(spark, sf):
    return spark.sql(INPUT["fx_dd"], supplier=fx.table(spark, sf, "supplier"), nation=fx.table(spark, sf, "nation"))


def _scored(spark, sf):
    return dd.scored(dd.template(_funds(spark, sf)))


@register("n11_template_choice", "SELECT TICKER_SYMBOL, TEMPLATE FROM fx_tpl", INPUT)
def n11_template_choice(spark, sf):
    return dd.template(_funds(spark, sf)).select(T, "TEMPLATE")


_PARTS = ", ".join(f"round(CAST(C{i + 1} AS DOUBLE), 3) + 0.0 AS {p}" for i, p in enumerate(dd.PARTS))


@register("n09_template_scores", f"SELECT TICKER_SYMBOL, TEMPLATE, {_PARTS}, round(CAST(TOTAL AS DOUBLE), 3) AS TOTAL_SCORE FROM fx_scored", INPUT)
def n09_template_scores(spark, sf):
    return rounded(_scored(spark, sf).select(T, "TEMPLATE", *dd.PARTS, "TOTAL_SCORE"), 3)


@register(
    "n10_gate_rules",
    "SELECT TICKER_SYMBOL, CASE WHEN R = '' THEN '满足' ELSE '不满足' END AS RESULT, R AS REMARKS FROM (SELECT TICKER_SYMBOL, concat_ws(';', CASE WHEN FUND_YEARS < 1 AND LEVEL_SUM <> '指数' THEN '非指数产品不满足成立1年' END, CASE WHEN FUND_ASSET < 2 THEN '基金资产不满2亿' END, CASE WHEN TEMPLATE = '主动权益' AND TRANCHE = '优选池' AND MANAGER_ASSET < 5 THEN '优选池同策略产品管理规模不足5亿' WHEN TEMPLATE = '主动权益' AND TRANCHE = '核心池' AND MANAGER_ASSET < 20 THEN '核心池同策略产品管理规模不足20亿' WHEN TEMPLATE = '主动债券' AND TRANCHE = '优选池' AND MANAGER_ASSET < 20 THEN '优选池同策略产品管理规模不足20亿' WHEN TEMPLATE = '主动债券' AND TRANCHE = '核心池' AND MANAGER_ASSET < 50 THEN '核心池同策略产品管理规模不足50亿' END, CASE WHEN round(TOTAL, 4) < CASE WHEN TEMPLATE = '指数和商品' THEN 60 WHEN TRANCHE = '优选池' THEN 65 ELSE 75 END THEN '评分不满' END) AS R FROM fx_scored) t",
    INPUT,
)
def n10_gate_rules(spark, sf):
    return dd.gated(_scored(spark, sf)).select(T, "RESULT", "REMARKS")


@register(
    "n01_company_asset_rank",
    "SELECT STRATEGY, MANAGEMENT_COMPANY_NAME, A AS NET_ASSET, row_number() OVER (PARTITION BY STRATEGY ORDER BY A DESC, MANAGEMENT_COMPANY_NAME) AS PLACE FROM (SELECT STRATEGY, MANAGEMENT_COMPANY_NAME, round(sum(NET_ASSET), 4) AS A FROM (SELECT LEVEL_SUM AS STRATEGY, MANAGEMENT_COMPANY_NAME, NET_ASSET FROM fx_dd WHERE IS_MAIN = 1 UNION ALL SELECT LEVEL_2, MANAGEMENT_COMPANY_NAME, NET_ASSET FROM fx_dd WHERE IS_MAIN = 1 AND LEVEL_2 = '指数增强') u GROUP BY 1, 2) t",
    INPUT,
)
def n01_company_asset_rank(spark, sf):
    return dd.company_asset_rank(_funds(spark, sf))


SPELLS = {
    "fx_spells": "SELECT concat('P', CAST(c_custkey % 97 AS VARCHAR(5))) AS PERSON, concat('F', CAST(o_custkey % 50 AS VARCHAR(10))) AS TICKER_SYMBOL, CAST(o_orderdate AS DATE) AS START_DATE, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 400 DAY AS DATE) END AS END_DATE, o_totalprice AS NET_ASSET, c_mktsegment AS STRATEGY FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
}


def _spells(spark, sf):
    return spark.sql(SPELLS["fx_spells"], orders=fx.table(spark, sf, "orders"), customer=fx.table(spark, sf, "customer"))


def _today():
    return F.to_date(F.lit("2001-10-31"))


@register(
    "n02_manager_tenure",
    f"SELECT s.TICKER_SYMBOL, string_agg(s.PERSON, ',' ORDER BY s.PERSON) AS MANAGERS, max(y.Y) AS MANAGER_YEARS FROM (SELECT DISTINCT TICKER_SYMBOL, PERSON FROM fx_spells WHERE END_DATE IS NULL) s JOIN (SELECT PERSON, round((max(coalesce(END_DATE, {TODAY})) - min(START_DATE)) / 365, 4) AS Y FROM fx_spells GROUP BY 1) y USING (PERSON) GROUP BY 1",
    SPELLS,
)
def n02_manager_tenure(spark, sf):
    return dd.manager_tenure(_spells(spark, sf), _today())


@register("n03_manager_change_flag", f"SELECT TICKER_SYMBOL, max(CASE WHEN END_DATE BETWEEN DATE '2000-10-31' AND {TODAY} THEN 1 ELSE 0 END) AS CHANGED FROM fx_spells GROUP BY 1", SPELLS)
def n03_manager_change_flag(spark, sf):
    return dd.manager_changed(_spells(spark, sf), F.to_date(F.lit("2000-10-31")), _today())


@register("n04_staff_loss_score", "SELECT MANAGEMENT_COMPANY_NAME, LEAVERS, MANAGERS, round(LEAVERS / MANAGERS, 6) AS LOSS_RATE, CAST(CASE WHEN LEAVERS / MANAGERS <= 0.1 THEN 5 WHEN LEAVERS / MANAGERS <= 0.2 THEN 4 WHEN LEAVERS / MANAGERS <= 0.3 THEN 3 WHEN LEAVERS / MANAGERS <= 0.4 THEN 2 WHEN LEAVERS / MANAGERS <= 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS LOSS_SCORE FROM (SELECT n_name AS MANAGEMENT_COMPANY_NAME, count(*) FILTER (WHERE c_acctbal < n_nationkey * 250) AS LEAVERS, count(*) AS MANAGERS FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) t")
def n04_staff_loss_score(spark, sf):
    j = fx.table(spark, sf, "customer").join(fx.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    companies = j.groupBy(F.col("n_name").alias("MANAGEMENT_COMPANY_NAME")).agg(F.count(F.when(F.col("c_acctbal") < F.col("n_nationkey") * 250, 1)).alias("LEAVERS"), F.count(F.lit(1)).alias("MANAGERS"))
    return dd.staff_loss_score(companies)


@register("n05_evaluation_window", f"SELECT i.TICKER_SYMBOL, greatest(coalesce(s.MS, i.ESTABLISH_DATE), DATE '1998-10-31') AS EVAL_START, {TODAY} AS EVAL_END FROM fx_fund_info i LEFT JOIN (SELECT TICKER_SYMBOL, min(START_DATE) AS MS FROM fx_spells WHERE END_DATE IS NULL GROUP BY 1) s USING (TICKER_SYMBOL)", SPELLS)
def n05_evaluation_window(spark, sf):
    starts = _spells(spark, sf).where("END_DATE IS NULL").groupBy(T).agg(F.min("START_DATE").alias("MANAGER_START"))
    return dd.evaluation_window(fx.view(spark, sf, "fx_fund_info").join(starts, T, "left"), _today()).select(T, "EVAL_START", "EVAL_END")


@register(
    "n06_excess_ir_drawdown",
    f"SELECT b.TICKER_SYMBOL, round(c.ANNUAL_RETURN - (pow(1 + b.BCUM, 365 / (b.D1 - b.D2 + 1)) - 1), 5) + 0.0 AS EXCESS, round(coalesce((pow(exp(b.SLA), 365 / (b.D1 - b.D2 + 1)) - 1) / nullif(b.AVOL * sqrt(252), 0), 0), 5) + 0.0 AS IR, round(c.MAXDD / nullif(b.BMDD, 0), 5) AS DRAWDOWN_RATIO FROM fx_b b JOIN ({classic_sql('fx_c')}) c USING (TICKER_SYMBOL) WHERE b.D2 IS NOT NULL",
    {**BENCH_VIEWS, **CLASSIC},
)
def n06_excess_ir_drawdown(spark, sf):
    out = perf.benchmark_stats(bench_panel(spark, sf), own=True)
    return rounded(out.select(T, (F.col("ANNUAL_RETURN") - F.col("BENCH_ANNUAL_RETURN")).alias("EXCESS"), "IR", F.try_divide("MAXDD", "BENCH_MAXDD").alias("DRAWDOWN_RATIO")), 5)


@register("n07_best_available_rank", "SELECT TICKER_SYMBOL, CASE WHEN K % 3 = 0 THEN RETURN_RANK WHEN K % 3 = 1 THEN DRAWDOWN_RANK ELSE SHARPE_RANK END AS RETURN_BEST FROM fx_dd", INPUT)
def n07_best_available_rank(spark, sf):
    k = F.col("K") % 3
    ranked = _funds(spark, sf).select(T, F.when(k == 0, F.col("RETURN_RANK")).alias("R_3Y"), F.when(k <= 1, F.col("DRAWDOWN_RANK")).alias("R_2Y"), F.col("SHARPE_RANK").alias("R_1Y"))
    return dd.best_rank(ranked, "R", "RETURN_BEST").select(T, "RETURN_BEST")


@register("n08_manager_strategy_assets", "SELECT s.TICKER_SYMBOL, round(max(B), 2) AS MANAGER_ASSET FROM fx_spells s JOIN (SELECT PERSON, STRATEGY, sum(CAST(round(NET_ASSET * 100) AS BIGINT))::DOUBLE / 100 AS B FROM fx_spells GROUP BY 1, 2) b USING (PERSON, STRATEGY) GROUP BY 1", SPELLS)
def n08_manager_strategy_assets(spark, sf):
    return rounded(dd.manager_assets(_spells(spark, sf)), 2)


@register("n12_company_notes_override", "SELECT TICKER_SYMBOL, CASE WHEN MANAGEMENT_COMPANY_NAME LIKE '%1%' THEN concat('note ', MANAGEMENT_COMPANY_NAME) ELSE '公司近三年合规表现良好，具备较为完善的内控机制' END AS COMPLIANCE, CAST(CASE WHEN POOL_YEARS < 1 THEN 0 WHEN POOL_YEARS > 2 THEN 10 ELSE 5 END AS DOUBLE) AS BONUS FROM fx_dd", INPUT)
def n12_company_notes_override(spark, sf):
    n = fx.table(spark, sf, "nation").where("n_name LIKE '%1%'")
    notes = n.select(F.col("n_name").alias(dd.COMPANY), F.concat(F.lit("note "), "n_name").alias("COMPLIANCE"))
    return dd.company_notes(_funds(spark, sf), notes).select(T, "COMPLIANCE", dd.pool_age_bonus(F.col("POOL_YEARS")).alias("BONUS"))


@register(
    "n13_related_class_text",
    "SELECT p.T AS TICKER_SYMBOL, string_agg(L, ';' ORDER BY L) AS RELATED_FUNDS FROM (SELECT r.T, concat(f.SEC_SHORT_NAME, ':', f.TICKER_SYMBOL, CASE WHEN f.K % 2 = 0 THEN concat('(', f.TRANCHE, ')') ELSE '' END) AS L FROM (SELECT TICKER_SYMBOL AS T, concat('F', K // 3) AS R FROM fx_dd WHERE K % 5 <> 0 UNION SELECT TICKER_SYMBOL, TICKER_SYMBOL FROM fx_dd WHERE K % 5 = 0 OR K % 2 = 0) r JOIN fx_dd f ON f.TICKER_SYMBOL = r.R) p GROUP BY 1",
    INPUT,
)
def n13_related_class_text(spark, sf):
    funds = _funds(spark, sf)
    fund = F.concat(F.lit("F"), F.floor(F.col("K") / 3).cast("string"))
    one = funds.where("K % 5 <> 0").select(T, fund.alias("RELATED"))
    two = funds.where("K % 5 <> 0 AND K % 2 = 0").select(T, F.col(T).alias("RELATED"))
    return dd.related_text([one, two], funds, funds.where("K % 2 = 0").select(T, "TRANCHE"))


# --- user functions ---


def _range(pdf):
    import pandas as pd

    return pd.DataFrame({"TICKER_SYMBOL": [pdf["TICKER_SYMBOL"].iloc[0]], "SPREAD": [pdf["NAV"].max() - pdf["NAV"].min()]})


@register("u02_user_function_per_entity", "SELECT TICKER_SYMBOL, round(max(ADJ_NAV) - min(ADJ_NAV), 6) + 0.0 AS SPREAD FROM fx_nav GROUP BY 1")
def u02_user_function_per_entity(spark, sf):
    nav = fx.view(spark, sf, "fx_nav").select(T, F.col("ADJ_NAV").alias("NAV"))
    return rounded(nav.groupBy(T).applyInPandas(_range, "TICKER_SYMBOL string, SPREAD double"))


@register("u03_expression_builders", "SELECT LEVEL_1, TICKER_SYMBOL, round(percent_rank() OVER (PARTITION BY LEVEL_1 ORDER BY ACCTBAL) * 100, 6) AS PR FROM fx_fund_type")
def u03_expression_builders(spark, sf):
    df = fx.view(spark, sf, "fx_fund_type").select("LEVEL_1", T, "ACCTBAL")
    return ranks.percent_rank(df, "ACCTBAL", ["LEVEL_1"], "PR").select("LEVEL_1", T, F.round(F.col("PR") * 100, 6).alias("PR"))


def _add_class(df, types):
    return df.join(types, T)


def _only(df, level):
    return df.where(F.col("LEVEL_1") == level)


@register("u04_transform_stages", "SELECT n.TICKER_SYMBOL, n.END_DATE, round(n.NAV, 6) AS NAV, t.LEVEL_2 FROM fx_fund_nav n JOIN fx_fund_type t USING (TICKER_SYMBOL) WHERE t.LEVEL_1 = 'ASIA'")
def u04_transform_stages(spark, sf):
    types = fx.view(spark, sf, "fx_fund_type").select(T, "LEVEL_1", "LEVEL_2")
    out = fx.view(spark, sf, "fx_fund_nav").transform(_add_class, types).transform(_only, "ASIA").transform(rounded)
    return out.select(T, "END_DATE", "NAV", "LEVEL_2")


@register("u05_row_rules", "SELECT TICKER_SYMBOL, CASE WHEN FUND_ASSET > 50 AND EXCESS > 0 THEN 'large winner' WHEN FUND_ASSET > 50 THEN 'large' WHEN EXCESS > 0 THEN 'winner' ELSE 'other' END AS KIND FROM fx_dd", INPUT)
def u05_row_rules(spark, sf):
    large, winner = F.col("FUND_ASSET") > 50, F.col("EXCESS") > 0
    kind = F.when(large & winner, "large winner").when(large, "large").when(winner, "winner").otherwise("other")
    return _funds(spark, sf).select(T, kind.alias("KIND"))
