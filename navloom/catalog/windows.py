"""Window functions, ranks, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.functions import series as s
from navloom.functions.exprs import arg_max
from navloom.operators import ranks
from navloom.operators.aggregates import relaxed_union, top_per_group, union_all
from navloom.sources import fixtures as fx

T, D = "TICKER_SYMBOL", "END_DATE"
W = "OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE)"
UPTO = "OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _series(name, exprs, sql, view="fx_nav", digits=6):
    """A query of window expressions over one entity's series: {column: expression of (value, window)}."""
    text = ", ".join(f"round({e}, {digits}) + 0.0 AS {c}" for c, e in sql.items())
    value = "NAV" if view == "fx_fund_nav" else "ADJ_NAV"

    @register(name, f"SELECT TICKER_SYMBOL, END_DATE, {text} FROM (SELECT TICKER_SYMBOL, END_DATE, {value} AS X FROM {view}) t")
    def query(spark, sf):
        df = fx.view(spark, sf, view).select(T, D, F.col(value).alias("X"))
        w = s.by([T], D)
        return rounded(df.select(T, D, *[fn(F.col("X"), w).alias(c) for c, fn in exprs.items()]), digits)


_series("e01_simple_return", {"R": s.daily_return}, {"R": f"X / lag(X) {W} - 1"})
_series("e02_log_return", {"R": s.daily_log_return}, {"R": f"ln(X / lag(X) {W})"})
_series("e03_running_max_drawdown", {"HIGH": lambda x, w: F.max(x).over(s.upto(w)), "DD": s.drawdown}, {"HIGH": f"max(X) {UPTO}", "DD": f"1 - X / max(X) {UPTO}"})
_series("e04_running_sum_product", {"S": s.running_sum, "P": s.running_product}, {"S": f"sum(X) {UPTO}", "P": f"exp(sum(ln(X)) {UPTO})"})
_series(
    "e15_fixed_row_moving_average",
    {"MA5": lambda x, w: s.moving_mean(x, w, 5), "MA20": lambda x, w: s.moving_mean(x, w, 20), "MA60": lambda x, w: s.moving_mean(x, w, 60)},
    {f"MA{n}": f"avg(X) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (5, 20, 60)},
    digits=5,
    view="fx_fund_nav",
)
_ROLL5 = "OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
_series("e16_rolling_mean_min_periods", {"MA": lambda x, w: s.moving_mean(x, w, 5, 5)}, {"MA": f"CASE WHEN count(X) {_ROLL5} = 5 THEN avg(X) {_ROLL5} END"}, digits=8)
_series("e19_partition_min_max", {"LO": lambda x, w: F.min(x).over(ranks.Window.partitionBy(T)), "HI": lambda x, w: F.max(x).over(ranks.Window.partitionBy(T))}, {"LO": "min(X) OVER (PARTITION BY TICKER_SYMBOL)", "HI": "max(X) OVER (PARTITION BY TICKER_SYMBOL)"})
_series(
    "e20_lag_n_return",
    {f"R{n}": (lambda n: lambda x, w: s.lag_return(x, w, n))(n) for n in (7, 20, 40, 60, 120, 240)},
    {f"R{n}": f"X / lag(X, {n}) {W} - 1" for n in (7, 20, 40, 60, 120, 240)},
    view="fx_fund_nav",
)
_series("e21_lagged_weight_return", {"C": lambda x, w: s.lagged_weight_return(x, s.daily_return(x, w), w)}, {"C": f"coalesce(lag(X) {W}, 0) * (X / lag(X) {W} - 1)"})
_series("e22_first_difference", {"DX": s.difference}, {"DX": f"X - lag(X) {W}"})
_series("e23_rebase_to_first", {"X1": s.rebase}, {"X1": f"X / first_value(X) {W}"})

GAPPY = {"fx_gappy": "SELECT g.TICKER_SYMBOL, d.TRADE_DT AS END_DATE, o.NAV FROM (SELECT TICKER_SYMBOL, min(END_DATE) AS F FROM fx_nav_obs GROUP BY 1) g JOIN fx_trading d ON d.TRADE_DT >= g.F LEFT JOIN fx_nav_obs o ON o.TICKER_SYMBOL = g.TICKER_SYMBOL AND o.END_DATE = d.TRADE_DT"}


@register("e18_forward_fill", "SELECT TICKER_SYMBOL, END_DATE, round(last_value(NAV IGNORE NULLS) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE ROWS UNBOUNDED PRECEDING), 6) AS NAV FROM fx_gappy", GAPPY)
def e18_forward_fill(spark, sf):
    return rounded(fx.view(spark, sf, "fx_fund_nav").select(T, D, "NAV"))


@register("c03_calendar_right_join", "SELECT d.TRADE_DT, count(n.NAV) AS N, round(avg(n.NAV), 6) AS MEAN_NAV FROM fx_nav_sparse n RIGHT JOIN fx_trading d ON n.END_DATE = d.TRADE_DT GROUP BY 1")
def c03_calendar_right_join(spark, sf):
    days = fx.trading_days(fx.calendar(spark, sf))
    obs = fx.view(spark, sf, "fx_nav_sparse").withColumnRenamed("END_DATE", "TRADE_DT")
    return rounded(obs.join(days, "TRADE_DT", "right").groupBy("TRADE_DT").agg(F.count("NAV").alias("N"), F.avg("NAV").alias("MEAN_NAV")))


# --- ranks over (date, class) groups, some values nulled to show the null rules ---

RANK_VIEWS = {
    "fx_rk": """SELECT n.TICKER_SYMBOL, n.END_DATE, t.LEVEL_1, CASE WHEN length(n.TICKER_SYMBOL) = 2 AND n.ADJ_NAV < 1.0005 THEN NULL ELSE round(n.ADJ_NAV, 3) END AS V
FROM fx_nav n JOIN fx_type t USING (TICKER_SYMBOL)"""
}


def _rk(spark, sf):
    df = fx.view(spark, sf, "fx_nav").join(fx.view(spark, sf, "fx_type").select(T, "LEVEL_1"), T)
    hidden = (F.length(T) == 2) & (F.col("ADJ_NAV") < 1.0005)
    return df.select(T, D, "LEVEL_1", F.when(~hidden, F.round("ADJ_NAV", 3)).alias("V"))


_G = ["END_DATE", "LEVEL_1"]
_AVG = "rank() OVER (PARTITION BY END_DATE, LEVEL_1 ORDER BY V {d} NULLS LAST) + (count(*) OVER (PARTITION BY END_DATE, LEVEL_1, V) - 1) / 2.0"
_CNT = "count(V) OVER (PARTITION BY END_DATE, LEVEL_1)"


@register("e05_percent_rank_sql", "SELECT *, round(percent_rank() OVER (PARTITION BY END_DATE, LEVEL_1 ORDER BY V NULLS FIRST), 6) AS PR, round(percent_rank() OVER (PARTITION BY END_DATE, LEVEL_1 ORDER BY V DESC NULLS LAST), 6) AS PR_DESC FROM fx_rk", RANK_VIEWS)
def e05_percent_rank_sql(spark, sf):
    up = ranks.percent_rank(_rk(spark, sf), "V", _G, "PR")
    return rounded(ranks.percent_rank(up, "V", _G, "PR_DESC", descending=True))


@register("e06_percent_rank_mean_tie", f"SELECT *, CASE WHEN V IS NOT NULL THEN round(100 * (floor({_AVG.format(d='DESC')}) - 1) / nullif({_CNT} - 1, 0), 6) END AS RANK_PCT FROM fx_rk", RANK_VIEWS)
def e06_percent_rank_mean_tie(spark, sf):
    return rounded(ranks.rank_pct(_rk(spark, sf), "V", _G, "RANK_PCT"))


@register("e07_rank_text", f"SELECT *, CASE WHEN V IS NOT NULL THEN concat(CAST(CAST(floor({_AVG.format(d='DESC')}) AS BIGINT) AS VARCHAR), '/', CAST({_CNT} AS VARCHAR)) END AS RANK_TEXT FROM fx_rk", RANK_VIEWS)
def e07_rank_text(spark, sf):
    return ranks.rank_str(_rk(spark, sf), "V", _G, "RANK_TEXT")


@register("e08_fractional_rank", f"SELECT *, CASE WHEN V IS NOT NULL THEN round(({_AVG.format(d='ASC')}) / {_CNT}, 6) END AS FRACTION FROM fx_rk", RANK_VIEWS)
def e08_fractional_rank(spark, sf):
    return rounded(ranks.rank_fraction(_rk(spark, sf), "V", _G, "FRACTION"))


_ORDER = "ORDER BY V DESC, TICKER_SYMBOL"
_PART = "OVER (PARTITION BY END_DATE, LEVEL_1 ORDER BY V DESC, TICKER_SYMBOL)"


def _order():
    return [-F.col("V"), F.col(T)]


@register("e09_first_come_rank", f"SELECT END_DATE, LEVEL_1, TICKER_SYMBOL, V, concat(CAST(row_number() {_PART} AS VARCHAR), '/', CAST({_CNT} AS VARCHAR)) AS RANK_TEXT FROM fx_rk WHERE V IS NOT NULL", RANK_VIEWS)
def e09_first_come_rank(spark, sf):
    df = ranks.row_numbers(_rk(spark, sf).where("V IS NOT NULL"), _G, _order(), "R", "N")
    return df.select("END_DATE", "LEVEL_1", T, "V", F.concat_ws("/", "R", "N").alias("RANK_TEXT"))


@register("e10_ntile", f"SELECT END_DATE, LEVEL_1, TICKER_SYMBOL, V, CAST(ntile(10) {_PART} AS INTEGER) AS BUCKET FROM fx_rk WHERE V IS NOT NULL", RANK_VIEWS)
def e10_ntile(spark, sf):
    return ranks.ntile(_rk(spark, sf).where("V IS NOT NULL"), 10, _G, _order(), "BUCKET").select("END_DATE", "LEVEL_1", T, "V", "BUCKET")


@register(
    "e11_equal_frequency_groups",
    "SELECT END_DATE, LEVEL_1, TICKER_SYMBOL, V, CAST(CASE WHEN N < 5 THEN 1 ELSE 6 - greatest(1, CAST(ceil((R - 1) * 5.0 / greatest(N - 1, 1)) AS INTEGER)) END AS INTEGER) AS GRP "
    "FROM (SELECT *, row_number() OVER (PARTITION BY END_DATE, LEVEL_1 ORDER BY V, TICKER_SYMBOL) AS R, count(*) OVER (PARTITION BY END_DATE, LEVEL_1) AS N FROM fx_rk WHERE V IS NOT NULL) t",
    RANK_VIEWS,
)
def e11_equal_frequency_groups(spark, sf):
    df = _rk(spark, sf).where("V IS NOT NULL")
    return ranks.quantile_group(df, 5, _G, [F.col("V"), F.col(T)], "GRP").select("END_DATE", "LEVEL_1", T, "V", "GRP")


@register("e12_row_number", f"SELECT END_DATE, LEVEL_1, TICKER_SYMBOL, V, row_number() {_PART} AS RN FROM fx_rk WHERE V IS NOT NULL", RANK_VIEWS)
def e12_row_number(spark, sf):
    return ranks.row_numbers(_rk(spark, sf).where("V IS NOT NULL"), _G, _order(), "RN").select("END_DATE", "LEVEL_1", T, "V", "RN")


@register("e13_rank_top_k", "SELECT * FROM (SELECT *, rank() OVER (PARTITION BY END_DATE, LEVEL_1 ORDER BY V DESC) AS RK FROM fx_rk WHERE V IS NOT NULL) t WHERE RK <= 3", RANK_VIEWS)
def e13_rank_top_k(spark, sf):
    return ranks.sql_rank(_rk(spark, sf).where("V IS NOT NULL"), _G, [-F.col("V")], "RK").where("RK <= 3")


_SHARE = "SELECT REPORT_DATE, FUND_ID, SECTOR, sum(MARKET_VALUE) AS MV FROM fx_holdings GROUP BY 1, 2, 3"


@register("e14_lag_within_category", f"SELECT REPORT_DATE, FUND_ID, SECTOR, round(abs(MV - lag(MV) OVER (PARTITION BY FUND_ID, SECTOR ORDER BY REPORT_DATE)), 2) + 0.0 AS MOVE FROM ({_SHARE}) t")
def e14_lag_within_category(spark, sf):
    df = fx.view(spark, sf, "fx_holdings").groupBy("REPORT_DATE", "FUND_ID", "SECTOR").agg(F.sum("MARKET_VALUE").alias("MV"))
    w = s.by(["FUND_ID", "SECTOR"], "REPORT_DATE")
    return rounded(df.select("REPORT_DATE", "FUND_ID", "SECTOR", F.abs(s.difference(F.col("MV"), w)).alias("MOVE")), 2)


@register(
    "e17_rolling_percentile_rank",
    """SELECT a.TICKER_SYMBOL, a.END_DATE, CASE WHEN a.RN >= 850 THEN round((sum(CASE WHEN b.X > a.X THEN 1 ELSE 0 END) + (sum(CASE WHEN b.X = a.X THEN 1 ELSE 0 END) + 1) / 2.0) / 850.0, 6) END AS ROLLING_RANK
FROM fx_r a JOIN fx_r b ON a.TICKER_SYMBOL = b.TICKER_SYMBOL AND b.RN BETWEEN a.RN - 849 AND a.RN GROUP BY a.TICKER_SYMBOL, a.END_DATE, a.RN""",
    {"fx_r": "SELECT TICKER_SYMBOL, END_DATE, ADJ_NAV AS X, row_number() OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) AS RN FROM fx_nav_long"},
)
def e17_rolling_percentile_rank(spark, sf):
    df = fx.view(spark, sf, "fx_nav_long").select(T, D, "ADJ_NAV")
    return rounded(ranks.rolling_ranks(df, {"ADJ_NAV": "ROLLING_RANK"}, [T], D, 850).select(T, D, "ROLLING_RANK"))


# --- sorts and limits ---


@register("f01_multi_key_sort", "SELECT s_name, s_nationkey, s_acctbal FROM supplier ORDER BY s_nationkey, s_acctbal DESC")
def f01_multi_key_sort(spark, sf):
    return fx.table(spark, sf, "supplier").select("s_name", "s_nationkey", "s_acctbal").orderBy("s_nationkey", F.desc("s_acctbal"))


@register("f02_offset_limit", "SELECT TRADE_DT FROM fx_trading ORDER BY TRADE_DT DESC LIMIT 1 OFFSET 20")
def f02_offset_limit(spark, sf):
    return fx.trading_days(fx.calendar(spark, sf)).orderBy(F.desc("TRADE_DT")).offset(20).limit(1)


@register("f03_top_n_latest", "SELECT TRADE_DT FROM fx_trading ORDER BY TRADE_DT DESC LIMIT 5")
def f03_top_n_latest(spark, sf):
    return fx.trading_days(fx.calendar(spark, sf)).orderBy(F.desc("TRADE_DT")).limit(5)


@register(
    "f04_top_k_per_group",
    "SELECT REPORT_DATE, FUND_ID, HOLDING_TICKER_SYMBOL, MARKET_VALUE, RANK_NO FROM (SELECT *, row_number() OVER (PARTITION BY REPORT_DATE, FUND_ID ORDER BY MARKET_VALUE DESC, HOLDING_TICKER_SYMBOL) AS RANK_NO FROM fx_holdings) t WHERE RANK_NO <= 10",
)
def f04_top_k_per_group(spark, sf):
    df = fx.view(spark, sf, "fx_holdings").select("REPORT_DATE", "FUND_ID", "HOLDING_TICKER_SYMBOL", "MARKET_VALUE")
    return top_per_group(df, ["REPORT_DATE", "FUND_ID"], [-F.col("MARKET_VALUE"), F.col("HOLDING_TICKER_SYMBOL")], 10)


@register(
    "f05_arg_max_column",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount >= l_tax AND l_discount >= l_quantity / 500 THEN 'DISCOUNT' WHEN l_tax >= l_quantity / 500 THEN 'TAX' ELSE 'SIZE' END AS STYLE FROM lineitem",
)
def f05_arg_max_column(spark, sf):
    df = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("DISCOUNT"), F.col("l_tax").alias("TAX"), (F.col("l_quantity") / 500).alias("SIZE"))
    return df.select("l_orderkey", "l_linenumber", arg_max(["DISCOUNT", "TAX", "SIZE"]).alias("STYLE"))


# --- set operations ---


@register("g01_union_distinct", "SELECT c_nationkey AS NATION FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def g01_union_distinct(spark, sf):
    parts = [("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")]
    return union_all([fx.table(spark, sf, t).select(F.col(c).alias("NATION")) for t, c in parts]).distinct()


@register("g02_union_all", "SELECT SRC, count(*) AS N, round(sum(BAL), 2) AS BAL FROM (SELECT 'c' AS SRC, CAST(round(c_acctbal * 100) AS BIGINT) / 100 AS BAL FROM customer UNION ALL SELECT 's', CAST(round(s_acctbal * 100) AS BIGINT) / 100 FROM supplier) t GROUP BY 1")
def g02_union_all(spark, sf):
    c = fx.table(spark, sf, "customer").select(F.lit("c").alias("SRC"), F.col("c_acctbal").alias("BAL"))
    p = fx.table(spark, sf, "supplier").select(F.lit("s").alias("SRC"), F.col("s_acctbal").alias("BAL"))
    return rounded(union_all([c, p]).groupBy("SRC").agg(F.count(F.lit(1)).alias("N"), F.sum("BAL").alias("BAL")), 2)


@register("g03_relaxed_union", "SELECT s_suppkey AS ID, s_name AS NAME, s_acctbal AS BAL, CAST(NULL AS VARCHAR) AS SEGMENT FROM supplier UNION ALL SELECT c_custkey, c_name, round(c_acctbal), c_mktsegment FROM customer")
def g03_relaxed_union(spark, sf):
    stored = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("NAME"), F.col("s_acctbal").alias("BAL"))
    new = fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("SEGMENT"), F.round("c_acctbal").cast("int").alias("BAL"), F.col("c_name").alias("NAME"), F.col("c_custkey").alias("ID"))
    return relaxed_union(stored, new)


@register("g04_difference", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity >= 50")
def g04_difference(spark, sf):
    sold = fx.table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"))
    return fx.table(spark, sf, "part").select("p_partkey").join(sold, "p_partkey", "left_anti").distinct()
