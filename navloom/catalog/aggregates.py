"""Aggregations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.functions.series import by, daily_log_return, daily_return
from navloom.operators import aggregates as agg
from navloom.operators import ranks
from navloom.sources import fixtures as fx

CENTS = "CAST(round({c} * 100) AS BIGINT)"


def cents(c):
    return F.round(F.col(c) * 100).cast("bigint")


def _line(spark, sf, *cols):
    return fx.table(spark, sf, "lineitem").select(*cols)


@register(
    "d01_group_aggregates",
    """SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS BIGINT))::BIGINT AS SUM_QTY, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS SUM_PRICE,
 round(avg(l_discount), 6) AS AVG_DISC, min(l_extendedprice) AS MIN_PRICE, max(l_extendedprice) AS MAX_PRICE, count(*) AS N FROM lineitem GROUP BY 1, 2""",
)
def d01_group_aggregates(spark, sf):
    df = _line(spark, sf, "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount")
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("SUM_QTY"), (F.sum(cents("l_extendedprice")).cast("double") / 100).alias("SUM_PRICE"),
        F.round(F.avg("l_discount"), 6).alias("AVG_DISC"), F.min("l_extendedprice").alias("MIN_PRICE"), F.max("l_extendedprice").alias("MAX_PRICE"), F.count(F.lit(1)).alias("N"),
    )


SECTORS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register(
    "d02_conditional_sum_pivot",
    "SELECT REPORT_DATE, FUND_ID, " + ", ".join(f"round(sum(CASE WHEN SECTOR = '{s}' THEN MARKET_VALUE ELSE 0 END), 2) AS {s}" for s in SECTORS) + " FROM fx_holdings GROUP BY 1, 2",
)
def d02_conditional_sum_pivot(spark, sf):
    return rounded(agg.conditional_sums(fx.view(spark, sf, "fx_holdings"), ["REPORT_DATE", "FUND_ID"], "SECTOR", "MARKET_VALUE", SECTORS), 2)


@register("d03_distinct_keep_last", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def d03_distinct_keep_last(spark, sf):
    df = fx.table(spark, sf, "events").select("user_id", "event_id", "value", "ts")
    return agg.keep_last(df, ["user_id"], ["ts", "event_id"]).drop("ts")


_SETS = agg.level_grouping_sets(["LEVEL_1", "LEVEL_2", "LEVEL_3"], ["COMPANY", "INDUSTRY"])
_SET_COLS = ["LEVEL_1", "LEVEL_2", "LEVEL_3", "COMPANY", "INDUSTRY"]
GS_VIEWS = {
    "fx_gs": """SELECT h.REPORT_DATE, t.LEVEL_1, t.LEVEL_2, t.LEVEL_3, i.MANAGEMENT_COMPANY_NAME AS COMPANY, h.INDUSTRY_NAME AS INDUSTRY, h.FUND_ID, h.MARKET_VALUE
FROM fx_holdings h JOIN fx_fund_type t ON h.FUND_ID = t.TICKER_SYMBOL JOIN fx_fund_info i ON h.FUND_ID = i.TICKER_SYMBOL"""
}


def _gs(spark, sf):
    h = fx.view(spark, sf, "fx_holdings").select("REPORT_DATE", "FUND_ID", F.col("INDUSTRY_NAME").alias("INDUSTRY"), "MARKET_VALUE")
    t = fx.view(spark, sf, "fx_fund_type").select(F.col("TICKER_SYMBOL").alias("FUND_ID"), "LEVEL_1", "LEVEL_2", "LEVEL_3")
    i = fx.view(spark, sf, "fx_fund_info").select(F.col("TICKER_SYMBOL").alias("FUND_ID"), F.col("MANAGEMENT_COMPANY_NAME").alias("COMPANY"))
    return h.join(t, "FUND_ID").join(i, "FUND_ID")


@register(
    "d04_grouping_sets",
    "SELECT REPORT_DATE, "
    + ", ".join(f"CASE WHEN grouping({c}) = 1 THEN 'ALL' ELSE {c} END AS {c}" for c in _SET_COLS)
    + ", concat_ws('+', "
    + ", ".join(f"CASE WHEN grouping({c}) = 0 THEN '{c}' END" for c in _SET_COLS)
    + ") AS GROUP_SET, count(*) AS N, CAST(sum(CAST(round(MARKET_VALUE * 100) AS BIGINT)) AS DOUBLE) / 100 AS MV FROM fx_gs GROUP BY GROUPING SETS ("
    + ", ".join("(" + ", ".join(["REPORT_DATE", *s]) + ")" for s in _SETS)
    + ")",
    GS_VIEWS,
)
def d04_grouping_sets(spark, sf):
    sums = [F.count(F.lit(1)).alias("N"), (F.sum(cents("MARKET_VALUE")).cast("double") / 100).alias("MV")]
    return agg.grouping_sets(_gs(spark, sf), _SETS, _SET_COLS, sums, keys=["REPORT_DATE"]).select("REPORT_DATE", *_SET_COLS, "GROUP_SET", "N", "MV")


@register(
    "d05_class_median_mean",
    " UNION ALL ".join(
        f"SELECT n.END_DATE, '{c}' AS LEVEL, {c} AS CLASS, round(quantile_cont(R, 0.5), 6) + 0.0 AS MEDIAN, round(avg(R), 6) + 0.0 AS MEAN, count(R) AS N FROM fx_nr n JOIN fx_type t USING (TICKER_SYMBOL) WHERE R IS NOT NULL GROUP BY 1, 3"
        for c in ("LEVEL_1", "LEVEL_2", "LEVEL_3")
    ),
    {"fx_nr": "SELECT TICKER_SYMBOL, END_DATE, (ADJ_NAV / lag(ADJ_NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1) * 100 AS R FROM fx_nav"},
)
def d05_class_median_mean(spark, sf):
    nav = fx.view(spark, sf, "fx_nav")
    ret = nav.select("TICKER_SYMBOL", "END_DATE", (daily_return(F.col("ADJ_NAV"), by(["TICKER_SYMBOL"], "END_DATE")) * 100).alias("R")).where("R IS NOT NULL")
    return rounded(agg.class_averages(ret.join(fx.view(spark, sf, "fx_type"), "TICKER_SYMBOL"), ["LEVEL_1", "LEVEL_2", "LEVEL_3"], ["END_DATE"], "R"))


@register(
    "d06_quantiles_win_rate",
    """SELECT year(o_orderdate)::INTEGER AS Y, quantile_cont(o_totalprice, 0.25) AS P25, quantile_cont(o_totalprice, 0.5) AS P50, quantile_cont(o_totalprice, 0.75) AS P75, min(o_totalprice) AS LO, max(o_totalprice) AS HI,
 round(avg(CASE WHEN o_totalprice > 150000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS WIN FROM orders GROUP BY 1""".replace("quantile_cont(o_totalprice, 0.25)", "round(quantile_cont(o_totalprice, 0.25), 4)").replace("quantile_cont(o_totalprice, 0.5)", "round(quantile_cont(o_totalprice, 0.5), 4)").replace("quantile_cont(o_totalprice, 0.75)", "round(quantile_cont(o_totalprice, 0.75), 4)"),
)
def d06_quantiles_win_rate(spark, sf):
    df = fx.table(spark, sf, "orders").select(F.year("o_orderdate").alias("Y"), "o_totalprice")
    q = ranks.quantiles(df, ["Y"], "o_totalprice", {"P25": 0.25, "P50": 0.5, "P75": 0.75})
    rest = df.groupBy("Y").agg(F.min("o_totalprice").alias("LO"), F.max("o_totalprice").alias("HI"), F.round(F.avg(F.when(F.col("o_totalprice") > 150000, 1.0).otherwise(0.0)), 6).alias("WIN"))
    return q.select("Y", *[F.round(c, 4).alias(c) for c in ("P25", "P50", "P75")]).join(rest, "Y")


@register("d07_weighted_mean", "SELECT l_suppkey, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS WMEAN, round(sum(l_discount * l_quantity), 4) AS WSUM FROM lineitem GROUP BY 1")
def d07_weighted_mean(spark, sf):
    df = _line(spark, sf, "l_suppkey", "l_discount", "l_quantity")
    return df.groupBy("l_suppkey").agg(F.round(agg.weighted_mean("l_discount", "l_quantity"), 6).alias("WMEAN"), F.round(F.sum(F.col("l_discount") * F.col("l_quantity")), 4).alias("WSUM"))


@register("d08_mean_last_n_periods", "SELECT FUND_ID, round(avg(NET_ASSET), 4) AS NET_ASSET FROM fx_snapshot WHERE REPORT_DATE IN (SELECT DISTINCT REPORT_DATE FROM fx_snapshot ORDER BY 1 DESC LIMIT 4) GROUP BY 1")
def d08_mean_last_n_periods(spark, sf):
    return rounded(agg.last_periods_mean(fx.view(spark, sf, "fx_snapshot"), ["FUND_ID"], "REPORT_DATE", 4, ["NET_ASSET"]), 4)


@register("d09_string_aggregation", "SELECT LEVEL_1, LEVEL_2, string_agg(TICKER_SYMBOL, ',' ORDER BY TICKER_SYMBOL) AS MEMBERS FROM fx_fund_type GROUP BY 1, 2")
def d09_string_aggregation(spark, sf):
    return fx.view(spark, sf, "fx_fund_type").groupBy("LEVEL_1", "LEVEL_2").agg(agg.listed("TICKER_SYMBOL").alias("MEMBERS"))


@register("d10_product_aggregate", "SELECT TICKER_SYMBOL, year(END_DATE)::INTEGER AS Y, round(exp(sum(ln(1 + R))) - 1, 6) + 0.0 AS LINKED FROM (SELECT TICKER_SYMBOL, END_DATE, RETURN_RATE / 100 AS R FROM fx_fund_ret) t WHERE R IS NOT NULL GROUP BY 1, 2")
def d10_product_aggregate(spark, sf):
    ret = _returns(spark, sf).where("R IS NOT NULL")
    return rounded(ret.groupBy("TICKER_SYMBOL", F.year("END_DATE").alias("Y")).agg(agg.linked_return(F.col("R")).alias("LINKED")))


def _returns(spark, sf):
    nav = fx.view(spark, sf, "fx_fund_nav")
    w = by(["TICKER_SYMBOL"], "END_DATE")
    return nav.select("TICKER_SYMBOL", "END_DATE", daily_return(F.col("NAV"), w).alias("R"), daily_log_return(F.col("NAV"), w).alias("LR"))


@register("d11_geometric_link_logs", "SELECT TICKER_SYMBOL, year(END_DATE)::INTEGER AS Y, round(arg_max(NAV, END_DATE) / arg_min(PREV, END_DATE) - 1, 6) + 0.0 AS LINKED FROM (SELECT *, lag(NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) AS PREV FROM fx_fund_nav) t WHERE PREV IS NOT NULL GROUP BY 1, 2")
def d11_geometric_link_logs(spark, sf):
    ret = _returns(spark, sf).where("LR IS NOT NULL")
    return rounded(ret.groupBy("TICKER_SYMBOL", F.year("END_DATE").alias("Y")).agg(agg.linked_from_logs(F.col("LR") * 100).alias("LINKED")))


TE_VIEWS = {"fx_te": "SELECT f.TICKER_SYMBOL, f.END_DATE, f.RETURN_RATE, avg(f.RETURN_RATE) OVER (PARTITION BY f.END_DATE) AS B FROM fx_fund_ret f WHERE f.RETURN_RATE IS NOT NULL"}


@register("d12_tracking_error", "SELECT TICKER_SYMBOL, round(stddev_pop(RETURN_RATE - B) * sqrt(250), 5) AS TE FROM fx_te GROUP BY 1", TE_VIEWS)
def d12_tracking_error(spark, sf):
    ret = _returns(spark, sf).where("R IS NOT NULL").select("TICKER_SYMBOL", "END_DATE", (F.col("R") * 100).alias("R"))
    bench = ret.groupBy("END_DATE").agg(F.avg("R").alias("B"))
    return rounded(ret.join(bench, "END_DATE").groupBy("TICKER_SYMBOL").agg((F.stddev_pop(F.col("R") - F.col("B")) * F.sqrt(F.lit(250))).alias("TE")), 5)


COV_VIEWS = {
    "fx_lr": "SELECT TICKER_SYMBOL, END_DATE, ADJ_NAV / lag(ADJ_NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1 AS R FROM fx_nav_long",
    "fx_full": "SELECT END_DATE FROM fx_lr WHERE R IS NOT NULL GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT TICKER_SYMBOL) FROM fx_lr WHERE R IS NOT NULL)",
    "fx_cov": "SELECT a.TICKER_SYMBOL AS A, b.TICKER_SYMBOL AS B, covar_samp(a.R, b.R) * 252 AS COV FROM fx_lr a JOIN fx_lr b USING (END_DATE) JOIN fx_full f USING (END_DATE) GROUP BY 1, 2",
}


def index_returns(spark, sf):
    w = by(["TICKER_SYMBOL"], "END_DATE")
    return fx.view(spark, sf, "fx_nav_long").select("TICKER_SYMBOL", "END_DATE", daily_return(F.col("ADJ_NAV"), w).alias("R"))


@register("d13_covariance_matrix", "SELECT A, B, round(COV, 4) + 0.0 AS COV FROM fx_cov", COV_VIEWS)
def d13_covariance_matrix(spark, sf):
    return rounded(agg.annualised_covariance(index_returns(spark, sf), "TICKER_SYMBOL", "END_DATE", "R"), 4)


@register("d14_share_of_group", "SELECT REPORT_DATE, FUND_ID, HOLDING_TICKER_SYMBOL, round(MARKET_VALUE / sum(MARKET_VALUE) OVER (PARTITION BY REPORT_DATE, FUND_ID), 6) AS SHARE FROM fx_holdings")
def d14_share_of_group(spark, sf):
    df = fx.view(spark, sf, "fx_holdings").select("REPORT_DATE", "FUND_ID", "HOLDING_TICKER_SYMBOL", "MARKET_VALUE")
    return rounded(agg.share_of(df, ["REPORT_DATE", "FUND_ID"], "MARKET_VALUE", "SHARE").drop("MARKET_VALUE"))


@register("d15_first_last_by_date", "SELECT user_id, arg_min(value, (ts, event_id)) AS FIRST_VALUE, arg_max(value, (ts, event_id)) AS LAST_VALUE FROM events GROUP BY 1")
def d15_first_last_by_date(spark, sf):
    at = F.struct("ts", "event_id")
    return fx.table(spark, sf, "events").groupBy("user_id").agg(F.min_by("value", at).alias("FIRST_VALUE"), F.max_by("value", at).alias("LAST_VALUE"))


@register("d16_having", "SELECT l_partkey, count(*) AS N FROM lineitem GROUP BY 1 HAVING count(*) > 40")
def d16_having(spark, sf):
    return _line(spark, sf, "l_partkey").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("N")).where("N > 40")


@register("d17_scalar_subquery", "SELECT FUND_ID, NET_ASSET FROM fx_snapshot WHERE REPORT_DATE = (SELECT max(REPORT_DATE) FROM fx_snapshot)")
def d17_scalar_subquery(spark, sf):
    return spark.sql("SELECT FUND_ID, NET_ASSET FROM {snap} WHERE REPORT_DATE = (SELECT max(REPORT_DATE) FROM {snap})", snap=fx.view(spark, sf, "fx_snapshot"))


@register(
    "d18_subtotals",
    "SELECT coalesce(LEVEL_1, 'ALL') AS LEVEL_1, coalesce(LEVEL_2, 'ALL') AS LEVEL_2, coalesce(FUND_ID, 'ALL') AS FUND_ID, CAST(sum(CAST(round(MARKET_VALUE * 100) AS BIGINT)) AS DOUBLE) / 100 AS MV FROM fx_gs GROUP BY ROLLUP (LEVEL_1, LEVEL_2, FUND_ID)",
    GS_VIEWS,
)
def d18_subtotals(spark, sf):
    out = _gs(spark, sf).rollup("LEVEL_1", "LEVEL_2", "FUND_ID").agg((F.sum(cents("MARKET_VALUE")).cast("double") / 100).alias("MV"))
    return out.fillna("ALL", ["LEVEL_1", "LEVEL_2", "FUND_ID"])


# --- reshaping ---


@register("h01_unpivot_metrics", "SELECT n_name, INDICATOR, VALUE FROM (UNPIVOT (SELECT n_name, count(*)::DOUBLE AS N, round(min(s_acctbal), 2) AS LO, round(max(s_acctbal), 2) AS HI FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1) ON N, LO, HI INTO NAME INDICATOR VALUE VALUE) u")
def h01_unpivot_metrics(spark, sf):
    j = fx.table(spark, sf, "supplier").join(fx.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    wide = j.groupBy("n_name").agg(F.count(F.lit(1)).cast("double").alias("N"), F.round(F.min("s_acctbal"), 2).alias("LO"), F.round(F.max("s_acctbal"), 2).alias("HI"))
    return wide.unpivot(["n_name"], ["N", "LO", "HI"], "INDICATOR", "VALUE")


@register(
    "h02_unpivot_calendar",
    "SELECT * FROM (UNPIVOT (SELECT TRADE_DT AS END_DATE, PREV_TRADE_DATE AS \"近1日\", WEEK_END_DATE AS WTD, MONTH_END_DATE AS MTD, QUARTER_END_DATE AS QTD, YEAR_END_DATE AS YTD FROM fx_cal WHERE IF_TRADING_DAY = 1) ON \"近1日\", WTD, MTD, QTD, YTD INTO NAME DATE_NAME VALUE START_DATE) u",
)
def h02_unpivot_calendar(spark, sf):
    from navloom.operators.calendars import to_date_windows

    return to_date_windows(fx.calendar(spark, sf)).where("START_DATE IS NOT NULL").select("END_DATE", "DATE_NAME", "START_DATE")


@register("h03_pivot_mean", "SELECT FUND_ID, " + ", ".join(f"round(avg(round(MARKET_VALUE * 100)) FILTER (WHERE SECTOR = '{s}'), 4) AS {s}" for s in SECTORS) + " FROM fx_holdings GROUP BY 1")
def h03_pivot_mean(spark, sf):
    held = fx.view(spark, sf, "fx_holdings").withColumn("MARKET_VALUE", F.round(F.col("MARKET_VALUE") * 100))
    return rounded(agg.mean_pivot(held, ["FUND_ID"], "SECTOR", "MARKET_VALUE", SECTORS), 4)


_H04 = [f"{i}_{p}" for i in ("IR", "VOL") for p in ("3M", "6M", "1Y")]


@register(
    "h04_stack_split_names",
    "SELECT CUSTKEY, split_part(NAME, '_', 1) AS INDICATOR, split_part(NAME, '_', 2) AS PERIOD, VALUE FROM (UNPIVOT (SELECT c_custkey AS CUSTKEY, " + ", ".join(f"round(c_acctbal / {k + 1}, 4) AS {n}" for k, n in enumerate([f"{i}_{p}" for i in ("IR", "VOL") for p in ("3M", "6M", "1Y")])) + " FROM customer) ON IR_3M, IR_6M, IR_1Y, VOL_3M, VOL_6M, VOL_1Y INTO NAME NAME VALUE VALUE) u",
)
def h04_stack_split_names(spark, sf):
    wide = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("CUSTKEY"), *[F.round(F.col("c_acctbal") / (k + 1), 4).alias(n) for k, n in enumerate(_H04)])
    return agg.split_name(wide.unpivot(["CUSTKEY"], _H04, "NAME", "VALUE"), "NAME", "INDICATOR", "PERIOD").select("CUSTKEY", "INDICATOR", "PERIOD", "VALUE")


@register("h05_unstack_sums", "SELECT l_suppkey, " + ", ".join(f"sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag = '{f}')::BIGINT AS {f}" for f in "ANR") + " FROM lineitem GROUP BY 1")
def h05_unstack_sums(spark, sf):
    df = _line(spark, sf, "l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("q"))
    return df.groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("q"))


@register(
    "h06_constraint_reshape",
    "SELECT MKT, 'BOND' AS ASSET, round(min(c_acctbal), 2) AS MIN, round(max(c_acctbal), 2) AS MAX FROM (SELECT *, c_mktsegment AS MKT FROM customer) t GROUP BY 1 UNION ALL SELECT c_mktsegment, 'EQUITY', round(min(c_acctbal) / 2, 3), round(max(c_acctbal) / 2, 3) FROM customer GROUP BY 1",
)
def h06_constraint_reshape(spark, sf):
    c = fx.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("MKT")).agg(F.min("c_acctbal").alias("LO"), F.max("c_acctbal").alias("HI"))
    wide = c.select("MKT", F.round("LO", 2).alias("BOND_MIN"), F.round("HI", 2).alias("BOND_MAX"), F.round(F.col("LO") / 2, 3).alias("EQUITY_MIN"), F.round(F.col("HI") / 2, 3).alias("EQUITY_MAX"))
    long = agg.split_name(wide.unpivot(["MKT"], ["BOND_MIN", "BOND_MAX", "EQUITY_MIN", "EQUITY_MAX"], "NAME", "V"), "NAME", "ASSET", "SIDE")
    return agg.mean_pivot(long, ["MKT", "ASSET"], "SIDE", "V", ["MIN", "MAX"], how="max")


@register("l02_class_path_labels", "SELECT TICKER_SYMBOL, LEVEL_1 AS PATH_1, concat_ws('-', LEVEL_1, LEVEL_2) AS PATH_2, concat_ws('-', LEVEL_1, LEVEL_2, LEVEL_3) AS PATH_3 FROM fx_fund_type")
def l02_class_path_labels(spark, sf):
    levels = ["LEVEL_1", "LEVEL_2", "LEVEL_3"]
    return fx.view(spark, sf, "fx_fund_type").select("TICKER_SYMBOL", *[F.concat_ws("-", *levels[: n + 1]).alias(f"PATH_{n + 1}") for n in range(3)])


@register("l36_index_description", "SELECT event_type AS CODE, split_part(concat(event_type, '.IDX'), '.', -1) AS SUFFIX, min(CAST(ts AS DATE)) AS BASE_DATE, max(CAST(ts AS DATE)) AS LAST_DATE FROM events GROUP BY 1")
def l36_index_description(spark, sf):
    t = fx.view(spark, sf, "fx_ticks")
    return t.groupBy(F.col("code").alias("CODE"), F.substring_index(F.concat("code", F.lit(".IDX")), ".", -1).alias("SUFFIX")).agg(
        F.min(F.to_date("trade_time")).alias("BASE_DATE"), F.max(F.to_date("trade_time")).alias("LAST_DATE")
    )
