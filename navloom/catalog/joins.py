"""Joins and calendar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.operators import calendars as cal_ops
from navloom.operators import joins as j
from navloom.sources import fixtures as fx

FAR = "DATE '2099-12-31'"


@register("c01_inner_star_join", "SELECT s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def c01_inner_star_join(spark, sf):
    s, n, r = (fx.table(spark, sf, t) for t in ("supplier", "nation", "region"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_name", "n_name", "r_name")


@register("c02_left_join_default", "SELECT c_custkey, coalesce(N, 0) AS N FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS N FROM orders GROUP BY 1) o ON c_custkey = o_custkey")
def c02_left_join_default(spark, sf):
    n = fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("N"))
    return fx.table(spark, sf, "customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("N", F.lit(0)).alias("N"))


_Y = "SELECT PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT FROM fx_weights WHERE TRADE_DT = DATE '{}-01-01' AND length(PORTFOLIO_NAME) % 2 = {}"


@register("c04_full_outer_default", f"SELECT PORTFOLIO_NAME, TICKER_SYMBOL, round(coalesce(o.WEIGHT, 0), 6) AS OLD_W, round(coalesce(n.WEIGHT, 0), 6) AS NEW_W FROM (SELECT * FROM fx_weights WHERE TRADE_DT = DATE '1997-01-01') o FULL JOIN (SELECT * FROM fx_weights WHERE TRADE_DT = DATE '1998-01-01') n USING (PORTFOLIO_NAME, TICKER_SYMBOL)")
def c04_full_outer_default(spark, sf):
    w = fx.view(spark, sf, "fx_weights")
    keys = ["PORTFOLIO_NAME", "TICKER_SYMBOL"]
    old = w.where("TRADE_DT = DATE '1997-01-01'").select(*keys, F.col("WEIGHT").alias("OLD_W"))
    new = w.where("TRADE_DT = DATE '1998-01-01'").select(*keys, F.col("WEIGHT").alias("NEW_W"))
    return rounded(j.full_outer_fill(old, new, keys, {"OLD_W": 0.0, "NEW_W": 0.0}))


@register("c05_semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def c05_semi_join(spark, sf):
    big = fx.table(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return fx.table(spark, sf, "customer").select("c_custkey").join(big, "c_custkey", "left_semi")


@register("c06_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def c06_anti_join(spark, sf):
    big = fx.table(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return fx.table(spark, sf, "customer").select("c_custkey").join(big, "c_custkey", "left_anti")


@register("c07_flag_date_range", "SELECT TRADE_DT, (SELECT min(TRADE_DT) FROM fx_calendar f WHERE f.IF_MONTH_END = 1 AND f.TRADE_DT >= c.TRADE_DT) AS PERIOD_END FROM fx_calendar c")
def c07_flag_date_range(spark, sf):
    from navloom.operators.ranks import Window

    after = Window.partitionBy(F.lit(0)).orderBy("TRADE_DT").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cal = fx.calendar(spark, sf)
    return cal.select("TRADE_DT", F.first(F.when(F.col("IF_MONTH_END") == 1, F.col("TRADE_DT")), ignorenulls=True).over(after).alias("PERIOD_END"))


@register("c08_band_lookup", "SELECT o_orderkey, b.LEVEL FROM orders LEFT JOIN (VALUES (0.0, 49999.99, 'R1'), (50000.0, 149999.99, 'R2'), (150000.0, 299999.99, 'R3')) b(MN, MX, LEVEL) ON o_totalprice BETWEEN b.MN AND b.MX")
def c08_band_lookup(spark, sf):
    bands = spark.createDataFrame([(0.0, 49999.99, "R1"), (50000.0, 149999.99, "R2"), (150000.0, 299999.99, "R3")], "MIN double, MAX double, LEVEL string")
    return j.band_join(fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), bands, "o_totalprice").select("o_orderkey", "LEVEL")


@register("c09_interval_validity_join", f"SELECT h.REPORT_DATE, h.FUND_ID, h.HOLDING_TICKER_SYMBOL, m.INDUSTRY_NAME AS INDUSTRY FROM fx_holdings h JOIN fx_membership m ON h.HOLDING_TICKER_SYMBOL = m.TICKER_SYMBOL AND m.ENTRY_DT <= h.REPORT_DATE AND h.REPORT_DATE < coalesce(m.REMOVE_DT, {FAR})")
def c09_interval_validity_join(spark, sf):
    h = fx.view(spark, sf, "fx_holdings").select("REPORT_DATE", "FUND_ID", F.col("HOLDING_TICKER_SYMBOL").alias("TICKER_SYMBOL"))
    m = fx.view(spark, sf, "fx_membership").withColumnRenamed("INDUSTRY_NAME", "INDUSTRY")
    out = j.interval_join(h, m, "TICKER_SYMBOL", "REPORT_DATE", "ENTRY_DT", "REMOVE_DT")
    return out.select("REPORT_DATE", "FUND_ID", F.col("TICKER_SYMBOL").alias("HOLDING_TICKER_SYMBOL"), "INDUSTRY")


@register("c10_as_of_join", "SELECT n.TICKER_SYMBOL, n.END_DATE, a.EX_DATE, a.FACTOR FROM fx_nav_long n ASOF LEFT JOIN fx_adjust a ON n.TICKER_SYMBOL = a.TICKER_SYMBOL AND n.END_DATE >= a.EX_DATE")
def c10_as_of_join(spark, sf):
    out = j.as_of(fx.view(spark, sf, "fx_nav_long"), fx.view(spark, sf, "fx_adjust"), "TICKER_SYMBOL", "END_DATE", "EX_DATE", ["FACTOR"])
    return out.select("TICKER_SYMBOL", "END_DATE", "EX_DATE", "FACTOR")


@register("c11_previous_period_self_join", "SELECT a.TICKER_SYMBOL, a.END_DATE, round((a.ADJ_NAV / c.ADJ_NAV - 1) * 100, 6) + 0.0 AS RETURN_RATE FROM fx_nav_long a JOIN fx_cal b ON b.TRADE_DT = a.END_DATE JOIN fx_nav_long c ON c.END_DATE = b.PREV_TRADE_DATE AND c.TICKER_SYMBOL = a.TICKER_SYMBOL")
@register("l22_return_to_previous_day", "SELECT a.TICKER_SYMBOL, a.END_DATE, round((a.ADJ_NAV / c.ADJ_NAV - 1) * 100, 6) + 0.0 AS RETURN_RATE FROM fx_nav_long a JOIN fx_cal b ON b.TRADE_DT = a.END_DATE JOIN fx_nav_long c ON c.END_DATE = b.PREV_TRADE_DATE AND c.TICKER_SYMBOL = a.TICKER_SYMBOL")
def c11_previous_period_self_join(spark, sf):
    from navloom.plans.alpha import return_to_previous_day

    return rounded(return_to_previous_day(fx.view(spark, sf, "fx_nav_long"), fx.calendar(spark, sf), "ADJ_NAV"))


@register("c12_one_row_aggregate_join", "SELECT s_suppkey, round(s_acctbal - LO, 2) AS ABOVE_MIN FROM supplier, (SELECT min(s_acctbal) AS LO FROM supplier) m")
def c12_one_row_aggregate_join(spark, sf):
    s = fx.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    low = F.broadcast(s.agg(F.min("s_acctbal").alias("LO")))  # one row
    return s.join(low).select("s_suppkey", F.round(F.col("s_acctbal") - F.col("LO"), 2).alias("ABOVE_MIN"))


_CODES = "SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS CODE, r_name AS NAME FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"


@register("c13_prefix_key_join", f"SELECT n_name, p.NAME AS LEVEL1_NAME FROM (SELECT n_name, concat(lpad(CAST(n_regionkey AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS CODE FROM nation) n LEFT JOIN ({_CODES}) p ON left(n.CODE, 2) = p.CODE")
def c13_prefix_key_join(spark, sf):
    from navloom.functions.exprs import pad_code

    n = fx.table(spark, sf, "nation").select("n_name", F.concat(pad_code(F.col("n_regionkey"), 2), pad_code(F.col("n_nationkey"), 2)).alias("CODE"))
    parents = fx.table(spark, sf, "region").select(pad_code(F.col("r_regionkey"), 2).alias("CODE"), F.col("r_name").alias("NAME"))
    return j.prefix_join(n, "CODE", parents, 1).select("n_name", "LEVEL1_NAME")


@register("c14_code_dictionary_joins", "SELECT l_orderkey, l_linenumber, concat('flag ', l_returnflag) AS l_returnflag_TEXT, concat('status ', l_linestatus) AS l_linestatus_TEXT FROM lineitem")
def c14_code_dictionary_joins(spark, sf):
    line = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    flags = line.select(F.lit("F").alias("CATEGORY"), F.col("l_returnflag").alias("CODE")).distinct()
    states = line.select(F.lit("S").alias("CATEGORY"), F.col("l_linestatus").alias("CODE")).distinct()
    codes = flags.withColumn("TEXT", F.concat(F.lit("flag "), "CODE")).union(states.withColumn("TEXT", F.concat(F.lit("status "), "CODE")))
    return j.decode(line, codes, {"l_returnflag": "F", "l_linestatus": "S"}).drop("l_returnflag", "l_linestatus")


@register("c15_natural_outer_merge", "SELECT coalesce(a.NATION, b.NATION, c.NATION) AS NATION, N_CUST, N_SUPP, R FROM (SELECT c_nationkey AS NATION, count(*) AS N_CUST FROM customer GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS NATION, count(*) AS N_SUPP FROM supplier GROUP BY 1) b ON a.NATION = b.NATION FULL JOIN (SELECT n_nationkey AS NATION, n_regionkey AS R FROM nation) c ON coalesce(a.NATION, b.NATION) = c.NATION")
def c15_natural_outer_merge(spark, sf):
    a = fx.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("NATION")).agg(F.count(F.lit(1)).alias("N_CUST"))
    b = fx.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("NATION")).agg(F.count(F.lit(1)).alias("N_SUPP"))
    c = fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("NATION"), F.col("n_regionkey").alias("R"))
    return j.natural_outer([a, b, c])


@register("c16_trade_date_alignment", "SELECT DISTINCT h.REPORT_DATE, CASE WHEN c.IF_TRADING_DAY = 1 THEN c.TRADE_DT ELSE c.PREV_TRADE_DATE END AS TRADE_DT FROM fx_snapshot h JOIN (SELECT TRADE_DT, IF_TRADING_DAY, PREV_TRADE_DATE FROM fx_cal) c ON h.REPORT_DATE = c.TRADE_DT")
def c16_trade_date_alignment(spark, sf):
    reports = fx.view(spark, sf, "fx_snapshot").select("REPORT_DATE").distinct()
    return j.align_to_trading_day(reports, fx.calendar(spark, sf), "REPORT_DATE")


@register(
    "c17_related_classes",
    "SELECT DISTINCT concat('F', a.s_suppkey) AS TICKER_SYMBOL, concat('F', b.s_suppkey) AS RELATED FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey // 10 = b.s_suppkey // 10 UNION SELECT concat('F', s_suppkey), concat('F', s_suppkey // 7) FROM supplier WHERE s_suppkey % 3 = 0",
)
def c17_related_classes(spark, sf):
    s = fx.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.floor(F.col("s_suppkey") / 10).alias("G"))
    fund = F.concat(F.lit("F"), F.col("s_suppkey").cast("string"))
    a, b = s.select(fund.alias("TICKER_SYMBOL"), "s_nationkey", "G"), s.select(fund.alias("RELATED"), "s_nationkey", "G")
    same = a.join(b, ["s_nationkey", "G"])
    linked = s.where("s_suppkey % 3 = 0").select(fund.alias("TICKER_SYMBOL"), F.concat(F.lit("F"), F.floor(F.col("s_suppkey") / 7).cast("string")).alias("RELATED"))
    return j.related_classes([same.where("TICKER_SYMBOL != RELATED"), linked, same.where("TICKER_SYMBOL = RELATED")], a)


# --- calendar ---

_CALS = ["PREV_TRADE_DATE", "WEEK_END_DATE", "MONTH_END_DATE", "QUARTER_END_DATE", "YEAR_END_DATE"]


@register("j01_previous_flag_dates", f"SELECT TRADE_DT, IF_TRADING_DAY, IF_WEEK_END, IF_MONTH_END, IF_QUARTER_END, IF_YEAR_END, {', '.join(_CALS)} FROM fx_cal")
def j01_previous_flag_dates(spark, sf):
    return cal_ops.add_previous_flag_dates(fx.view(spark, sf, "fx_calendar"))


STEP_VIEWS = {
    "fx_snap": "SELECT TRADE_DT AS DAY, CASE WHEN IF_TRADING_DAY = 1 THEN TRADE_DT ELSE PREV_TRADE_DATE END AS SNAP FROM fx_cal",
    "fx_all_steps": "SELECT * FROM (VALUES "
    + ", ".join([f"('近1周', 0, 7)"] + [f"('近{n}月', {n}, 0)" for n in (1, 2, 3, 6, 9)] + [f"('近{n}年', {12 * n}, 0)" for n in range(1, 11)])
    + ") v(DATE_NAME, M, D)",
    "fx_lookback": "SELECT e.TRADE_DT AS END_DATE, s.DATE_NAME, p.SNAP AS START_DATE FROM fx_trading e, fx_all_steps s JOIN fx_snap p ON p.DAY = CAST(e.TRADE_DT - to_months(s.M) - to_days(s.D) AS DATE) WHERE p.SNAP IS NOT NULL",
}


@register("j02_lookback_table", "SELECT END_DATE, DATE_NAME, START_DATE FROM fx_lookback", STEP_VIEWS)
def j02_lookback_table(spark, sf):
    return cal_ops.lookback_table(fx.calendar(spark, sf))


@register(
    "j02_lookback_wide",
    "SELECT t.TRADE_DT AS END_DATE, " + ", ".join(f"max(START_DATE) FILTER (WHERE DATE_NAME = '近{n}{cn}') AS PREV_{n}_{u}" for u, cn, ns in (("WEEK", "周", [1]), ("MONTH", "月", [1, 2, 3, 6, 9]), ("YEAR", "年", range(1, 11))) for n in ns) + " FROM fx_trading t LEFT JOIN fx_lookback l ON t.TRADE_DT = l.END_DATE GROUP BY 1",
    STEP_VIEWS,
)
def j02_lookback_wide(spark, sf):
    return cal_ops.lookback_wide(fx.calendar(spark, sf))


_OFFSET = """SELECT c.TRADE_DT, t.TRADE_DT AS OFFSET_DT FROM (SELECT TRADE_DT, sum(IF_TRADING_DAY) OVER (ORDER BY TRADE_DT) AS U, IF_TRADING_DAY AS T FROM fx_calendar) c LEFT JOIN fx_trading t ON t.IDX = {}"""


@register("j03_offset_trading_days_back", _OFFSET.format("c.U - 20"))
def j03_offset_trading_days_back(spark, sf):
    return cal_ops.offset_trading_days(fx.calendar(spark, sf), 20)


@register("j03_offset_trading_days_forward", _OFFSET.format("c.U - c.T + 1 + 5"))
def j03_offset_trading_days_forward(spark, sf):
    return cal_ops.offset_trading_days(fx.calendar(spark, sf), -5)


@register("j04_offset_calendar_period", "SELECT TRADE_DT, CAST(TRADE_DT - INTERVAL 10 DAY AS DATE) AS D10, CAST(TRADE_DT - INTERVAL 14 DAY AS DATE) AS W2, CAST(TRADE_DT - INTERVAL 1 MONTH AS DATE) AS M1, CAST(TRADE_DT + INTERVAL 1 YEAR AS DATE) AS Y1 FROM fx_calendar")
def j04_offset_calendar_period(spark, sf):
    d = F.col("TRADE_DT")
    shift = cal_ops.shift_date
    return fx.calendar(spark, sf).select("TRADE_DT", shift(d, 10, "DAY").alias("D10"), shift(d, 2, "WEEK").alias("W2"), shift(d, 1, "MONTH").alias("M1"), shift(d, -1, "YEAR").alias("Y1"))


@register("j05_offset_period_snapped", "SELECT c.TRADE_DT, CAST(c.TRADE_DT - INTERVAL 3 MONTH AS DATE) AS TARGET, s.SNAP AS SNAPPED FROM fx_calendar c LEFT JOIN fx_snap s ON s.DAY = CAST(c.TRADE_DT - INTERVAL 3 MONTH AS DATE)", STEP_VIEWS)
def j05_offset_period_snapped(spark, sf):
    return cal_ops.offset_period(fx.calendar(spark, sf), 3, "MONTH")


@register("j06_recent_trading_day", "SELECT TRADE_DT, PREV_TRADE_DATE, IF_TRADING_DAY = 1 AS TRADES, IF_QUARTER_END = 1 AS QUARTER_END FROM fx_cal")
def j06_recent_trading_day(spark, sf):
    return fx.calendar(spark, sf).select("TRADE_DT", "PREV_TRADE_DATE", (F.col("IF_TRADING_DAY") == 1).alias("TRADES"), (F.col("IF_QUARTER_END") == 1).alias("QUARTER_END"))


@register("j07_last_period_end", "SELECT TRADE_DT, WEEK_END_DATE, MONTH_END_DATE, QUARTER_END_DATE, YEAR_END_DATE FROM fx_cal")
def j07_last_period_end(spark, sf):
    return fx.calendar(spark, sf).select("TRADE_DT", *_CALS[1:])


@register("j08_period_end_list", " UNION ALL ".join(f"SELECT '{p}' AS PERIOD, TRADE_DT FROM fx_calendar WHERE {f} = 1" for p, f in cal_ops.PERIOD_FLAG.items()))
def j08_period_end_list(spark, sf):
    cal = fx.calendar(spark, sf)
    from navloom.operators.aggregates import union_all

    return union_all([cal_ops.period_ends(cal, p).select(F.lit(p).alias("PERIOD"), "TRADE_DT") for p in cal_ops.PERIOD_FLAG])


_J10 = ", ".join(["('近1日', 0, 1)", "('近1周', 0, 7)"] + [f"('近{n}月', {n}, 0)" for n in (1, 2, 3, 6, 9)] + [f"('近{n}年', {12 * n}, 0)" for n in range(1, 6)])


@register("j10_recent_windows", f"SELECT s.DATE_NAME, p.SNAP AS START_DATE, DATE '1999-06-30' AS END_DATE FROM (VALUES {_J10}) s(DATE_NAME, M, D) JOIN fx_snap p ON p.DAY = CAST(DATE '1999-06-30' - to_months(s.M) - to_days(s.D) AS DATE) WHERE p.SNAP >= DATE '1996-02-01'", STEP_VIEWS)
def j10_recent_windows(spark, sf):
    spec = {"DAY": [1], "WEEK": [1], "MONTH": [1, 2, 3, 6, 9], "YEAR": [1, 2, 3, 4, 5]}
    return cal_ops.recent_windows(fx.calendar(spark, sf), F.to_date(F.lit("1999-06-30")), F.to_date(F.lit("1996-02-01")), spec)


@register("j11_to_date_and_lookbacks", "SELECT TRADE_DT AS END_DATE, 'YTD' AS DATE_NAME, YEAR_END_DATE AS START_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1 AND YEAR_END_DATE IS NOT NULL UNION ALL SELECT TRADE_DT, 'QTD', QUARTER_END_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1 AND QUARTER_END_DATE IS NOT NULL UNION ALL SELECT TRADE_DT, 'MTD', MONTH_END_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1 AND MONTH_END_DATE IS NOT NULL UNION ALL SELECT TRADE_DT, 'WTD', WEEK_END_DATE FROM fx_cal WHERE IF_TRADING_DAY = 1 AND WEEK_END_DATE IS NOT NULL UNION ALL SELECT END_DATE, DATE_NAME, START_DATE FROM fx_lookback", STEP_VIEWS)
def j11_to_date_and_lookbacks(spark, sf):
    cal = fx.calendar(spark, sf)
    dates = cal_ops.to_date_windows(cal).where("DATE_NAME <> '近1日' AND START_DATE IS NOT NULL")
    return dates.unionByName(cal_ops.lookback_table(cal))


@register("j13_last_report_dates", "SELECT TRADE_DT, strftime(CAST(CAST(date_trunc('quarter', TRADE_DT) AS DATE) - INTERVAL 1 DAY AS DATE), '%Y%m%d') AS R1, strftime(CAST(CAST(date_trunc('quarter', TRADE_DT) AS DATE) - to_months(9) - INTERVAL 1 DAY AS DATE), '%Y%m%d') AS R4 FROM fx_calendar")
def j13_last_report_dates(spark, sf):
    dates = cal_ops.report_dates_before(F.col("TRADE_DT"), 4)
    return fx.view(spark, sf, "fx_calendar").select("TRADE_DT", F.date_format(dates[0], "yyyyMMdd").alias("R1"), F.date_format(dates[3], "yyyyMMdd").alias("R4"))


@register("j14_publish_estimate", "SELECT DISTINCT REPORT_DATE, CASE WHEN month(REPORT_DATE) IN (1, 7) THEN CAST(REPORT_DATE + INTERVAL 3 MONTH AS DATE) ELSE CAST(REPORT_DATE + INTERVAL 1 MONTH AS DATE) END AS PUBLISH_DATE FROM fx_snapshot")
def j14_publish_estimate(spark, sf):
    r = F.col("REPORT_DATE")
    return fx.view(spark, sf, "fx_snapshot").select("REPORT_DATE", cal_ops.publish_estimate(r, F.month(r).isin(1, 7)).alias("PUBLISH_DATE")).distinct()


@register(
    "j15_delayed_valuation",
    "SELECT n.TICKER_SYMBOL, c.TRADE_DT, n.END_DATE, round(n.NAV, 6) AS NAV FROM fx_fund_nav n JOIN fx_fund_type f USING (TICKER_SYMBOL) JOIN fx_cal c ON c.TRADE_DT = n.END_DATE WHERE f.LEVEL_1 <> 'ASIA' AND c.IF_TRADING_DAY = 1 "
    "UNION ALL SELECT n.TICKER_SYMBOL, c.TRADE_DT, n.END_DATE, round(n.NAV, 6) FROM fx_fund_nav n JOIN fx_fund_type f USING (TICKER_SYMBOL) JOIN fx_cal c ON c.PREV_TRADE_DATE = n.END_DATE WHERE f.LEVEL_1 = 'ASIA' AND c.IF_TRADING_DAY = 1",
)
def j15_delayed_valuation(spark, sf):
    from navloom.plans.portfolio import delayed_valuation

    cal = fx.calendar(spark, sf).where("IF_TRADING_DAY = 1")
    funds = fx.view(spark, sf, "fx_fund_type").select("TICKER_SYMBOL", (F.col("LEVEL_1") == "ASIA").alias("DELAYED"))
    out = delayed_valuation(fx.view(spark, sf, "fx_fund_nav"), funds, cal)
    return rounded(out.select("TICKER_SYMBOL", "TRADE_DT", "END_DATE", "NAV"))


@register("j16_report_date_list", "SELECT '近1月' AS DATE_NAME, SNAP AS START_DATE, DATE '1999-06-30' AS END_DATE FROM fx_snap WHERE DAY = DATE '1999-05-30' UNION ALL SELECT 'REPORT', DATE '1999-03-31', DATE '1999-06-30' UNION ALL SELECT 'FIXED', DATE '1998-12-31', DATE '1999-06-30'", STEP_VIEWS)
def j16_report_date_list(spark, sf):
    day = F.to_date(F.lit("1999-06-30"))
    base = cal_ops.recent_windows(fx.calendar(spark, sf), day, F.to_date(F.lit("1990-01-01")), {"MONTH": [1]})
    fixed = fx.calendar(spark, sf).where(F.col("TRADE_DT") == day).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("DATE_NAME"), s.alias("START_DATE")) for n, s in (("REPORT", cal_ops.report_dates_before(day, 1)[0]), ("FIXED", F.to_date(F.lit("1998-12-31"))))])), F.col("TRADE_DT").alias("END_DATE")
    )
    return base.unionByName(fixed)
