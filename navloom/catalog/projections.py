"""Projections, filters, predicates and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.functions import exprs as e
from navloom.operators.joins import latest_known, valid_on
from navloom.plans.performance import typed_panel
from navloom.sources import fixtures as fx
from navloom.sources.readers import lookup, read_table, stored_predicates

FAR = "DATE '2099-12-31'"


@register("b01_typed_projection", "SELECT TICKER_SYMBOL, END_DATE, round(ADJ_NAV, 6) AS NAV FROM fx_nav")
def b01_typed_projection(spark, sf):
    return rounded(typed_panel(fx.view(spark, sf, "fx_nav"), nav="ADJ_NAV"))


@register("b02_strict_coverage", "SELECT TICKER_SYMBOL, END_DATE, round(ADJ_NAV, 6) AS NAV FROM (SELECT *, min(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS A, max(END_DATE) OVER (PARTITION BY TICKER_SYMBOL) AS B FROM fx_nav WHERE END_DATE BETWEEN DATE '2024-01-02' AND DATE '2024-01-29') t WHERE A = DATE '2024-01-02' AND B = DATE '2024-01-29'")
def b02_strict_coverage(spark, sf):
    from navloom.operators.ranks import Window

    start, end = F.to_date(F.lit("2024-01-02")), F.to_date(F.lit("2024-01-29"))
    w = Window.partitionBy("TICKER_SYMBOL")
    df = typed_panel(fx.view(spark, sf, "fx_nav"), nav="ADJ_NAV").where(F.col("END_DATE").between(start, end))
    kept = df.withColumns({"A": F.min("END_DATE").over(w), "B": F.max("END_DATE").over(w)}).where((F.col("A") == start) & (F.col("B") == end))
    return rounded(kept.drop("A", "B"))


@register("b03_optional_filters", "SELECT TICKER_SYMBOL, END_DATE, round(ADJ_NAV, 6) AS ADJ_NAV FROM fx_nav WHERE TICKER_SYMBOL IN ('1', '2', '3') AND END_DATE BETWEEN DATE '2024-01-05' AND DATE '2099-12-31'")
def b03_optional_filters(spark, sf):
    return rounded(read_table(fx.view(spark, sf, "fx_nav"), keys={"TICKER_SYMBOL": ["1", "2", "3"]}, date="END_DATE", start="2024-01-05"))


@register("b04_validity_interval", f"SELECT TICKER_SYMBOL, INDUSTRY_NAME FROM fx_membership WHERE ENTRY_DT <= DATE '1999-01-01' AND DATE '1999-01-01' < coalesce(REMOVE_DT, {FAR})")
def b04_validity_interval(spark, sf):
    return valid_on(fx.view(spark, sf, "fx_membership"), F.to_date(F.lit("1999-01-01")), "ENTRY_DT", "REMOVE_DT", closed=False).select("TICKER_SYMBOL", "INDUSTRY_NAME")


@register("b05_point_in_time_snapshot", "SELECT * FROM fx_snapshot WHERE PUBLISH_DATE <= DATE '1998-07-15' AND REPORT_DATE = (SELECT max(REPORT_DATE) FROM fx_snapshot WHERE PUBLISH_DATE <= DATE '1998-07-15')")
def b05_point_in_time_snapshot(spark, sf):
    return latest_known(fx.view(spark, sf, "fx_snapshot"), F.to_date(F.lit("1998-07-15")))


@register("b05_point_in_time_per_key", "SELECT s.* FROM fx_snapshot s JOIN (SELECT FUND_ID, max(REPORT_DATE) AS REPORT_DATE FROM fx_snapshot WHERE PUBLISH_DATE <= DATE '1998-07-15' GROUP BY 1) m USING (FUND_ID, REPORT_DATE)")
def b05_point_in_time_per_key(spark, sf):
    return latest_known(fx.view(spark, sf, "fx_snapshot"), F.to_date(F.lit("1998-07-15")), keys=["FUND_ID"])


PREDICATES = {"big": 'ACCTBAL > 5000', "asia": 'LEVEL_1 == "ASIA"', "mixed": 'LEVEL_1 != "ASIA" and ACCTBAL < 1000'}


@register("b06_stored_predicates", " UNION ALL ".join(f"SELECT TICKER_SYMBOL, '{n}' AS PORTFOLIO_NAME FROM fx_fund_type WHERE " + p.replace("==", "=").replace('"', "'") for n, p in PREDICATES.items()))
def b06_stored_predicates(spark, sf):
    return stored_predicates(fx.view(spark, sf, "fx_fund_type"), PREDICATES).select("TICKER_SYMBOL", "PORTFOLIO_NAME")


# fixed values: equity-share bands
BAND_EDGES = [5, 10, 20, 30, 45, 65]
BAND_LABELS = ["00-05", "05-10", "10-20", "20-30", "30-45", "45-65", "65-100"]


@register("b07_case_bucketing", "SELECT l_orderkey, l_linenumber, CASE " + " ".join(f"WHEN l_quantity < {x} THEN '{b}'" for x, b in zip(BAND_EDGES, BAND_LABELS)) + " ELSE '65-100' END AS BAND FROM lineitem")
def b07_case_bucketing(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", e.bucket_label(F.col("l_quantity"), BAND_EDGES, BAND_LABELS).alias("BAND"))


@register("b08_text_pattern_flags", "SELECT p_partkey, CASE WHEN p_name LIKE '%small%' THEN 1 ELSE 0 END AS IS_SMALL, CASE WHEN regexp_matches(p_name, '(red|blue)') THEN 1 ELSE 0 END AS IS_COLOUR, CASE WHEN regexp_matches(p_name, 'gear$') THEN 'GEAR' WHEN p_name LIKE '%ring%' THEN 'RING' END AS KIND FROM part")
def b08_text_pattern_flags(spark, sf):
    n = F.col("p_name")
    return fx.table(spark, sf, "part").select(
        "p_partkey", F.when(n.contains("small"), 1).otherwise(0).alias("IS_SMALL"), F.when(n.rlike("(red|blue)"), 1).otherwise(0).alias("IS_COLOUR"), F.when(n.rlike("gear$"), "GEAR").when(n.contains("ring"), "RING").alias("KIND")
    )


_RATIO = {"TAX_RATIO": "l_tax", "DISC_RATIO": "l_discount", "PRICE_RATIO": "l_extendedprice"}


@register("b09_null_default_ratios", "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round(coalesce(CASE WHEN l_returnflag <> 'R' THEN {c} END, 0) / l_quantity * 100, 6) AS {o}" for o, c in _RATIO.items()) + " FROM lineitem")
def b09_null_default_ratios(spark, sf):
    df = fx.table(spark, sf, "lineitem")
    known = {o: F.when(F.col("l_returnflag") != "R", F.col(c)) for o, c in _RATIO.items()}
    return df.select("l_orderkey", "l_linenumber", *[F.round(e.null_ratio_pct(x, F.col("l_quantity")), 6).alias(o) for o, x in known.items()])


@register("b10_exposure_ratios", "SELECT l_orderkey, l_linenumber, round(l_discount + 0.5 * l_tax, 6) AS RISK, round(l_discount / (l_tax + 0.0001), 6) AS EQUITY_TO_CB FROM lineitem")
def b10_exposure_ratios(spark, sf):
    eq, cb = F.col("l_discount"), F.col("l_tax")
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(eq + 0.5 * cb, 6).alias("RISK"), F.round(eq / (cb + 0.0001), 6).alias("EQUITY_TO_CB"))


BOND_VIEW = {"fx_bondmix": "SELECT FUND_ID, REPORT_DATE, " + ", ".join(f"sum(CASE WHEN SECTOR = '{s}' THEN CAST(round(MARKET_VALUE * 100) AS BIGINT) ELSE 0 END)::DOUBLE / sum(CAST(round(MARKET_VALUE * 100) AS BIGINT))::DOUBLE * 100 AS {s}" for s in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " FROM fx_holdings GROUP BY 1, 2"}


@register(
    "b11_bond_split",
    "SELECT FUND_ID, REPORT_DATE, round(I, 6) + 0.0 AS INTEREST_BOND, round(B - STANDARD - I, 5) + 0.0 AS CREDIT_BOND, round(I / (B - STANDARD + 0.0001), 4) + 0.0 AS INTEREST_RATIO FROM (SELECT *, ECONOMY + LARGE + MEDIUM + PROMO AS I, ECONOMY + LARGE + MEDIUM + PROMO + SMALL + STANDARD AS B FROM fx_bondmix) t",
    BOND_VIEW,
)
def b11_bond_split(spark, sf):
    from navloom.plans.labels import bond_split

    mv = F.round(F.col("MARKET_VALUE") * 100).cast("bigint")
    sectors = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    mix = fx.view(spark, sf, "fx_holdings").groupBy("FUND_ID", "REPORT_DATE").agg(*[(F.sum(F.when(F.col("SECTOR") == s, mv).otherwise(0)).cast("double") / F.sum(mv).cast("double") * 100).alias(s) for s in sectors])
    mix = mix.withColumn("BOND", reduce(lambda a, b: a + b, [F.col(s) for s in sectors]))
    out = bond_split(mix, ["ECONOMY", "LARGE", "MEDIUM", "PROMO"], "BOND", "STANDARD")
    return out.select("FUND_ID", "REPORT_DATE", (F.round("INTEREST_BOND", 6) + 0.0).alias("INTEREST_BOND"), (F.round("CREDIT_BOND", 5) + 0.0).alias("CREDIT_BOND"), (F.round("INTEREST_RATIO", 4) + 0.0).alias("INTEREST_RATIO"))


FLAG_NAMES = {"A": "accepted", "N": "none", "R": "returned"}


@register("b12_value_map", "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' ELSE 'returned' END AS FLAG, CASE l_linestatus WHEN 'F' THEN 'final' ELSE l_linestatus END AS STATUS FROM lineitem")
def b12_value_map(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", e.map_values(F.col("l_returnflag"), FLAG_NAMES, strict=True).alias("FLAG"), e.map_values(F.col("l_linestatus"), {"F": "final"}).alias("STATUS"))


@register("b13_overflow_clip", "SELECT o_orderkey, CASE WHEN abs(o_totalprice * o_custkey) <= 1e8 THEN round(o_totalprice * o_custkey, 2) END AS V FROM orders")
def b13_overflow_clip(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", F.round(e.clip_overflow(F.col("o_totalprice") * F.col("o_custkey")), 2).alias("V"))


@register("b14_key_lookup", "SELECT s.FUND_ID, i.MANAGEMENT_COMPANY_NAME, i.ESTABLISH_DATE, s.NET_ASSET FROM fx_snapshot s LEFT JOIN fx_fund_info i ON s.FUND_ID = i.TICKER_SYMBOL WHERE s.REPORT_DATE = (SELECT max(REPORT_DATE) FROM fx_snapshot)")
def b14_key_lookup(spark, sf):
    snap = fx.view(spark, sf, "fx_snapshot")
    last = snap.join(F.broadcast(snap.agg(F.max("REPORT_DATE").alias("REPORT_DATE"))), "REPORT_DATE", "left_semi")
    return lookup(last.select("FUND_ID", "NET_ASSET"), fx.view(spark, sf, "fx_fund_info"), {"FUND_ID": "TICKER_SYMBOL"}, ["MANAGEMENT_COMPANY_NAME", "ESTABLISH_DATE"])


@register("b15_complete_cases", "SELECT FUND_ID, REPORT_DATE, NET_ASSET, MOVE FROM (SELECT *, round(NET_ASSET - lag(NET_ASSET) OVER (PARTITION BY FUND_ID ORDER BY REPORT_DATE), 2) + 0.0 AS MOVE FROM fx_snapshot) t WHERE MOVE IS NOT NULL")
def b15_complete_cases(spark, sf):
    from navloom.functions.series import by, difference
    from navloom.operators.aggregates import non_null_columns

    df = fx.view(spark, sf, "fx_snapshot").withColumn("MOVE", F.round(difference(F.col("NET_ASSET"), by(["FUND_ID"], "REPORT_DATE")), 2) + 0.0)
    return non_null_columns(df.withColumn("EMPTY", F.lit(None).cast("double"))).dropna(subset=["MOVE"]).select("FUND_ID", "REPORT_DATE", "NET_ASSET", "MOVE")


@register("b16_active_on_date", f"SELECT TICKER_SYMBOL FROM fx_fund_info WHERE ESTABLISH_DATE <= DATE '1999-06-30' AND DATE '1999-06-30' <= coalesce(EXPIRE_DATE, {FAR}) AND IS_MAIN = 1")
def b16_active_on_date(spark, sf):
    return valid_on(fx.view(spark, sf, "fx_fund_info"), F.to_date(F.lit("1999-06-30")), "ESTABLISH_DATE", "EXPIRE_DATE").where("IS_MAIN = 1").select("TICKER_SYMBOL")


@register("b17_table_reader", "SELECT REPORT_DATE, FUND_ID, NET_ASSET FROM fx_snapshot WHERE FUND_ID IN ('F1', 'F2') AND REPORT_DATE BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' ORDER BY REPORT_DATE, FUND_ID")
def b17_table_reader(spark, sf):
    return read_table(fx.view(spark, sf, "fx_snapshot"), columns=["REPORT_DATE", "FUND_ID", "NET_ASSET"], keys={"FUND_ID": ["F1", "F2"]}, date="REPORT_DATE", start="1996-01-01", end="1998-12-31", order=["REPORT_DATE", "FUND_ID"])


@register("b18_number_format", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN '' ELSE printf('%.4f', l_extendedprice / 3) END AS RATIO, concat(printf('%.2f', round(l_tax * 100, 2)), '%') AS TAX FROM lineitem")
def b18_number_format(spark, sf):
    ratio = F.when(F.col("l_discount") != 0, F.col("l_extendedprice") / 3)
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", e.fixed_text(ratio).alias("RATIO"), e.percent_text(F.col("l_tax") * 100).alias("TAX"))


# --- scalar functions ---


@register("i01_null_functions", "SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_tax > 0.02 THEN l_tax END, 0) AS T, CASE WHEN l_tax > 0.02 THEN 0 ELSE 1 END AS MISSING FROM lineitem")
def i01_null_functions(spark, sf):
    df = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("T"))
    return df.withColumn("MISSING", F.when(F.col("T").isNull(), 1).otherwise(0)).fillna({"T": 0.0})


@register("i02_math_functions", "SELECT o_orderkey, round(ln(o_totalprice), 6) AS L, round(exp(o_totalprice / 1000000), 6) AS E, abs(-o_totalprice) AS A, CAST(ceil(o_totalprice) AS BIGINT) AS C, round(sqrt(o_totalprice), 6) AS S, round(pow(o_totalprice / 1000, 1.5), 4) AS P, CAST(sign(o_totalprice - 150000) AS DOUBLE) AS G, round(ln(nullif(greatest(o_totalprice - 150000, 0), 0)), 6) AS LZ FROM orders")
def i02_math_functions(spark, sf):
    x = F.col("o_totalprice")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", F.round(F.ln(x), 6).alias("L"), F.round(F.exp(x / 1000000), 6).alias("E"), F.abs(-x).alias("A"), F.ceil(x).alias("C"), F.round(F.sqrt(x), 6).alias("S"),
        F.round(F.pow(x / 1000, 1.5), 4).alias("P"), F.signum(x - 150000).alias("G"), F.round(F.ln(F.greatest(x - 150000, F.lit(0.0))), 6).alias("LZ"),
    )


@register("i03_conditional", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'other' END AS K FROM orders")
def i03_conditional(spark, sf):
    p = F.col("o_totalprice")
    k = F.when(p > 300000, "high").when((p > 100000) & (F.col("o_orderstatus") == "F"), "done").when(F.col("o_orderpriority").like("1%"), "urgent").otherwise("other")
    return fx.table(spark, sf, "orders").select("o_orderkey", k.alias("K"))


@register(
    "i04_string_functions",
    """SELECT c_custkey, concat(c_name, '.', c_mktsegment) AS C, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS P, upper(c_name) AS U, lower(c_mktsegment) AS L, left(c_name, 4) AS F4, split_part(c_name, '#', -1) AS TAIL,
 CAST(length(c_name) AS INTEGER) AS N, split_part(c_name, '#', 1) AS HEAD, replace(c_name, '#', '-') AS R, contains(c_name, '0001') AS HAS, concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) AS CAP FROM customer""",
)
def i04_string_functions(spark, sf):
    n, m = F.col("c_name"), F.col("c_mktsegment")
    return fx.table(spark, sf, "customer").select(
        "c_custkey", F.concat(n, F.lit("."), m).alias("C"), e.pad_code(F.col("c_custkey")).alias("P"), F.upper(n).alias("U"), F.lower(m).alias("L"), F.left(n, F.lit(4)).alias("F4"), F.substring_index(n, "#", -1).alias("TAIL"),
        F.length(n).alias("N"), F.split(n, "#")[0].alias("HEAD"), F.replace(n, F.lit("#"), F.lit("-")).alias("R"), n.contains("0001").alias("HAS"), F.initcap(m).alias("CAP"),
    )


@register(
    "i05_date_functions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS S, CAST(o_orderdate AS DATE) AS D, year(o_orderdate)::INTEGER AS Y, month(o_orderdate)::INTEGER AS M, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS AGE,
 CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS NEXT_M, CAST(CAST(o_orderdate AS DATE) - INTERVAL 7 DAY AS DATE) AS WEEK_AGO, last_day(CAST(o_orderdate AS DATE)) AS LAST_D FROM orders""",
)
def i05_date_functions(spark, sf):
    d = F.to_date("o_orderdate")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("S"), d.alias("D"), F.year("o_orderdate").alias("Y"), F.month("o_orderdate").alias("M"), F.datediff(F.to_date(F.lit("2002-01-01")), d).alias("AGE"),
        F.add_months(d, 1).alias("NEXT_M"), F.date_sub(d, 7).alias("WEEK_AGO"), F.last_day(d).alias("LAST_D"),
    )


@register("i06_cast_by_type", "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 1) AS s_acctbal FROM supplier")
def i06_cast_by_type(spark, sf):
    return e.round_floats(fx.table(spark, sf, "supplier"), 1)


@register("i06_dates_as_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS o_orderdate FROM orders")
def i06_dates_as_text(spark, sf):
    return e.cast_dates(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "yyyyMMdd")


@register("i07_predicates", "SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000 AND o_orderstatus IN ('F', 'O')")
def i07_predicates(spark, sf):
    return fx.table(spark, sf, "orders").where(F.col("o_totalprice").between(100000, 200000) & F.col("o_orderstatus").isin("F", "O")).select("o_orderkey")


@register("i08_list_functions", "SELECT p_partkey, split_part(p_name, ' ', 1) AS A, split_part(p_name, ' ', -1) AS B, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS N FROM part")
def i08_list_functions(spark, sf):
    words = F.split("p_name", " ")
    return fx.table(spark, sf, "part").select("p_partkey", words[0].alias("A"), F.element_at(words, -1).alias("B"), F.size(words).alias("N"))
