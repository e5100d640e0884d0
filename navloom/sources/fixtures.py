"""Logical tables derived from the provided parquet tables.

``VIEWS`` holds SQL that Spark and DuckDB both accept; ``{name}`` stands for a source table or an earlier view.  ``view``
builds the Spark side, ``with_views`` writes the same views in front of an oracle query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.operators.calendars import add_previous_flag_dates
from navloom.operators.joins import densify, spread
from navloom.session import pin_small

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_LAST_IN = "CASE WHEN IF_TRADING_DAY = 1 AND TRADE_DT = max(CASE WHEN IF_TRADING_DAY = 1 THEN TRADE_DT END) OVER (PARTITION BY date_trunc('{0}', TRADE_DT)) THEN 1 ELSE 0 END AS IF_{1}_END"

VIEWS = {
    "fx_days": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS TRADE_DT FROM {lineitem}",
    "fx_calendar": "SELECT TRADE_DT, IF_TRADING_DAY, "
    + ", ".join(_LAST_IN.format(p, p.upper()) for p in ("week", "month", "quarter", "year"))
    + """ FROM (SELECT TRADE_DT, CASE WHEN TRADE_DT < CAST(date_trunc('week', TRADE_DT) + INTERVAL 5 DAY AS DATE) THEN 1 ELSE 0 END AS IF_TRADING_DAY
      FROM {fx_days}) t""",
    "fx_nav": """SELECT CAST(user_id AS VARCHAR(20)) AS TICKER_SYMBOL, CAST(ts AS DATE) AS END_DATE,
       1 + CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100000 AS ADJ_NAV
FROM {events} GROUP BY 1, 2""",
    "fx_nav_long": """SELECT concat('S', CAST(l_suppkey % 10 AS VARCHAR(5))) AS TICKER_SYMBOL, CAST(l_shipdate AS DATE) AS END_DATE,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 1000 AS ADJ_NAV
FROM {lineitem} GROUP BY 1, 2""",
    "fx_nav_sparse": """SELECT TICKER_SYMBOL, END_DATE, 100 + 20 * X / (X + 200) AS NAV FROM (
  SELECT concat('F', CAST(l_suppkey AS VARCHAR(10))) AS TICKER_SYMBOL, CAST(l_shipdate AS DATE) AS END_DATE,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 1000 AS X
  FROM {lineitem} GROUP BY 1, 2) t""",
    "fx_type": """SELECT CAST(c_custkey AS VARCHAR(20)) AS TICKER_SYMBOL, c_mktsegment AS LEVEL_1, n_name AS LEVEL_2, r_name AS LEVEL_3
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_fund_type": """SELECT concat('F', CAST(s_suppkey AS VARCHAR(10))) AS TICKER_SYMBOL, r_name AS LEVEL_1, n_name AS LEVEL_2,
       concat(n_name, CASE WHEN s_acctbal >= 4500 THEN '/A' ELSE '/B' END) AS LEVEL_3, s_acctbal AS ACCTBAL
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_holdings": """SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS REPORT_DATE, concat('F', CAST(l_suppkey AS VARCHAR(10))) AS FUND_ID,
       CAST(l_partkey AS VARCHAR(20)) AS HOLDING_TICKER_SYMBOL, p_brand AS INDUSTRY_NAME, p_type AS SECTOR,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS MARKET_VALUE
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4, 5""",
    "fx_snapshot": """SELECT REPORT_DATE, CAST(REPORT_DATE + INTERVAL 1 MONTH AS DATE) AS PUBLISH_DATE, FUND_ID, round(sum(MARKET_VALUE), 2) AS NET_ASSET
FROM {fx_holdings} GROUP BY 1, 2, 3""",
    "fx_membership": """SELECT CAST(p_partkey AS VARCHAR(20)) AS TICKER_SYMBOL, p_brand AS INDUSTRY_NAME, DATE '1995-01-01' AS ENTRY_DT,
       CASE WHEN p_partkey % 3 = 0 THEN DATE '1999-01-01' END AS REMOVE_DT FROM {part}""",
    "fx_weights": """SELECT c_mktsegment AS PORTFOLIO_NAME, CAST(date_trunc('year', o_orderdate) AS DATE) AS TRADE_DT, concat('S', CAST(c_nationkey % 10 AS VARCHAR(5))) AS TICKER_SYMBOL,
       100 * CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY c_mktsegment, date_trunc('year', o_orderdate)) AS DOUBLE) AS WEIGHT
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
GROUP BY c_mktsegment, date_trunc('year', o_orderdate), c_nationkey % 10""",
    "fx_ticks": "SELECT event_type AS code, ts AS trade_time, event_id AS seq, value AS price, value AS amount FROM {events}",
    "fx_ledger": """SELECT event_id AS seq, CAST(ts AS DATE) AS date, CASE WHEN event_type = 'click' THEN 'Sell' ELSE 'Buy' END AS type, CAST(user_id AS VARCHAR(20)) AS ticker,
       CASE WHEN event_type = 'click' THEN CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) / 10 ELSE 1 + CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) END AS quantity, value AS price
FROM {events}""",
    "fx_valuation": """SELECT END_DATE AS TRADE_DT, TICKER_SYMBOL, 5 + ADJ_NAV / 1000 AS PE_TTM, 1 + ADJ_NAV / 5000 AS PB_LF, 1 + 100 / (50 + ADJ_NAV) AS DIVIDEND_YIELD
FROM {fx_nav_long}""",
    "fx_yield": """SELECT TRADE_DT AS END_DATE, 'GOV' AS CURVE, 2 + CAST(extract(day FROM TRADE_DT) AS DOUBLE) / 100 AS YIELD FROM {fx_days}
UNION ALL SELECT TRADE_DT, 'AAA', 3 + CAST((extract(day FROM TRADE_DT) * 7) % 31 AS DOUBLE) / 100 FROM {fx_days}""",
    "fx_adjust": """SELECT concat('S', CAST(s_suppkey % 10 AS VARCHAR(5))) AS TICKER_SYMBOL, CAST(DATE '1995-01-01' + s_suppkey * INTERVAL 20 DAY AS DATE) AS EX_DATE,
       1 + CAST(s_suppkey AS DOUBLE) / 100 AS FACTOR FROM {supplier}""",
    "fx_fund_info": """SELECT concat('F', CAST(s_suppkey AS VARCHAR(10))) AS TICKER_SYMBOL, s_name AS SEC_SHORT_NAME,
       CAST(DATE '1990-01-01' + (s_suppkey * 37 % 4000) * INTERVAL 1 DAY AS DATE) AS ESTABLISH_DATE,
       CASE WHEN s_suppkey % 7 = 0 THEN DATE '2000-01-01' END AS EXPIRE_DATE,
       CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS IS_MAIN,
       n_name AS MANAGEMENT_COMPANY_NAME, s_acctbal AS ACCTBAL
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
}

# What the Spark side computes with the library's own operators, written independently for the oracle.
ORACLE_VIEWS = {
    "fx_cal": "SELECT *, "
    + ", ".join(
        f"max(CASE WHEN {flag} = 1 THEN TRADE_DT END) OVER (ORDER BY TRADE_DT ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS {out}"
        for flag, out in (
            ("IF_TRADING_DAY", "PREV_TRADE_DATE"),
            ("IF_WEEK_END", "WEEK_END_DATE"),
            ("IF_MONTH_END", "MONTH_END_DATE"),
            ("IF_QUARTER_END", "QUARTER_END_DATE"),
            ("IF_YEAR_END", "YEAR_END_DATE"),
        )
    )
    + " FROM {fx_calendar}",
    "fx_trading": "SELECT TRADE_DT, row_number() OVER (ORDER BY TRADE_DT) AS IDX FROM {fx_calendar} WHERE IF_TRADING_DAY = 1",
    "fx_targets": "SELECT w.PORTFOLIO_NAME, d.T AS TRADE_DT, w.TICKER_SYMBOL, w.WEIGHT FROM {fx_weights} w JOIN (SELECT a.TRADE_DT, min(b.TRADE_DT) AS T FROM (SELECT DISTINCT TRADE_DT FROM {fx_weights}) a JOIN {fx_trading} b ON b.TRADE_DT >= a.TRADE_DT GROUP BY 1) d ON d.TRADE_DT = w.TRADE_DT",
    "fx_ret": "SELECT TICKER_SYMBOL, END_DATE AS TRADE_DT, (NAV / lag(NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1) * 100 AS RETURN_RATE FROM (SELECT n.TICKER_SYMBOL, n.END_DATE, 100 + 20 * n.ADJ_NAV / (n.ADJ_NAV + 200) AS NAV FROM {fx_nav_long} n JOIN {fx_trading} d ON d.TRADE_DT = n.END_DATE) t",
    "fx_nav_obs": "SELECT n.* FROM {fx_nav_sparse} n JOIN {fx_trading} d ON n.END_DATE = d.TRADE_DT",
    "fx_fund_nav": """SELECT s.TICKER_SYMBOL, d.TRADE_DT AS END_DATE,
       last_value(n.NAV IGNORE NULLS) OVER (PARTITION BY s.TICKER_SYMBOL ORDER BY d.TRADE_DT ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS NAV
FROM (SELECT TICKER_SYMBOL, min(END_DATE) AS F FROM {fx_nav_obs} GROUP BY 1) s
JOIN {fx_trading} d ON d.TRADE_DT >= s.F
LEFT JOIN {fx_nav_obs} n ON n.TICKER_SYMBOL = s.TICKER_SYMBOL AND n.END_DATE = d.TRADE_DT""",
    "fx_fund_ret": """SELECT TICKER_SYMBOL, END_DATE, (NAV / lag(NAV) OVER (PARTITION BY TICKER_SYMBOL ORDER BY END_DATE) - 1) * 100 AS RETURN_RATE FROM {fx_fund_nav}""",
}

_NAME = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table or a derived view as a DataFrame."""
    if name in VIEWS:
        parts = {dep: view(spark, sf_dir, dep) for dep in set(_NAME.findall(VIEWS[name]))}
        return spark.sql(VIEWS[name], **parts)
    if name == "fx_cal":
        return calendar(spark, sf_dir)
    if name == "fx_fund_nav":
        return densify(view(spark, sf_dir, "fx_nav_sparse"), trading_days(calendar(spark, sf_dir)), "TICKER_SYMBOL", "END_DATE", "NAV")
    return table(spark, sf_dir, name)


def holdings_by_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_holdings``, laid out by stock: the line items travel to their stock once, where they meet the parts and are added up."""
    rows = spark.sql(
        """SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS REPORT_DATE, concat('F', CAST(l_suppkey AS VARCHAR(10))) AS FUND_ID,
       CAST(l_partkey AS VARCHAR(20)) AS HOLDING_TICKER_SYMBOL, CAST(round(l_extendedprice * 100) AS BIGINT) AS CENTS
FROM {lineitem} WHERE l_partkey IS NOT NULL""",
        lineitem=table(spark, sf_dir, "lineitem"),
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("HOLDING_TICKER_SYMBOL"), F.col("p_brand").alias("INDUSTRY_NAME"), F.col("p_type").alias("SECTOR"))
    keys = ["REPORT_DATE", "FUND_ID", "HOLDING_TICKER_SYMBOL", "INDUSTRY_NAME", "SECTOR"]
    joined = spread(rows, "HOLDING_TICKER_SYMBOL").join(part, "HOLDING_TICKER_SYMBOL")
    return joined.groupBy(*keys).agg((F.sum("CENTS").cast("double") / 100).alias("MARKET_VALUE"))


_CALENDARS: dict[tuple[str, str], DataFrame] = {}


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar with the previous-flag dates: a dimension of a few thousand days, held as a local relation per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CALENDARS:
        cal = add_previous_flag_dates(view(spark, sf_dir, "fx_calendar"))
        pinned = pin_small(cal)
        _CALENDARS[key] = cal if pinned is None else pinned
    return _CALENDARS[key]


def trading_days(cal: DataFrame) -> DataFrame:
    return cal.where(F.col("IF_TRADING_DAY") == 1).select("TRADE_DT")


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the views a query names in front of it as common table expressions."""
    texts = {**VIEWS, **ORACLE_VIEWS, **(extra or {})}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name in texts and name not in ordered:
                need(texts[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    body = sql.strip()
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_NAME.sub(lambda m: m.group(1), texts[n])})" for n in ordered)
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
