"""Scans, sinks and ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from navloom.catalog.base import register, rounded
from navloom.session import shared_dir
from navloom.sources import fixtures as fx
from navloom.sources import ingest, readers, versions

T, D = "TICKER_SYMBOL", "END_DATE"


def _fresh(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _nav_dataset(spark, sf):
    """The short NAV panel as a dataset with one partition per date."""
    path = _fresh(spark, "nav")
    ingest.write_dataset(fx.view(spark, sf, "fx_nav"), path, [D], "overwrite")
    return path


@register("a01_parquet_scan", "SELECT TICKER_SYMBOL, END_DATE, round(ADJ_NAV, 6) AS NAV FROM fx_nav WHERE END_DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-12'")
def a01_parquet_scan(spark, sf):
    return rounded(readers.read_nav(spark, _nav_dataset(spark, sf), "2024-01-08", "2024-01-12"))


@register("a02_sql_over_parquet", "SELECT l_returnflag, count(*) AS N, max(l_extendedprice) AS HI FROM lineitem WHERE l_quantity < 10 GROUP BY 1 ORDER BY 1")
def a02_sql_over_parquet(spark, sf):
    return readers.sql_over_parquet(spark, f"{sf}/lineitem.parquet", "SELECT l_returnflag, count(*) AS N, max(l_extendedprice) AS HI FROM {data} WHERE l_quantity < 10 GROUP BY l_returnflag ORDER BY l_returnflag")


OVERLAP = "SELECT TICKER_SYMBOL, END_DATE, CASE WHEN length(TICKER_SYMBOL) <> 1 THEN ADJ_NAV + 1 ELSE ADJ_NAV END AS ADJ_NAV FROM fx_nav"


def _batches(spark, sf):
    """Two overlapping batches: the second corrects part of the first and adds the rest."""
    nav = fx.view(spark, sf, "fx_nav")
    first = nav.where(F.length(T) <= 2)
    second = nav.where(F.length(T) != 1).withColumn("ADJ_NAV", F.col("ADJ_NAV") + 1)
    return first, second


def _twice(batch):
    """Every key of the batch twice; the row with ``SEQ`` 2 is the later one."""
    return batch.withColumn("SEQ", F.lit(2)).unionByName(batch.select(T, D, F.col("ADJ_NAV") * 3, F.lit(1).alias("SEQ")).toDF(T, D, "ADJ_NAV", "SEQ"))


SEQUENCE = "SELECT TICKER_SYMBOL, END_DATE, ADJ_NAV, 0 AS SEQ FROM fx_nav WHERE length(TICKER_SYMBOL) <= 2 UNION ALL SELECT TICKER_SYMBOL, END_DATE, (ADJ_NAV + 1) * 3, 1 FROM fx_nav WHERE length(TICKER_SYMBOL) <> 1 UNION ALL SELECT TICKER_SYMBOL, END_DATE, ADJ_NAV + 1, 2 FROM fx_nav WHERE length(TICKER_SYMBOL) <> 1"


@register("a06_upsert_by_key", f"SELECT TICKER_SYMBOL, END_DATE, round(arg_max(ADJ_NAV, SEQ), 6) AS ADJ_NAV FROM ({SEQUENCE}) t GROUP BY 1, 2")
def a06_upsert_by_key(spark, sf):
    first, second = _batches(spark, sf)
    path = _fresh(spark, "a06")
    versions.replace(first, path, [T, D])
    versions.upsert(_twice(second), path, [T, D], ["SEQ"], excluded=["SEQ"])
    return rounded(versions.read(spark, path))


@register("a07_insert_ignore", f"SELECT TICKER_SYMBOL, END_DATE, round(arg_min(ADJ_NAV, SEQ), 6) AS ADJ_NAV FROM ({SEQUENCE}) t GROUP BY 1, 2")
def a07_insert_ignore(spark, sf):
    first, second = _batches(spark, sf)
    return rounded(ingest.insert_missing(first, _twice(second), [T, D], ["SEQ"]))


@register("a08_partitioned_write_update", f"SELECT TICKER_SYMBOL, END_DATE, round(ADJ_NAV, 6) AS ADJ_NAV FROM ({OVERLAP}) t")
def a08_partitioned_write_update(spark, sf):
    first, second = _batches(spark, sf)
    path = _fresh(spark, "a08")
    ingest.write_dataset(first.withColumn("NOTE", F.lit("x")), path, [D], "overwrite", excluded=["NOTE"])
    ingest.write_dataset(_twice(second), path, [D], "update", keys=[T, D], excluded=["SEQ"], order=["SEQ"])
    ingest.write_dataset(second.limit(0), path, [D], "skip")
    return rounded(spark.read.schema("TICKER_SYMBOL string, ADJ_NAV double, END_DATE date").parquet(path).select(T, D, "ADJ_NAV"))


@register("a09_write_normalisation", "SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN l_extendedprice / l_tax END AS RATIO, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS FLAG, CAST(l_shipdate AS TIMESTAMP) AS DAY FROM lineitem")
def a09_write_normalisation(spark, sf):
    line = fx.table(spark, sf, "lineitem")
    ratio = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_extendedprice", "l_tax"))
    raw = line.select("l_orderkey", "l_linenumber", ratio.alias("RATIO"), F.when(F.col("l_returnflag") == "N", "inf").otherwise(F.col("l_returnflag")).alias("FLAG"), F.to_date("l_shipdate").alias("DAY"))
    return ingest.normalise(raw)


@register("a10_watermark_row_id", "SELECT event_id, user_id, value FROM events")
def a10_watermark_row_id(spark, sf):
    source = fx.table(spark, sf, "events").select("event_id", "user_id", "value")
    half = source.agg(F.expr("max(event_id) div 2")).first()[0]
    target = source.where(F.col("event_id") <= half)
    return ingest.merge_rows(target, ingest.after_watermark(source, "event_id", target), ["event_id"], ["event_id"])


@register("a10_stored_incremental_load", "SELECT event_id, CAST(user_id AS BIGINT) AS USER_ID, CASE WHEN event_id % 10 = 0 AND event_id > M // 2 THEN value + 1 ELSE value END AS VALUE FROM events, (SELECT max(event_id) AS M FROM events) m")
def a10_stored_incremental_load(spark, sf):
    """A first load of half the rows, a second one from the watermark of the stored table on; some rows come again with other values."""
    source = fx.table(spark, sf, "events").select("event_id", F.col("user_id").cast("bigint").alias("User"), F.col("value").alias("Value"), F.lit(0).alias("ID"))
    top = source.agg(F.max("event_id")).first()[0]
    job = ingest.Mirror(rename={"User": "USER_ID", "Value": "VALUE"}, keys=["event_id"], watermark="event_id", drop=["ID"])
    path = _fresh(spark, "a10")
    ingest.load_incremental(source.where(F.col("event_id") <= top // 2), path, job)
    newer = F.when((F.col("event_id") % 10 == 0) & (F.col("event_id") > top // 2), F.col("Value") + 1).otherwise(F.col("Value"))
    ingest.load_incremental(source.withColumn("Value", newer), path, job)
    ingest.load_incremental(source.where("event_id < 0"), path, job)
    return ingest.read_dataset(spark, path)


@register("a11_watermark_time", "SELECT event_id, ts, value FROM events")
def a11_watermark_time(spark, sf):
    source = fx.table(spark, sf, "events").select("event_id", "ts", "value")
    target = source.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'").withColumn("value", F.col("value"))
    return ingest.merge_rows(target, ingest.after_watermark(source, "ts", target), ["event_id"], ["ts"])


@register("a12_tombstone_deletes", "SELECT 'kept' AS STATE, count(*) AS N, sum(event_id)::BIGINT AS S FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error') UNION ALL SELECT 'removed', count(*), sum(event_id)::BIGINT FROM events WHERE event_type = 'error'")
def a12_tombstone_deletes(spark, sf):
    events = fx.table(spark, sf, "events")
    log = events.where("event_type = 'error'").select(F.col("event_id").alias("DEL_JSID"))
    kept, removed = ingest.apply_deletes(events, log, "event_id", "DEL_JSID")
    both = kept.select(F.lit("kept").alias("STATE"), "event_id").unionByName(removed.select(F.lit("removed").alias("STATE"), "event_id"))
    return both.groupBy("STATE").agg(F.count(F.lit(1)).alias("N"), F.sum("event_id").alias("S"))


@register("a15_delete_by_key", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def a15_delete_by_key(spark, sf):
    gone = fx.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return ingest.delete_keys(fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), gone).select("o_orderkey")


@register("a16_column_harmonisation", "SELECT s_suppkey AS FUND_ID, s_name AS SEC_SHORT_NAME, s_acctbal AS NET_ASSET FROM supplier")
def a16_column_harmonisation(spark, sf):
    return ingest.harmonise(fx.table(spark, sf, "supplier"), {"s_suppkey": "FUND_ID", "s_name": "SEC_SHORT_NAME", "s_acctbal": "NET_ASSET"}, ["s_nationkey"])


@register("a17_daily_snapshot_export", "SELECT TICKER_SYMBOL, END_DATE, round(ADJ_NAV, 6) AS ADJ_NAV FROM fx_nav WHERE END_DATE IN (DATE '2024-01-10', DATE '2024-01-11')")
def a17_daily_snapshot_export(spark, sf):
    path = _fresh(spark, "a17")
    for day in ("2024-01-10", "2024-01-11", "2024-01-11"):
        ingest.export_snapshot(fx.view(spark, sf, "fx_nav"), path, D, day)
    return rounded(spark.read.schema("TICKER_SYMBOL string, ADJ_NAV double, END_DATE date").parquet(path).select(T, D, "ADJ_NAV"))


@register("a18_coverage_statistics", "SELECT TICKER_SYMBOL, min(END_DATE) AS START_DATE, max(END_DATE) AS END_DATE FROM fx_nav GROUP BY 1")
def a18_coverage_statistics(spark, sf):
    return ingest.coverage(fx.view(spark, sf, "fx_nav"), T, D)


@register("a19_table_copy", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def a19_table_copy(spark, sf):
    path = _fresh(spark, "a19")
    versions.upsert(fx.table(spark, sf, "supplier"), path, ["s_suppkey"], ["s_suppkey"])
    versions.upsert(fx.table(spark, sf, "supplier"), path, ["s_suppkey"], ["s_suppkey"])
    return versions.read(spark, path)


@register("a20_delimited_ledgers", "SELECT date, type, ticker, quantity, price, CAST(0.0 AS DOUBLE) AS fees FROM fx_ledger WHERE type = 'Buy' UNION ALL SELECT date, type, ticker, quantity, price, CAST(1.5 AS DOUBLE) FROM fx_ledger WHERE type = 'Sell'")
def a20_delimited_ledgers(spark, sf):
    trades = fx.view(spark, sf, "fx_ledger")
    one, two = _fresh(spark, "broker1"), _fresh(spark, "broker2")
    opts = {"sep": ";", "header": True}
    trades.where("type = 'Buy'").select(F.col("date").alias("Trade Date"), F.col("type").alias("Side"), F.col("ticker").alias("Symbol"), "quantity", "price", F.lit(0.0).alias("fees")).write.csv(one, dateFormat="yyyy-MM-dd", **opts)
    trades.where("type = 'Sell'").select("ticker", F.col("date").alias("Datum"), "type", "price", "quantity", F.lit(1.5).alias("Fee")).write.csv(two, dateFormat="dd.MM.yyyy", **opts)
    columns = ["date", "type", "ticker", "quantity", "price", "fees"]
    a = readers.read_delimited(spark, one, "`Trade Date` date, Side string, Symbol string, quantity double, price double, fees double", {"Trade Date": "date", "Side": "type", "Symbol": "ticker"}, "yyyy-MM-dd")
    b = readers.read_delimited(spark, two, "ticker string, Datum date, type string, price double, quantity double, Fee double", {"Datum": "date", "Fee": "fees"}, "dd.MM.yyyy")
    return readers.merge_ledgers([a, b], columns)


@register("a21_header_cleaning", "SELECT s_suppkey AS fund_id, s_name AS short_name, s_acctbal AS net_asset_cny FROM supplier")
def a21_header_cleaning(spark, sf):
    raw = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias(" Fund ID "), F.col("s_name").alias("Short. Name"), F.col("s_acctbal").alias("Net Asset (CNY)"))
    return readers.clean_headers(raw)


@register(
    "a22_config_driven_mirror",
    "SELECT concat('F', l_suppkey) AS TICKER_SYMBOL, CAST(l_shipdate AS DATE) AS REPORT_DATE, max(l_orderkey * 10 + l_linenumber) AS JSID, arg_max(l_quantity, l_orderkey * 10 + l_linenumber) AS HOLD_VOLUME FROM lineitem WHERE l_orderkey * 10 + l_linenumber >= (SELECT max(l_orderkey * 10 + l_linenumber) FROM lineitem WHERE l_shipdate < DATE '1996-01-01' AND l_quantity > 49) GROUP BY 1, 2",
)
def a22_config_driven_mirror(spark, sf):
    line = fx.table(spark, sf, "lineitem")
    source = line.select(F.col("l_suppkey").alias("InnerCode"), F.to_date("l_shipdate").alias("EndDate"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("JSID"), F.col("l_quantity").alias("Volume"), F.lit(1).alias("ID"))
    target = line.where("l_shipdate < DATE '1996-01-01' AND l_quantity > 49").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("JSID"))
    codes = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("InnerCode"), F.concat(F.lit("F"), F.col("s_suppkey").cast("string")).alias(T))
    job = ingest.Mirror(rename={"EndDate": "REPORT_DATE", "Volume": "HOLD_VOLUME"}, keys=[T, "REPORT_DATE"], watermark="JSID", drop=["ID"], codes=("InnerCode", T))
    return ingest.mirror(source, target, job, codes).select(T, "REPORT_DATE", "JSID", "HOLD_VOLUME")


@register(
    "a22_stored_mirror",
    "SELECT concat('F', l_suppkey) AS TICKER_SYMBOL, CAST(l_shipdate AS DATE) AS REPORT_DATE, max(l_orderkey * 10 + l_linenumber) AS JSID, arg_max(l_quantity, l_orderkey * 10 + l_linenumber) AS HOLD_VOLUME FROM lineitem GROUP BY 1, 2",
)
def a22_stored_mirror(spark, sf):
    """Every vendor row of two loads, the newest of a fund and day; the second load begins at the first one's watermark."""
    line = fx.table(spark, sf, "lineitem")
    source = line.select(F.col("l_suppkey").alias("InnerCode"), F.to_date("l_shipdate").alias("EndDate"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("JSID"), F.col("l_quantity").alias("Volume"), F.lit(1).alias("ID"))
    codes = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("InnerCode"), F.concat(F.lit("F"), F.col("s_suppkey").cast("string")).alias(T))
    job = ingest.Mirror(rename={"EndDate": "REPORT_DATE", "Volume": "HOLD_VOLUME"}, keys=[T, "REPORT_DATE"], watermark="JSID", drop=["ID"], codes=("InnerCode", T))
    half = source.agg(F.expr("max(JSID) div 2")).first()[0]
    path = _fresh(spark, "a22")
    ingest.load_incremental(source.where(F.col("JSID") <= half), path, job, codes)
    ingest.load_incremental(source, path, job, codes)
    return ingest.read_dataset(spark, path).select(T, "REPORT_DATE", "JSID", "HOLD_VOLUME")


@register("h07_partitioned_outputs", "SELECT l_returnflag, l_linestatus, count(*) AS N FROM lineitem GROUP BY 1, 2")
def h07_partitioned_outputs(spark, sf):
    path = _fresh(spark, "h07")
    ingest.write_dataset(fx.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"), path, ["l_returnflag", "l_linestatus"], "overwrite")
    return spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("N"))
