"""Price bars: left-open, right-closed intervals labelled by their right end; empty intervals give no bar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions.series import by

MINUTES = {"5min": 5, "15min": 15, "30min": 30}  # fixed values: target intervals
SESSION_ROWS = 240  # fixed value: one-minute rows of one complete session


def bar_end(ts: str, minutes: int) -> Column:
    return F.window(F.col(ts) - F.expr("INTERVAL 1 MICROSECOND"), f"{minutes} minutes")["end"]


def _ohlc(order: Column) -> list[Column]:
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("turnover").alias("turnover"),
        F.sum("amount").alias("amount"),
    ]


def tick_bars(ticks: DataFrame, minutes: int) -> DataFrame:
    """Bars from single trades (``code, trade_time, seq, price, amount``); partial aggregation, no sort."""
    at = F.struct("trade_time", "seq")
    rows = ticks.select("code", bar_end("trade_time", minutes).alias("bar_end"), "trade_time", "seq", "price", "amount")
    return rows.groupBy("code", "bar_end").agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count(F.lit(1)).cast("double").alias("turnover"), F.sum("amount").alias("amount")
    ).withColumnRenamed("bar_end", "trade_time")


def resample(bars: DataFrame, interval: str) -> DataFrame:
    """Coarser bars from finer ones: ``5min``, ``15min``, ``30min``, ``60min`` or ``day``."""
    if interval == "day":
        return bars.groupBy("code", F.date_trunc("day", "trade_time").cast("date").alias("trade_date")).agg(*_ohlc(F.col("trade_time")))
    if interval == "60min":
        return hour_bars(resample(bars, "30min"))
    if interval not in MINUTES:
        raise ValueError(f"unknown interval {interval}")
    # the right end of an interval is reached by the label of the bar itself
    return (
        bars.withColumn("_end", bar_end("trade_time", MINUTES[interval]))
        .groupBy("code", "_end")
        .agg(*_ohlc(F.col("trade_time")))
        .withColumnRenamed("_end", "trade_time")
    )


def hour_bars(half_hours: DataFrame) -> DataFrame:
    """Pairs of consecutive half-hour bars by position (a break in the session does not split a pair); an odd last bar stays alone.

    One code has at most 48 half-hour bars per day, so its sequence is bounded by the calendar.
    """
    numbered = half_hours.withColumn("_pair", F.floor((F.row_number().over(by(["code"], "trade_time")) - 1) / 2))
    return numbered.groupBy("code", "_pair").agg(F.max("trade_time").alias("_end"), *_ohlc(F.col("trade_time"))).drop("_pair").withColumnRenamed("_end", "trade_time")


def complete_sessions(bars: DataFrame, rows: int = SESSION_ROWS) -> DataFrame:
    """Only the codes whose number of one-minute rows is a multiple of a session's."""
    whole = bars.groupBy("code").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") % rows == 0).select("code")
    return bars.join(whole, "code", "left_semi")
