"""Trading calendar and look-back windows.

A calendar is a table with one row per natural day (and market): ``TRADE_DT, IF_TRADING_DAY, IF_WEEK_END, IF_MONTH_END,
IF_QUARTER_END, IF_YEAR_END``.  Its size is bounded by the number of days, so windows over it are single-task by design.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.session import broadcast_checked

# fixed values: look-back horizons, their labels and the names of the previous-flag columns
LOOKBACKS = {"WEEK": [1], "MONTH": [1, 2, 3, 6, 9], "YEAR": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]}
UNIT_LABEL = {"DAY": "日", "WEEK": "周", "MONTH": "月", "YEAR": "年"}
FLAG_COLUMNS = {
    "IF_TRADING_DAY": "PREV_TRADE_DATE",
    "IF_WEEK_END": "WEEK_END_DATE",
    "IF_MONTH_END": "MONTH_END_DATE",
    "IF_QUARTER_END": "QUARTER_END_DATE",
    "IF_YEAR_END": "YEAR_END_DATE",
}
TO_DATE_LABEL = {
    "PREV_TRADE_DATE": "近1日",
    "WEEK_END_DATE": "WTD",
    "MONTH_END_DATE": "MTD",
    "QUARTER_END_DATE": "QTD",
    "YEAR_END_DATE": "YTD",
}
PERIOD_FLAG = {"d": "IF_TRADING_DAY", "w": "IF_WEEK_END", "m": "IF_MONTH_END", "q": "IF_QUARTER_END", "y": "IF_YEAR_END"}


def lookback_label(n: int, unit: str) -> str:
    return f"近{n}{UNIT_LABEL[unit]}"


def add_previous_flag_dates(cal: DataFrame, market: Sequence[str] = ()) -> DataFrame:
    """For every flag the last flagged date strictly before the day."""
    before = Window.partitionBy(*market or [F.lit(0)]).orderBy("TRADE_DT").rowsBetween(Window.unboundedPreceding, -1)
    return cal.withColumns(
        {out: F.last(F.when(F.col(flag) == 1, F.col("TRADE_DT")), ignorenulls=True).over(before) for flag, out in FLAG_COLUMNS.items()}
    )


def shift_date(day: Column, n: int, unit: str) -> Column:
    """``n`` natural units back; month and year steps clamp to the end of a shorter month."""
    if unit == "DAY":
        return F.date_sub(day, n)
    if unit == "WEEK":
        return F.date_sub(day, 7 * n)
    return F.add_months(day, -n * (12 if unit == "YEAR" else 1))


def snapped_days(cal: DataFrame) -> DataFrame:
    """``DAY, SNAP``: the day itself when it trades, else the previous trading day."""
    return cal.select(
        F.col("TRADE_DT").alias("DAY"),
        F.when(F.col("IF_TRADING_DAY") == 1, F.col("TRADE_DT")).otherwise(F.col("PREV_TRADE_DATE")).alias("SNAP"),
    )


def lookback_table(cal: DataFrame, spec: Mapping[str, Sequence[int]] = LOOKBACKS) -> DataFrame:
    """Trading days with one row per horizon: ``END_DATE, DATE_NAME, START_DATE`` (snapped to a trading day)."""
    steps = [
        F.struct(F.lit(lookback_label(n, unit)).alias("DATE_NAME"), shift_date(F.col("TRADE_DT"), n, unit).alias("DAY"))
        for unit, ns in spec.items()
        for n in ns
    ]
    days = cal.where("IF_TRADING_DAY = 1").select(F.col("TRADE_DT").alias("END_DATE"), F.inline(F.array(*steps)))
    return days.join(snapped_days(cal), "DAY").where(F.col("SNAP").isNotNull()).select("END_DATE", "DATE_NAME", F.col("SNAP").alias("START_DATE"))


def lookback_wide(cal: DataFrame, spec: Mapping[str, Sequence[int]] = LOOKBACKS) -> DataFrame:
    """Same as columns ``PREV_{n}_{unit}``, one row per trading day."""
    snaps = snapped_days(cal)
    long = lookback_table(cal, spec)
    names = [(lookback_label(n, u), f"PREV_{n}_{u}") for u, ns in spec.items() for n in ns]
    wide = long.groupBy("END_DATE").agg(*[F.max(F.when(F.col("DATE_NAME") == label, F.col("START_DATE"))).alias(col) for label, col in names])
    return cal.where("IF_TRADING_DAY = 1").select(F.col("TRADE_DT").alias("END_DATE")).join(wide, "END_DATE", "left")


def to_date_windows(cal: DataFrame) -> DataFrame:
    """Previous day, week / month / quarter / year to date, unpivoted to ``END_DATE, DATE_NAME, START_DATE``."""
    wide = cal.where("IF_TRADING_DAY = 1").select(
        F.col("TRADE_DT").alias("END_DATE"), *[F.col(c).alias(label) for c, label in TO_DATE_LABEL.items()]
    )
    return wide.unpivot(["END_DATE"], list(TO_DATE_LABEL.values()), "DATE_NAME", "START_DATE")


def window_table(
    cal: DataFrame,
    end_dates: DataFrame,
    portfolios: DataFrame | None = None,
    special: Mapping[str, str] | None = None,
    spec: Mapping[str, Sequence[int]] = LOOKBACKS,
) -> DataFrame:
    """``PORTFOLIO_NAME, DATE_NAME, START_DATE, END_DATE`` with END after START.

    ``end_dates`` has ``END_DATE``; ``portfolios`` has ``PORTFOLIO_NAME, DATE_NAME, START_DATE`` (inception, first client
    date); ``special`` maps a label to a fixed start day.
    """
    parts = [to_date_windows(cal), lookback_table(cal, spec)]
    if special:
        fixed = [F.struct(F.lit(k).alias("DATE_NAME"), F.to_date(F.lit(v)).alias("START_DATE")) for k, v in special.items()]
        parts.append(cal.where("IF_TRADING_DAY = 1").select(F.col("TRADE_DT").alias("END_DATE"), F.inline(F.array(*fixed))))
    common = reduce(DataFrame.unionByName, parts).join(end_dates, "END_DATE", "left_semi").withColumn("PORTFOLIO_NAME", F.lit("ALL"))
    if portfolios is not None:
        small = broadcast_checked(end_dates)  # the trailing days of a run
        own = portfolios.join(end_dates if small is None else small, F.col("START_DATE") < F.col("END_DATE"))
        common = common.unionByName(own.select("PORTFOLIO_NAME", "DATE_NAME", "START_DATE", "END_DATE"))
    return common.where(F.col("END_DATE") > F.col("START_DATE")).select("PORTFOLIO_NAME", "DATE_NAME", "START_DATE", "END_DATE")


def trading_index(cal: DataFrame) -> DataFrame:
    """``TRADE_DT, IDX``: position of each trading day."""
    return cal.where("IF_TRADING_DAY = 1").select("TRADE_DT", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("TRADE_DT")).alias("IDX"))


def offset_trading_days(cal: DataFrame, n: int, count_today: bool = False) -> DataFrame:
    """``TRADE_DT, OFFSET_DT`` for every natural day: ``n`` trading days back (negative n: forward).

    Step 0 is the day itself when it trades, else the nearest trading day in the direction of travel; ``count_today`` makes
    that day the first step.
    """
    ordered = Window.partitionBy(F.lit(0)).orderBy("TRADE_DT").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("IF_TRADING_DAY").over(ordered)
    steps = abs(n) - (1 if count_today else 0)
    wanted = upto - steps if n >= 0 else upto - F.col("IF_TRADING_DAY") + 1 + steps
    idx = trading_index(cal).select(F.col("IDX").alias("_IDX"), F.col("TRADE_DT").alias("OFFSET_DT"))
    return cal.select("TRADE_DT", wanted.alias("_IDX")).join(idx, "_IDX", "left").select("TRADE_DT", "OFFSET_DT")


def offset_period(cal: DataFrame, n: int, unit: str) -> DataFrame:
    """``TRADE_DT, TARGET, SNAPPED``: shift by a natural period, then move back to a trading day."""
    shifted = cal.select("TRADE_DT", shift_date(F.col("TRADE_DT"), n, unit).alias("DAY"))
    return shifted.join(snapped_days(cal), "DAY", "left").select("TRADE_DT", F.col("DAY").alias("TARGET"), F.col("SNAP").alias("SNAPPED"))


def period_ends(cal: DataFrame, period: str) -> DataFrame:
    """Flagged dates of one period kind (d, w, m, q, y)."""
    return cal.where(F.col(PERIOD_FLAG[period]) == 1).select("TRADE_DT")


def period_table(cal: DataFrame) -> DataFrame:
    """``DATE_NAME, START_DATE, END_DATE`` for each month, quarter and year; START is the last trading day of the period before.

    The running, unfinished period is included and ends on its latest trading day.
    """
    days = cal.where("IF_TRADING_DAY = 1")
    year = F.year("TRADE_DT").cast("string")
    kinds = [
        (F.date_format("TRADE_DT", "yyyy-MM"), "MONTH_END_DATE"),
        (F.concat(year, F.lit("-Q"), F.quarter("TRADE_DT").cast("string")), "QUARTER_END_DATE"),
        (F.concat(year, F.lit("年")), "YEAR_END_DATE"),
    ]
    each = F.array(*[F.struct(label.alias("DATE_NAME"), F.col(prev).alias("START_DATE")) for label, prev in kinds])
    return (
        days.select("TRADE_DT", F.inline(each))
        .groupBy("DATE_NAME", "START_DATE")
        .agg(F.max("TRADE_DT").alias("END_DATE"))
        .where(F.col("START_DATE").isNotNull())
    )


def recent_windows(cal: DataFrame, as_of: Column, inception: Column, spec: Mapping[str, Sequence[int]]) -> DataFrame:
    """``DATE_NAME, START_DATE, END_DATE`` for one as-of day, without the windows that start before inception."""
    steps = [F.struct(F.lit(lookback_label(n, u)).alias("DATE_NAME"), shift_date(as_of, n, u).alias("DAY")) for u, ns in spec.items() for n in ns]
    one = cal.where(F.col("TRADE_DT") == as_of).select(F.col("TRADE_DT").alias("END_DATE"), F.inline(F.array(*steps)))
    return one.join(snapped_days(cal), "DAY").where(F.col("SNAP") >= inception).select("DATE_NAME", F.col("SNAP").alias("START_DATE"), "END_DATE")


def report_dates_before(day: Column, n: int) -> Column:
    """Array of the last ``n`` quarter-end dates before ``day``; the running quarter is not among them."""
    quarter = F.trunc(day, "quarter")
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.date_sub(F.add_months(quarter, -3 * (i - 1)), 1))


def publish_estimate(report: Column, audited: Column | None = None) -> Column:
    """Report date plus one month, plus three when the report is an annual or half-year one."""
    quick = F.add_months(report, 1)
    return quick if audited is None else F.when(audited, F.add_months(report, 3)).otherwise(quick)


def active_days(first: str, last: str) -> Column:
    """Array of natural days from ``first`` to ``last``."""
    return F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))
