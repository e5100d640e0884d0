"""Time-aware joins: densify, as-of, validity interval, bands, window fan-out, full outer with defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.functions.series import by, forward_fill
from navloom.session import broadcast_checked, pin_small

OPEN_END = "2099-12-31"  # fixed value: exit date of an interval that is still open


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash by ``keys`` over twice the session's partitions, ahead of a step that multiplies rows.

    Adaptive execution sizes partitions by the bytes it sees before the rows multiply and would merge them into a few
    tasks; an explicit count is left alone.  Windows and aggregates that group by ``key`` and more reuse this layout.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def densify(panel: DataFrame, trading_days: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Entity x trading day from the entity's first observation to the last calendar day, value carried forward.

    Every observation is repeated for the trading days up to the next one (``sequence``), so the dense panel needs one
    shuffle of the sparse rows and neither a cross join nor a join of the dense grid.  ``trading_days`` has ``TRADE_DT``.
    """
    days = trading_days.select(F.col("TRADE_DT").alias(date))
    last = F.broadcast(days.agg(F.max(date).alias("_LAST")))  # one row
    kept = spread(panel.where(F.col(value).isNotNull()).join(days, date, "left_semi").select(key, date, value), key)
    until = F.coalesce(F.date_sub(F.lead(date).over(by([key], date)), 1), F.col("_LAST"))
    spans = kept.join(last).withColumn("_UNTIL", until)
    filled = spans.select(key, F.explode(F.sequence(date, "_UNTIL", F.expr("INTERVAL 1 DAY"))).alias(date), value)
    return filled.join(days, date, "left_semi").select(key, date, value)


def as_of(left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str, values: Sequence[str]) -> DataFrame:
    """Latest right row with ``right_date <= left_date`` per key; left rows without one keep nulls.

    The lookup is solved once per distinct (key, date) and joined back on both columns, so a key that holds a large share of
    the left rows is spread over its dates.
    """
    asked = left.select(key, F.col(left_date).alias("_AT")).distinct()
    facts = right.select(key, F.col(right_date).alias("_AT"), F.struct(F.col(right_date).alias(right_date), *values).alias("_FACT"))
    facts = facts.groupBy(key, "_AT").agg(F.max("_FACT").alias("_FACT"))
    timeline = asked.withColumn("_ASKED", F.lit(True)).join(facts, [key, "_AT"], "full_outer")
    solved = timeline.withColumn("_FACT", forward_fill(F.col("_FACT"), by([key], "_AT"))).where("_ASKED").select(key, F.col("_AT").alias(left_date), "_FACT")
    joined = left.join(solved, [key, left_date], "left")
    extra = [F.col("_FACT")[right_date].alias(right_date)] if right_date not in left.columns else []
    return joined.select(*left.columns, *extra, *[F.col("_FACT")[v].alias(v) for v in values])


def valid_on(df: DataFrame, day: Column, entry: str, leave: str, closed: bool = True) -> DataFrame:
    """Rows whose interval holds ``day``; null leave = open.  ``closed=False`` excludes the leave day."""
    end = F.coalesce(F.col(leave), F.to_date(F.lit(OPEN_END)))
    return df.where((F.col(entry) <= day) & ((day <= end) if closed else (day < end)))


def interval_join(facts: DataFrame, dim: DataFrame, key: str, date: str, entry: str, leave: str, how: str = "inner", closed: bool = False) -> DataFrame:
    """Equi-join on the key, the validity interval as residual condition."""
    d = dim.alias("d")
    end = F.coalesce(F.col(f"d.{leave}"), F.to_date(F.lit(OPEN_END)))
    day = F.col(f"f.{date}")
    cond = (F.col(f"f.{key}") == F.col(f"d.{key}")) & (F.col(f"d.{entry}") <= day) & ((day <= end) if closed else (day < end))
    return facts.alias("f").join(d, cond, how).select("f.*", *[F.col(f"d.{c}") for c in dim.columns if c not in facts.columns])


MAX_BAND_CELLS = 1_024  # cells of the value axis


def band_join(df: DataFrame, bands: DataFrame, value: str, low: str = "MIN", high: str = "MAX") -> DataFrame:
    """Attach the bands whose closed range holds ``value``; a row without one keeps nulls, a null or NaN end holds nothing.

    Values and bands meet in cells of the value axis whose edges are quantiles of the bands' lower ends, so a cell holds about as
    many band starts as any other, and a wide or open band lies in at most ``MAX_BAND_CELLS`` cells, whatever its length.
    """
    ends = bands.where(~F.isnan(F.col(low).cast("double")) & ~F.isnan(F.col(high).cast("double")))
    shares = [k / MAX_BAND_CELLS for k in range(1, MAX_BAND_CELLS)]
    edges = sorted(set(ends.agg(F.percentile_approx(F.col(low).cast("double"), shares, 10_000)).first()[0] or []))
    axis = F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>")
    cell = lambda c: F.size(F.filter(axis, lambda e: e <= c.cast("double")))
    placed = ends.where(F.col(low) <= F.col(high)).withColumn("_CELL", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high)))))
    asked = df.withColumn("_AT", cell(F.col(value)))
    inside = (F.col("_AT") == F.col("_CELL")) & (asked[value] >= placed[low]) & (asked[value] <= placed[high])
    return asked.join(placed, inside, "left").drop("_CELL", "_AT")


def fan_out(panel: DataFrame, windows: DataFrame, key: str = "TICKER_SYMBOL", date: str = "END_DATE") -> DataFrame:
    """Every panel row once per window that holds its date; adds ``WIN_START, WIN_END``.

    The panel is shuffled by entity *before* it is multiplied: rows and windows meet on the calendar month, in place while the
    windows are few enough to be broadcast, and later windows and aggregates over (entity, WIN_START, WIN_END) reuse that
    partitioning, so the multiplied rows never travel.
    """
    spans = windows.select(F.col("START_DATE").alias("WIN_START"), F.col("END_DATE").alias("WIN_END")).distinct()
    small = pin_small(spans)
    each = F.sequence(F.trunc("WIN_START", "month"), F.trunc("WIN_END", "month"), F.expr("INTERVAL 1 MONTH"))
    months = (spans if small is None else small).where("WIN_START <= WIN_END").withColumn("_MONTH", F.explode(each))
    inside = F.col(date).between(F.col("WIN_START"), F.col("WIN_END"))
    laid_out = spread(panel, key).withColumn("_MONTH", F.trunc(date, "month"))
    return laid_out.join(months if small is None else F.broadcast(months), "_MONTH").where(inside).drop("_MONTH")


def full_outer_fill(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, float]) -> DataFrame:
    """Full outer join, missing numbers replaced."""
    return left.join(right, list(keys), "full_outer").fillna(dict(defaults))


def natural_outer(frames: Sequence[DataFrame]) -> DataFrame:
    """Outer merge of a list of frames on the columns each pair shares."""
    return reduce(lambda a, b: a.join(b, [c for c in a.columns if c in b.columns], "full_outer"), frames)


def prefix_join(df: DataFrame, code: str, names: DataFrame, level: int) -> DataFrame:
    """Hierarchical code: the first ``2 * level`` characters name the parent at that level.  ``names`` has ``CODE, NAME``."""
    wide = names.select(F.col("CODE").alias("_CODE"), F.col("NAME").alias(f"LEVEL{level}_NAME"))
    return df.withColumn("_CODE", F.substring(code, 1, 2 * level)).join(wide, "_CODE", "left").drop("_CODE")


def decode(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Replace code columns by their text: ``columns`` maps a code column to its category in ``CATEGORY, CODE, TEXT``.

    A column has few codes, so a shuffle by it would put a large part of the rows into one task: the dictionary, whose size is checked,
    travels to the rows.  Beyond that size the join is left to Spark.
    """
    small = broadcast_checked(dictionary)
    for column, category in columns.items():
        part = (dictionary if small is None else small).where(F.col("CATEGORY") == category).select(F.col("CODE").alias(column), F.col("TEXT").alias(f"{column}_TEXT"))
        df = df.join(F.broadcast(part) if small is not None else part, column, "left")
    return df


def previous_period(panel: DataFrame, cal: DataFrame, keys: Sequence[str], date: str, value: str, out: str) -> DataFrame:
    """Value on the calendar's previous trading day; rows without one are dropped (a missing day is not skipped over)."""
    days = cal.where(F.col("PREV_TRADE_DATE").isNotNull()).select(F.col("TRADE_DT").alias(date), "PREV_TRADE_DATE")
    before = panel.select(*keys, F.col(date).alias("PREV_TRADE_DATE"), F.col(value).alias(out))
    return panel.join(days, date).join(before, [*keys, "PREV_TRADE_DATE"]).drop("PREV_TRADE_DATE")


def align_to_trading_day(df: DataFrame, cal: DataFrame, date: str, out: str = "TRADE_DT") -> DataFrame:
    """The date itself when it trades, else the previous trading day."""
    snap = cal.select(
        F.col("TRADE_DT").alias(date), F.when(F.col("IF_TRADING_DAY") == 1, F.col("TRADE_DT")).otherwise(F.col("PREV_TRADE_DATE")).alias(out)
    )
    return df.join(snap, date)


def latest_known(snapshots: DataFrame, day: Column, keys: Sequence[str] = (), report: str = "REPORT_DATE", publish: str = "PUBLISH_DATE") -> DataFrame:
    """Snapshot rows of the latest report published by ``day`` — overall, or per key."""
    known = snapshots.where(F.col(publish) <= day)
    if not keys:
        newest = known.agg(F.max(report).alias(report))
        return known.join(F.broadcast(newest), report, "left_semi")  # one-row aggregate
    newest = known.groupBy(*keys).agg(F.max(report).alias(report))
    return known.join(newest, [*keys, report], "left_semi")


def related_classes(relations: Sequence[DataFrame], universe: DataFrame) -> DataFrame:
    """Union of relation sources (``TICKER_SYMBOL, RELATED``); a ticker that no source names is related to itself."""
    known = reduce(DataFrame.union, [r.select("TICKER_SYMBOL", "RELATED") for r in relations]).distinct()
    orphans = universe.select("TICKER_SYMBOL").distinct().join(known, "TICKER_SYMBOL", "left_anti")
    return known.union(orphans.select("TICKER_SYMBOL", F.col("TICKER_SYMBOL").alias("RELATED")))
