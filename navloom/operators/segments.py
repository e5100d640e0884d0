"""Statistics of look-back windows from mergeable segments: the rest of the first month, whole months, the start of the last month.

A segment of an entity's days has sums, its highest and lowest value and its deepest fall; two segments in a row merge into one, because a
fall across them goes from the highest value of the first to the lowest of the second.  Segments from a day to the end of its
month, from the start of a month to a day, and from a month to a month are running windows, so a (entity, window) is three
lookups, however long it is: no day is copied into a window and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.operators.joins import spread
from navloom.session import broadcast_checked, cut_lineage

KEY, DATE = "TICKER_SYMBOL", "END_DATE"
SPAN = ["WIN_START", "WIN_END"]
_EPOCH = "DATE '1970-01-01'"


@dataclass(frozen=True)
class Fall:
    """Deepest fall of a positive column; ``open``: the first day of a window does not count; ``back``: with the day of recovery."""

    value: str
    open: bool = False
    back: bool = True


def _up(*keys: str, order: str = DATE):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _down(*keys: str, order: str = DATE, skip: bool = False):
    """The rows from here on, or (``skip``) those behind this one."""
    return Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1 if skip else Window.currentRow)


class _Falls:
    """Columns of falls: a low is (value, place), a fall (depth, -place, peak); the place decides between equal ones."""

    def __init__(self, first: bool):
        self.sign = 1 if first else -1

    def low(self, value: str) -> Column:
        place = self.sign * F.datediff(DATE, F.expr(_EPOCH))
        return F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), place.alias("q")))

    def fall(self, low: Column, peak: Column) -> Column:
        depth = 1 - safe_div(low["v"], peak)
        return F.when(depth.isNotNull(), F.struct(depth.alias("dd"), (-low["q"]).alias("p"), peak.cast("double").alias("peak")))

    def day(self, fall: str) -> Column:
        return F.date_add(F.expr(_EPOCH), F.col(f"{fall}.p") * -self.sign)


def _greatest(*falls: Column) -> Column:
    return F.greatest(*falls) if len(falls) > 1 else falls[0]


def window_segments(points: DataFrame, windows: DataFrame, sums: Mapping[str, Column], falls: Mapping[str, Fall], edges: Sequence[str], strict: bool = True, first: bool = False, laid_out: bool = False) -> DataFrame:
    """One row per (entity, window) that holds a day of the entity.

    ``points``: ``TICKER_SYMBOL, END_DATE`` (one row per entity and day) and what the columns need; ``windows``: ``START_DATE, END_DATE``.
    Result: entity, ``WIN_START, WIN_END, START_DATE, LAST_DATE, SECOND_DATE`` (days of the entity inside), ``FIRST_x, LAST_x`` for ``edges``,
    every sum over the days behind the first one (null terms left out), and for every fall ``n_DD, n_DAY, n_PEAK, n_BACK``:
    the deepest fall, its last day (``first``: its first), the value it falls from and the first later day at or above that.
    Values are positive.
    ``strict``: only windows whose two ends are days of the entity.  ``laid_out``: the points come out of windows by entity, so they lie
    by entity already and their many columns need not travel.
    """
    f = _Falls(first)
    spans = windows.select(F.col("START_DATE").alias("WIN_START"), F.col("END_DATE").alias("WIN_END")).where("WIN_START <= WIN_END").distinct()
    small = broadcast_checked(spans)
    spans = spans if small is None else small
    terms = {n: c.cast("double") for n, c in sums.items()}
    values = sorted({x.value for x in falls.values()})
    kept = sorted({*edges, *values})
    clean = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in kept}
    plain = points.where(F.col(DATE).isNotNull()).select(KEY, DATE, *[c.alias(v) for v, c in clean.items()], *[c.alias(f"X_{n}") for n, c in terms.items()])
    month = F.year(DATE) * 12 + F.month(DATE)
    days = plain if laid_out else spread(plain, KEY)
    along = Window.partitionBy(KEY).orderBy(DATE)
    days = days.withColumns({"MONTH": month, "PREV": F.lag(DATE).over(along), "NEXT": F.lead(DATE).over(along)}).withColumns({f"LOW_{v}": f.low(v) for v in values})

    raw = days.drop("PREV", "NEXT")

    up, down = _up(KEY, "MONTH"), _down(KEY, "MONTH")
    behind = _down(KEY, "MONTH", skip=True)
    days = days.withColumns({f"TOP_{v}": F.max(v).over(up) for v in values})
    days = days.withColumns({f"FALL_{v}": f.fall(F.col(f"LOW_{v}"), F.col(f"TOP_{v}")) for v in values})
    front = {f"E_{n}": F.sum(f"X_{n}").over(up) for n in terms} | {f"EL_{v}": F.min(f"LOW_{v}").over(up) for v in values} | {f"EB_{v}": F.max(f"FALL_{v}").over(up) for v in values}
    days = days.withColumns(front).withColumns({f"AFTER_{v}": F.min(f"LOW_{v}").over(down) for v in values})
    days = days.withColumns({f"DROP_{v}": f.fall(F.col(f"AFTER_{v}"), F.col(v)) for v in values})
    side = lambda x: behind if x.open else down
    back = {f"S_{n}": F.sum(f"X_{n}").over(behind) for n in terms} | {f"SB_{n}": F.max(f"DROP_{x.value}").over(side(x)) for n, x in falls.items()} | {f"SH_{n}": F.max(x.value).over(side(x)) for n, x in falls.items()}
    days = days.withColumns(back)

    # a row for each month, which also lists the days at which windows start and end: the only pass over the days with their running windows
    days = _marked(days, spans, strict)
    own = ["PREV", "NEXT", DATE]
    marks = lambda flag, columns: F.collect_list(F.when(F.col(flag), F.struct(*own, *edges, *columns)))
    whole = [F.sum(f"X_{n}").alias(f"X_{n}") for n in terms] + [F.max(v).alias(f"MH_{v}") for v in values] + [F.min(f"LOW_{v}").alias(f"ML_{v}") for v in values] + [F.max(f"FALL_{v}").alias(f"MB_{v}") for v in values]
    months = days.groupBy(KEY, "MONTH").agg(*whole, marks("_START", back).alias("_STARTS"), marks("_END", front).alias("_ENDS"))
    months = cut_lineage(months.withColumn("PREV_MONTH", F.lag("MONTH").over(Window.partitionBy(KEY).orderBy("MONTH"))))
    started = months.select(KEY, F.col("MONTH").alias("S_MONTH"), F.inline("_STARTS"))
    ended = months.select(KEY, F.col("MONTH").alias("E_MONTH"), F.inline("_ENDS"))
    last = spans.select("WIN_END").distinct()
    if strict:
        started, ended = started.join(spans, F.col(DATE) == F.col("WIN_START")), ended.join(last, F.col(DATE) == F.col("WIN_END"))
    else:
        limits = F.broadcast(spans.agg(F.min("WIN_START").alias("_LOW"), F.max("WIN_END").alias("_HIGH")))  # one row
        covers = lambda a, b: F.explode(F.when(a <= b, F.sequence(a, b)))
        day = F.col(DATE)
        started = started.join(limits).withColumn("WIN_START", covers(F.coalesce(F.date_add("PREV", 1), F.least("_LOW", day)), day)).join(spans, "WIN_START")
        ended = ended.join(limits).withColumn("WIN_END", covers(day, F.coalesce(F.date_sub("NEXT", 1), F.greatest("_HIGH", day)))).join(last, "WIN_END")
    starts = started.select(KEY, *SPAN, F.col(DATE).alias("START_DATE"), F.col("NEXT").alias("SECOND_DATE"), "S_MONTH", *[F.col(e).alias(f"FIRST_{e}") for e in edges], *back)
    ends = ended.select(KEY, "WIN_END", F.col(DATE).alias("LAST_DATE"), "E_MONTH", *[F.col(e).alias(f"LAST_{e}") for e in edges], *front)
    asked = starts.join(ends, [KEY, "WIN_END"]).where("START_DATE <= LAST_DATE")

    # whole months between them: from each month to each last month that is asked for
    long = asked.where("S_MONTH < E_MONTH").groupBy(KEY, "E_MONTH").agg(F.min("S_MONTH").alias("_FROM"))
    between = months.join(long, KEY).where((F.col("MONTH") > F.col("_FROM")) & (F.col("MONTH") < F.col("E_MONTH")))
    later, on = _down(KEY, "E_MONTH", order="MONTH", skip=True), _down(KEY, "E_MONTH", order="MONTH")
    between = between.withColumns({f"MB_{v}": _greatest(F.col(f"MB_{v}"), f.fall(F.min(f"ML_{v}").over(later), F.col(f"MH_{v}"))) for v in values})
    runs = {f"M_{n}": F.sum(f"X_{n}").over(on) for n in terms} | {f"{p}_{v}": g(f"{p}_{v}").over(on) for v in values for p, g in (("MH", F.max), ("ML", F.min), ("MB", F.max))}
    between = between.select(KEY, "E_MONTH", F.col("PREV_MONTH").alias("S_MONTH"), *[c.alias(n) for n, c in runs.items()])

    # windows inside one month
    short = asked.where("S_MONTH = E_MONTH").select(KEY, *SPAN, F.col("START_DATE").alias("_A"), F.col("LAST_DATE").alias("_B"), F.col("S_MONTH").alias("MONTH"))
    some = spans.where(F.months_between(F.trunc("WIN_END", "month"), F.trunc("WIN_START", "month")) <= (0 if strict else 1200)).select((F.year("WIN_END") * 12 + F.month("WIN_END")).alias("MONTH")).distinct()
    raw = raw.join(some, "MONTH", "left_semi") if strict else raw
    # the months that hold such windows come to the days, which lie by entity: only days of these months travel
    few = spread(short.select(KEY, "MONTH"), KEY).groupBy(KEY).agg(F.collect_set("MONTH").alias("_MONTHS"))
    raw = raw.join(few, KEY).where(F.array_contains("_MONTHS", F.col("MONTH"))).drop("_MONTHS")
    inside = raw.join(short, [KEY, "MONTH"]).where(F.col(DATE).between(F.col("_A"), F.col("_B")))
    run = _up(KEY, *SPAN)
    counts = lambda x: F.when(F.col(DATE) > F.col("_A"), F.col(x.value)) if x.open else F.col(x.value)
    inside = inside.withColumns({f"T_{n}": F.max(counts(x)).over(run) for n, x in falls.items()})
    inside = inside.withColumns({f"B_{n}": F.when(counts(x).isNotNull(), f.fall(F.col(f"LOW_{x.value}"), F.col(f"T_{n}"))) for n, x in falls.items()})
    inside = inside.groupBy(KEY, *SPAN).agg(*[F.sum(F.when(F.col(DATE) > F.col("_A"), F.col(f"X_{n}"))).alias(f"I_{n}") for n in terms], *[F.max(f"B_{n}").alias(f"B_{n}") for n in falls], F.lit(True).alias("_SHORT"))

    found = asked.join(between, [KEY, "E_MONTH", "S_MONTH"], "left").join(inside, [KEY, *SPAN], "left")

    def total(n: str) -> Column:
        parts = [F.col(f"{p}_{n}") for p in "SME"]
        added = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
        return F.when(F.col("_SHORT"), F.col(f"I_{n}")).when(F.coalesce(*parts).isNotNull(), added)

    def deepest(n: str, x: Fall) -> Column:
        v = x.value
        crossed = [f.fall(F.col(low), F.col(high)) for low, high in ((f"ML_{v}", f"SH_{n}"), (f"EL_{v}", f"SH_{n}"), (f"EL_{v}", f"MH_{v}"))]
        return F.when(F.col("_SHORT"), F.col(f"B_{n}")).otherwise(F.greatest(F.col(f"SB_{n}"), F.col(f"MB_{v}"), F.col(f"EB_{v}"), *crossed))

    second = F.when(F.col("SECOND_DATE") <= F.col("LAST_DATE"), F.col("SECOND_DATE")).alias("SECOND_DATE")
    found = found.select(KEY, *SPAN, "START_DATE", "LAST_DATE", second, *[f"{p}_{e}" for e in edges for p in ("FIRST", "LAST")], *[total(n).alias(n) for n in terms], *[deepest(n, x).alias(f"_{n}") for n, x in falls.items()])
    out = found.select(*[c for c in found.columns if c not in {f"_{n}" for n in falls}], *[c.alias(f"{n}_{t}") for n in falls for t, c in (("DD", F.col(f"_{n}.dd")), ("DAY", f.day(f"_{n}")), ("PEAK", F.col(f"_{n}.peak")))])
    recovering = {n: x for n, x in falls.items() if x.back}
    out = cut_lineage(out) if recovering else out  # as many rows as the result, and read twice for each fall
    for n, x in recovering.items():
        out = _recovered(out, plain.select(KEY, DATE, month.alias("MONTH"), F.col(x.value).alias("_V")), months.select(KEY, "MONTH", F.col(f"MH_{x.value}").alias("_H")), n)
    return out


def _marked(days: DataFrame, spans: DataFrame, strict: bool) -> DataFrame:
    """Flags the days at which a window of the entity starts or ends; not ``strict``: the first day from a start on, the last up to an end."""
    starts, ends = spans.select("WIN_START").distinct(), spans.select("WIN_END").distinct()
    if strict:
        flagged = days.join(starts, F.col(DATE) == F.col("WIN_START"), "left").join(ends, F.col(DATE) == F.col("WIN_END"), "left")
        return flagged.withColumns({"_START": F.col("WIN_START").isNotNull(), "_END": F.col("WIN_END").isNotNull()}).drop(*SPAN)
    # by calendar day, the next start behind it and the next end from it on: as many rows as the windows' days
    limits = spans.agg(F.min("WIN_START").alias("a"), F.max("WIN_END").alias("b")).where("a IS NOT NULL")
    each = limits.select(F.explode(F.sequence(F.date_sub("a", 1), "b")).alias("_DAY"))
    back = Window.orderBy(F.desc("_DAY"))  # one task, bounded by the calendar
    marked = each.join(starts, F.col("_DAY") == F.col("WIN_START"), "left").join(ends, F.col("_DAY") == F.col("WIN_END"), "left")
    upto = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = back.rowsBetween(Window.unboundedPreceding, -1)
    following = marked.select("_DAY", F.min("WIN_START").over(before).alias("_S"), F.min("WIN_END").over(upto).alias("_E"))
    at_prev = following.select(F.col("_DAY").alias("_P"), "_S")
    flagged = days.join(limits.agg(F.min("a").alias("_A"), F.max("b").alias("_B")))
    flagged = flagged.join(at_prev, F.greatest(F.coalesce("PREV", F.date_sub("_A", 1)), F.date_sub("_A", 1)) == F.col("_P"), "left")
    flagged = flagged.join(following.select(F.col("_DAY").alias("_D"), "_E"), F.greatest(F.col(DATE), F.date_sub("_A", 1)) == F.col("_D"), "left")
    ends_here = (F.col("_E") < F.col("NEXT")) | F.col("NEXT").isNull()
    ended_before = F.col("NEXT").isNull() & (F.col("_B") >= F.col(DATE))
    return flagged.withColumns({"_START": F.coalesce(F.col("_S") <= F.col(DATE), F.lit(False)), "_END": F.coalesce(F.col("_E").isNotNull() & ends_here, F.lit(False)) | F.coalesce(ended_before, F.lit(False))}).drop("_A", "_B", "_P", "_D", "_S", "_E")


def _recovered(rows: DataFrame, days: DataFrame, months: DataFrame, n: str) -> DataFrame:
    """Adds ``n_BACK``: the first day behind the fall, and inside the window, at or above its peak.

    Windows share their falls, so each (entity, day, peak) is looked up once: first the month, then the day.
    """
    asked = rows.select(KEY, F.col(f"{n}_DAY").alias("_D"), F.col(f"{n}_PEAK").alias("_P")).where("_D IS NOT NULL").distinct()
    own = (F.year("_D") * 12 + F.month("_D")).alias("_M")
    asked = asked.select("*", own)
    later = asked.join(months, KEY).where("MONTH > _M AND _H >= _P").groupBy(KEY, "_D", "_P").agg(F.min("MONTH").alias("MONTH"))
    where = asked.select(KEY, "_D", "_P", F.col("_M").alias("MONTH")).union(later.select(KEY, "_D", "_P", "MONTH"))
    back = where.join(days, [KEY, "MONTH"]).where((F.col(DATE) > F.col("_D")) & (F.col("_V") >= F.col("_P"))).groupBy(KEY, "_D", "_P").agg(F.min(DATE).alias("_BACK"))
    joined = rows.join(back.withColumnsRenamed({"_D": f"{n}_DAY", "_P": f"{n}_PEAK"}), [KEY, f"{n}_DAY", f"{n}_PEAK"], "left")
    return joined.withColumn(f"{n}_BACK", F.when(F.col("_BACK") <= F.col("LAST_DATE"), F.col("_BACK"))).drop("_BACK")


def whole_segments(points: DataFrame, sums: Mapping[str, Column], falls: Mapping[str, Fall], edges: Sequence[str], first: bool = False, more: Sequence[Column] = ()) -> DataFrame:
    """The same over an entity's whole history, one window each; ``more``: further aggregates of the days."""
    f = _Falls(first)
    values = sorted({x.value for x in falls.values()})
    clean = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in {*edges, *values}}
    days = points.where(F.col(DATE).isNotNull()).withColumns(clean).withColumns({f"X_{n}": c.cast("double") for n, c in sums.items()})
    all_days = Window.partitionBy(KEY)
    days = days.withColumns({"PREV": F.lag(DATE).over(all_days.orderBy(DATE))})
    counts = lambda x: F.when(F.col("PREV").isNotNull(), F.col(x.value)) if x.open else F.col(x.value)
    days = days.withColumns({f"T_{n}": F.max(counts(x)).over(_up(KEY)) for n, x in falls.items()})
    days = days.withColumns({f"B_{n}": F.max(F.when(counts(x).isNotNull(), f.fall(f.low(x.value), F.col(f"T_{n}")))).over(all_days) for n, x in falls.items()})
    days = days.withColumns({f"{n}_DAY": f.day(f"B_{n}") for n in falls})
    behind = F.col("PREV").isNotNull()
    aggs = [F.min(DATE).alias("START_DATE"), F.max(DATE).alias("LAST_DATE"), F.min(F.when(behind, F.col(DATE))).alias("SECOND_DATE")]
    aggs += [g(e, DATE).alias(f"{p}_{e}") for e in edges for p, g in (("FIRST", F.min_by), ("LAST", F.max_by))]
    aggs += [F.sum(F.when(behind, F.col(f"X_{n}"))).alias(n) for n in sums]
    for n, x in falls.items():
        later = (F.col(DATE) > F.col(f"{n}_DAY")) & (F.col(x.value) >= F.col(f"B_{n}.peak"))
        aggs += [F.max(f"B_{n}.dd").alias(f"{n}_DD"), F.max(f"{n}_DAY").alias(f"{n}_DAY"), F.max(f"B_{n}.peak").alias(f"{n}_PEAK"), F.min(F.when(later, F.col(DATE))).alias(f"{n}_BACK")]
    found = days.groupBy(KEY).agg(*aggs, *more)
    return found.withColumns({"WIN_START": F.col("START_DATE"), "WIN_END": F.col("LAST_DATE")})
