"""Return and risk statistics of every entity over every look-back window.

Two flavours are kept because they disagree on purpose: ``panel`` (percent units, last drawdown date, recovery on or after it)
feeds the stored tables; ``classic`` (fractions, first drawdown date, recovery strictly after it) feeds backtests and reports.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from navloom.functions.exprs import clip_overflow, safe_div
from navloom.operators.joins import fan_out
from navloom.operators.segments import Fall, whole_segments, window_segments
from navloom.session import pin_small

KEY, DATE, NAV = "TICKER_SYMBOL", "END_DATE", "NAV"
GROUP = [KEY, "WIN_START", "WIN_END"]
NEVER_RECOVERED = 99999  # fixed value: recovery days of a drawdown that has not recovered
YEAR_DAYS, TRADING_DAYS = 365, 252  # fixed values


def typed_panel(df: DataFrame, key: str = KEY, date: str = DATE, nav: str = NAV) -> DataFrame:
    """The three columns of a NAV panel in their types."""
    return df.select(F.col(key).cast("string").alias(KEY), F.col(date).cast("date").alias(DATE), F.col(nav).cast("double").alias(NAV))


def annualise(total: Column, days: Column) -> Column:
    """Total return (fraction) to a yearly rate; null when no day has passed."""
    return F.when(days > 0, F.pow(1 + total, YEAR_DAYS / days) - 1)


def whole_span(panel: DataFrame) -> DataFrame:
    """One window per entity: its whole history."""
    w = Window.partitionBy(KEY)
    return panel.withColumns({"WIN_START": F.min(DATE).over(w), "WIN_END": F.max(DATE).over(w)})


def _ordered() -> Window:
    return Window.partitionBy(*GROUP).orderBy(DATE)


def daily_points(fanned: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Adds ``RET`` and ``DD`` (fractions) and the previous date inside the window."""
    w = w or _ordered()
    high = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return fanned.withColumns(
        {
            "PREV_DATE": F.lag(DATE).over(w),
            "RET": safe_div(F.col(NAV), F.lag(NAV).over(w)) - 1,
            "DD": 1 - safe_div(F.col(NAV), F.max(NAV).over(high)),
        }
    )


def daily_return(panel: DataFrame) -> DataFrame:
    w = Window.partitionBy(KEY).orderBy(DATE)
    return panel.select(KEY, DATE, ((safe_div(F.col(NAV), F.lag(NAV).over(w)) - 1) * 100).alias("DAILY_RETURN"))


def daily_drawdown(panel: DataFrame) -> DataFrame:
    w = Window.partitionBy(KEY).orderBy(DATE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return panel.select(KEY, DATE, ((1 - safe_div(F.col(NAV), F.max(NAV).over(w))) * 100).alias("DAILY_DRAWDOWN"))


def with_drawdown_dates(points: DataFrame, dd: str = "DD", classic: bool = False, prefix: str = "") -> DataFrame:
    """Adds the deepest drawdown and its date to every point (same partitioning, no further shuffle)."""
    g = Window.partitionBy(*GROUP)
    deepest = points.withColumn(f"{prefix}MDD", F.max(dd).over(g))
    hit = F.col(dd) == F.col(f"{prefix}MDD")
    if not classic:
        hit = hit & (F.col(f"{prefix}MDD") != 0)
    pick = F.min if classic else F.max
    return deepest.withColumn(f"{prefix}MDD_DATE", pick(F.when(hit, F.col(DATE))).over(g))


def _recovery(dd: str, prefix: str, classic: bool) -> Column:
    later = F.col(DATE) > F.col(f"{prefix}MDD_DATE") if classic else F.col(DATE) >= F.col(f"{prefix}MDD_DATE")
    return F.min(F.when(later & (F.col(dd) == 0), F.col(DATE)))


def _days() -> Column:
    return F.greatest(F.lit(0), F.datediff("LAST_DATE", "SECOND_DATE") + 1)


def _recover_days() -> Column:
    return F.coalesce(F.datediff("RECOVERY_DATE", "MDD_DATE"), F.lit(NEVER_RECOVERED))


def _moves(panel: DataFrame) -> DataFrame:
    """A panel with the return to the entity's previous day."""
    typed = typed_panel(panel).withColumn(NAV, F.when(~F.isnan(NAV), F.col(NAV)))
    return typed.withColumn("RET", safe_div(F.col(NAV), F.lag(NAV).over(Window.partitionBy(KEY).orderBy(DATE))) - 1)


def _count(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0))


def deviation(n: str, total: str, squares: str) -> Column:
    """Sample deviation from a count, a sum and a sum of squares."""
    rest = F.col(squares) - safe_div(F.col(total) * F.col(total), F.col(n))
    return F.when(F.col(n) > 1, F.sqrt(safe_div(F.greatest(rest, F.lit(0.0)), F.col(n) - 1)))


def _return_sums() -> dict[str, Column]:
    ret = F.col("RET")
    return {"N_RET": _count(ret.isNotNull()), "S_RET": ret, "SS_RET": ret * ret, "N_UP": _count(ret > 0)}


def window_rows(panel: DataFrame, windows: DataFrame | None, strict: bool, classic: bool, at_risk: bool = False) -> DataFrame:
    """What the statistics of a (entity, window) are made of, one row each.

    Whole histories are running windows and aggregates.  Look-back windows are read off suffix scans, one for each end (:func:`_scanned`): a
    shuffle by entity, then numpy over its days.  More than ``SPANS`` windows are merged from segments of months instead
    (:mod:`navloom.operators.segments`), the same rows without any list of windows.  ``at_risk`` adds the 5 per cent quantile of the
    returns, which neither a scan nor a segment has: there the days are counted for every window.
    """
    points = _moves(panel)
    falls = {"FALL": Fall(NAV)}
    if windows is None:
        tail = [F.percentile("RET", 0.05).alias("VALUE_AT_RISK")] if at_risk else []
        rows = whole_segments(points, _return_sums(), falls, [NAV], classic, [F.stddev_samp("RET").alias("VOL"), *tail])
    else:
        spans = windows.select("START_DATE", "END_DATE").where("START_DATE <= END_DATE").distinct()
        pinned = pin_small(spans, SPANS)
        rows = window_segments(points, spans, _return_sums(), falls, [NAV], strict, classic) if pinned is None else _scanned_rows(panel, pinned, strict, classic)
        rows = rows.withColumn("VOL", deviation("N_RET", "S_RET", "SS_RET"))
        if at_risk:
            inside = fan_out(points, windows).join(rows.select(*GROUP, F.col("START_DATE").alias("_A")), GROUP).where(F.col(DATE) > F.col("_A"))
            rows = rows.join(inside.groupBy(*GROUP).agg(F.percentile("RET", 0.05).alias("VALUE_AT_RISK")), GROUP, "left")
    fell = F.lit(True) if classic else F.col("FALL_DD") != 0
    own = {"N_RET": F.coalesce("N_RET", F.lit(0.0)), "MDD": F.col("FALL_DD"), "MDD_DATE": F.when(fell, F.col("FALL_DAY")), "RECOVERY_DATE": F.when(fell, F.col("FALL_BACK")), "WIN_RATE": safe_div(F.coalesce("N_UP", F.lit(0.0)), F.col("N_RET"))}
    return rows.withColumns(own).drop("FALL_DD", "FALL_DAY", "FALL_PEAK", "FALL_BACK")


SPANS = 200_000  # windows whose list goes to the tasks (3 MB); more are merged from segments
_DAYS = ["WIN_START", "WIN_END", "START_DATE", "LAST_DATE", "SECOND_DATE", "FALL_DAY", "FALL_BACK"]
_NUMBERS = ["FIRST_NAV", "LAST_NAV", "N_RET", "S_RET", "SS_RET", "N_UP", "FALL_DD"]


def _scanned_rows(panel: DataFrame, spans: DataFrame, strict: bool, classic: bool) -> DataFrame:
    """The windows of every entity by suffix scans; an entity has at most one row a day, which bounds a task's memory by the calendar."""
    epoch = F.lit("1970-01-01").cast("date")
    days = panel.select(F.col(KEY).cast("string").alias(KEY), F.datediff(DATE, epoch).alias("DAY"), F.col(NAV).cast("double").alias("NAV")).where("DAY IS NOT NULL")
    table = spans.select(F.datediff("END_DATE", epoch).alias("B"), F.datediff("START_DATE", epoch).alias("A")).orderBy("B", "A").toPandas()
    wanted = table[["A", "B"]].to_numpy(dtype=np.int64)
    schema = f"{KEY} string, " + ", ".join([f"{c} int" for c in _DAYS] + [f"{c} double" for c in _NUMBERS])

    def entity(tag: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(frame["DAY"].to_numpy(), kind="stable")
        out = _scanned(frame["DAY"].to_numpy(dtype=np.int64)[order], frame["NAV"].to_numpy(dtype=np.float64)[order], wanted, strict, classic)
        return pd.DataFrame({KEY: pd.Series([tag[0]] * len(out["WIN_END"]), dtype=object)} | out)

    rows = days.groupBy(KEY).applyInPandas(entity, schema)
    dates = [F.when(F.col(c) != int(NO_DAY), F.date_add(epoch, c)).alias(c) for c in _DAYS]
    return rows.select(KEY, *dates, *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in _NUMBERS])


NO_DAY = np.iinfo(np.int32).max


def _quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, not a number where b is 0 or missing."""
    return np.divide(a, b, out=np.full(len(a), np.nan), where=(b != 0) & ~np.isnan(b))


def _from_here(a: np.ndarray, of: np.ufunc) -> np.ndarray:
    return of.accumulate(a[::-1])[::-1]


def _latest(mark: np.ndarray) -> np.ndarray:
    """For each place the nearest marked place from there on."""
    return _from_here(np.where(mark, np.arange(len(mark)), len(mark)), np.minimum)


def _scanned(days: np.ndarray, nav: np.ndarray, spans: np.ndarray, strict: bool, classic: bool) -> dict[str, np.ndarray]:
    """All windows over one entity's sorted days, a scan backwards from each end.

    From an end back, the sums, the lowest value to come and the deepest fall from each day are running figures, so all windows with
    that end are read off at their first days; their number and length do not matter.
    """
    first, last = np.searchsorted(days, spans[:, 0]), np.searchsorted(days, spans[:, 1], side="right") - 1
    there = first <= last
    if strict:
        there &= (days[np.minimum(first, len(days) - 1)] == spans[:, 0]) & (days[np.maximum(last, 0)] == spans[:, 1])
    spans, first, last = spans[there], first[there], last[there]
    ret = np.concatenate(([np.nan], _quotient(nav[1:], nav[:-1]) - 1))
    known = ~np.isnan(ret)
    plain = np.where(known, ret, 0.0)
    out = {c: np.full(len(spans), np.nan) for c in _NUMBERS} | {c: np.full(len(spans), NO_DAY, dtype=np.int64) for c in _DAYS}
    out |= {"WIN_START": spans[:, 0], "WIN_END": spans[:, 1], "START_DATE": days[first], "LAST_DATE": days[last], "FIRST_NAV": nav[first], "LAST_NAV": nav[last]}
    more = last > first
    out["SECOND_DATE"] = np.where(more, days[np.minimum(first + 1, len(days) - 1)], NO_DAY)
    for j in np.unique(last):
        rows = np.flatnonzero(last == j)
        low = int(first[rows].min())
        at = first[rows] - low
        part, r = nav[low : j + 1], plain[low : j + 1]
        sums = {"N_RET": known[low : j + 1].astype(float), "S_RET": r, "SS_RET": r * r, "N_UP": (r > 0).astype(float)}
        for name, x in sums.items():
            out[name][rows] = _from_here(np.append(x[1:], 0.0), np.add)[at]
        lowest = _from_here(part, np.fmin)
        beyond = np.append(lowest[1:], np.inf)
        fresh = part <= beyond if classic else part < beyond
        trough = _latest(fresh & ~np.isnan(part) | (np.isnan(beyond) & ~np.isnan(part)))
        fall = 1 - _quotient(lowest, part)
        deepest = _from_here(fall, np.fmax)
        after = np.append(deepest[1:], np.nan)
        peak = _latest(~np.isnan(fall) & (np.isnan(after) | (fall >= after if classic else fall > after)))[at]
        out["FALL_DD"][rows] = deepest[at]
        for p in np.unique(peak[peak < len(part)]):
            mine = rows[peak == p]
            u = int(trough[p])
            out["FALL_DAY"][mine] = days[low + u]
            back = np.flatnonzero(part[u + 1 :] >= part[p])
            if len(back):
                out["FALL_BACK"][mine] = days[low + u + 1 + int(back[0])]
    return {c: out[c] for c in (*_DAYS, *_NUMBERS)}


def window_stats(panel: DataFrame, windows: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Panel statistics row per (entity, window).  ``windows`` has ``START_DATE, END_DATE``; None = whole history."""
    rows = window_rows(panel, windows, strict, classic=False)
    cum = safe_div(F.col("LAST_NAV"), F.col("FIRST_NAV")) - 1
    out = rows.select(
        KEY,
        "START_DATE",
        F.col("LAST_DATE").alias(DATE),
        _days().alias("OPERATION_DAYS"),
        (cum * 100).alias("CUM_RETURN"),
        (annualise(cum, _days()) * 100).alias("ANNUAL_RETURN"),
        (F.col("VOL") * 100).alias("VOLATILITY"),
        (F.col("VOL") * 100 * F.sqrt(F.lit(TRADING_DAYS))).alias("ANNUAL_VOLATILITY"),
        (F.col("MDD") * 100).alias("MAXDD"),
        _recover_days().alias("MAXDD_RECOVER"),
        F.col("MDD_DATE").alias("MAXDD_DATE"),
        F.col("RECOVERY_DATE").alias("MAXDD_RECOVERY_DATE"),
    )
    out = out.withColumns(
        {
            "SHARP_RATIO": safe_div(F.col("CUM_RETURN"), F.col("VOLATILITY")),
            "SHARP_RATIO_ANNUAL": safe_div(F.col("ANNUAL_RETURN"), F.col("ANNUAL_VOLATILITY")),
            "CALMAR_RATIO_ANNUAL": safe_div(F.col("ANNUAL_RETURN"), F.col("MAXDD")),
        }
    )
    return out.withColumns({c: clip_overflow(F.col(c)) for c, t in out.dtypes if t == "double"})


STORED = [
    KEY, "START_DATE", DATE, "CUM_RETURN", "ANNUAL_RETURN", "VOLATILITY", "ANNUAL_VOLATILITY", "MAXDD", "MAXDD_RECOVER",
    "MAXDD_DATE", "SHARP_RATIO", "SHARP_RATIO_ANNUAL", "CALMAR_RATIO_ANNUAL",
]  # fixed values: stored column names


def named_stats(stats: DataFrame, windows: DataFrame) -> DataFrame:
    """Attach the labels of every window that shares the (START, END) span."""
    labels = windows.select("DATE_NAME", "START_DATE", "END_DATE").distinct()
    return stats.join(labels, ["START_DATE", "END_DATE"])


def wide_by_period(named: DataFrame, indicators: Sequence[str], periods: Sequence[str]) -> DataFrame:
    """``END_DATE, TICKER_SYMBOL, INDICATOR`` by period columns."""
    long = named.unpivot([DATE, KEY, "DATE_NAME"], list(indicators), "INDICATOR", "VALUE")
    return long.groupBy(DATE, KEY, "INDICATOR").agg(*[F.max(F.when(F.col("DATE_NAME") == p, F.col("VALUE"))).alias(p) for p in periods])


# --- classic flavour -------------------------------------------------------------------------------------------------


def _nz(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def classic_stats(panel: DataFrame, windows: DataFrame | None = None, risk_free: float = 0.0, strict: bool = False, at_risk: bool = True) -> DataFrame:
    """Classic statistics without a benchmark; fractions, missing ratios count as 0.  ``at_risk``: with ``VALUE_AT_RISK``."""
    rows = window_rows(panel, windows, strict, classic=True, at_risk=at_risk)
    cum = _nz(safe_div(F.col("LAST_NAV"), F.col("FIRST_NAV")) - 1)
    return (
        rows.where(F.col("N_RET") > 0)
        .select(
            *GROUP,
            "START_DATE",
            F.col("LAST_DATE").alias(DATE),
            cum.alias("CUM_RETURN"),
            annualise(cum, _days()).alias("ANNUAL_RETURN"),
            F.col("VOL").alias("VOLATILITY"),
            _nz(F.col("VOL") * F.sqrt(F.lit(TRADING_DAYS))).alias("ANNUAL_VOLATILITY"),
            F.col("MDD").alias("MAXDD"),
            F.col("MDD_DATE").alias("MAXDD_DATE"),
            _recover_days().alias("MAXDD_RECOVER"),
            "WIN_RATE",
            *(["VALUE_AT_RISK"] if at_risk else []),
        )
        .withColumns(
            {
                "SHARP_RATIO": _nz(safe_div(F.col("ANNUAL_RETURN") - risk_free, F.col("ANNUAL_VOLATILITY"))),
                "CALMAR_RATIO": _nz(safe_div(F.col("ANNUAL_RETURN"), F.col("MAXDD"))),
            }
        )
    )


def pair_points(panel: DataFrame) -> DataFrame:
    """Points of entity and benchmark side by side over whole histories; ``panel`` also has ``BENCH_NAV``.

    An entity is its only window, so its days are sorted once, and the window's ends are added to the sorted rows.
    """
    w = Window.partitionBy(KEY).orderBy(DATE)
    prev_b = F.lag("BENCH_NAV").over(w)
    points = daily_points(panel, w).withColumns(
        {
            "BRET": safe_div(F.col("BENCH_NAV"), prev_b) - 1,
            "BDD": 1 - safe_div(F.col("BENCH_NAV"), F.max("BENCH_NAV").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))),
            "T": F.row_number().over(w) - 1,
        }
    )
    points = points.withColumns({"LR": F.log1p("RET"), "LB": F.log1p("BRET"), "ALPHA": F.col("RET") - F.col("BRET")})
    points = points.withColumn("LA", F.col("LR") - F.col("LB"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    points = points.withColumns(
        {"CUM_LR": F.sum("LR").over(run), "CUM_LA": F.sum("LA").over(run), "ALPHA_NAV": F.when(F.col("ALPHA").isNotNull(), F.product(1 + F.coalesce(F.col("ALPHA"), F.lit(0.0))).over(run))}
    )
    return whole_span(points.withColumn("ADD", 1 - safe_div(F.col("ALPHA_NAV"), F.max("ALPHA_NAV").over(run))))


def _capture(side: Column, n: str) -> tuple[Column, Column, Column]:
    return (
        F.sum(F.when(side, F.col("LR"))).alias(f"{n}_LR"),
        F.sum(F.when(side, F.col("LB"))).alias(f"{n}_LB"),
        F.count(F.when(side, F.lit(1))).alias(f"{n}_N"),
    )


def _capture_ratio(n: str) -> Column:
    def yearly(c: str) -> Column:
        return F.exp(F.col(f"{n}_{c}") * TRADING_DAYS / F.col(f"{n}_N")) - 1

    return F.when(F.col(f"{n}_N") > 0, safe_div(yearly("LR"), yearly("LB")))


def _benchmark_rows(panel: DataFrame) -> DataFrame:
    """Whole histories: what the benchmark statistics are made of."""
    points = with_drawdown_dates(pair_points(panel), "ADD", classic=True, prefix="A")
    return points.groupBy(*GROUP).agg(
        F.max(DATE).alias("LAST_DATE"),
        F.min(F.when(F.col("PREV_DATE").isNotNull(), F.col(DATE))).alias("SECOND_DATE"),
        F.min_by(NAV, DATE).alias("F0"),
        F.max_by(NAV, DATE).alias("F1"),
        F.min_by("BENCH_NAV", DATE).alias("B0"),
        F.max_by("BENCH_NAV", DATE).alias("B1"),
        F.stddev_samp("BRET").alias("BVOL"),
        F.max("BDD").alias("BENCH_MAXDD"),
        F.max("DD").alias("OWN_MAXDD"),
        F.sum("LA").alias("SUM_LA"),
        F.stddev_samp("ALPHA").alias("AVOL"),
        *_capture(F.col("BRET") > 0, "UP"),
        *_capture(F.col("BRET") < 0, "DOWN"),
        F.regr_r2("CUM_LR", "T").alias("STABILITY"),
        F.sum(F.col("T") * F.col("CUM_LA")).alias("TY"),
        F.sum(F.when(F.col("CUM_LA").isNotNull(), F.col("T") * F.col("T"))).alias("TT"),
        F.sum(F.col("CUM_LA") * F.col("CUM_LA")).alias("YY"),
        F.avg(F.when(F.col("LA") > 0, 1.0).when(F.col("LA").isNotNull(), 0.0)).alias("ALPHA_WIN_RATE"),
        F.first("AMDD").alias("ALPHA_MAXDD"),
        F.first("AMDD_DATE").alias("AMDD_DATE"),
        _recovery("ADD", "A", True).alias("ARECOVERY"),
    )


def _pair_moves(panel: DataFrame) -> DataFrame:
    """Returns of entity and benchmark, their running logs ``C`` (entity) and ``A`` (excess), the excess value ``P`` and the row number ``T``.

    Inside a window the running figures are these less, or divided by, their values at its first day."""
    w = Window.partitionBy(KEY).orderBy(DATE)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ret = lambda c: safe_div(F.col(c), F.lag(c).over(w)) - 1
    points = panel.withColumns({"RET": ret(NAV), "BRET": ret("BENCH_NAV"), "T": (F.row_number().over(w) - 1).cast("double")})
    points = points.withColumns({"LR": F.log1p("RET"), "LB": F.log1p("BRET"), "ALPHA": F.col("RET") - F.col("BRET")}).withColumn("LA", F.col("LR") - F.col("LB"))
    alpha = F.product(1 + F.coalesce(F.col("ALPHA"), F.lit(0.0))).over(run)
    total = lambda c: F.coalesce(F.sum(c).over(run), F.lit(0.0))
    return points.withColumns({"C": total("LR"), "A": total("LA"), "P": F.when(F.col("ALPHA").isNotNull(), alpha)})


#: Sums and falls that a column of ``benchmark_stats`` over windows is made of.
_EXCESS, _CAPTURED = ["N_AL", "S_AL", "SS_AL", "SUM_LA"], [f"{n}_{x}" for n in ("UP", "DOWN") for x in ("LR", "LB", "N")]
_MADE_OF = {
    "BENCH_CUM_RETURN": [], "BENCH_ANNUAL_RETURN": [], "ALPHA": [], "ANNUAL_ALPHA": [],
    "BENCH_ANNUAL_VOLATILITY": ["N_B", "S_B", "SS_B"], "BENCH_MAXDD": ["BENCH"], "IR": _EXCESS,
    "UP_CAPTURE": _CAPTURED, "DOWN_CAPTURE": _CAPTURED, "UP_DOWN_CAPTURE": _CAPTURED,
    "STABILITY": ["N", "ST", "STT", "SC", "SCC", "STC"], "ALPHA_STABILITY": ["N", "ST", "STT", "SA", "SAA", "STA"],
    "ALPHA_WIN_RATE": ["N_LA", "N_LA_UP"], "ALPHA_MAXDD": ["EXCESS"], "ALPHA_MAXDD_RECOVER": ["EXCESS"],
}


def _benchmark_window_rows(panel: DataFrame, windows: DataFrame, strict: bool, columns: Sequence[str]) -> DataFrame:
    """The same for look-back windows, merged from segments; sums of products about a window's first day follow from those about zero.

    Only what ``columns`` are made of is summed up; the rest is null."""
    col = F.col
    sums = {"N": F.lit(1.0), "N_B": _count(col("BRET").isNotNull()), "S_B": col("BRET"), "SS_B": col("BRET") * col("BRET"), "N_AL": _count(col("ALPHA").isNotNull()), "S_AL": col("ALPHA"), "SS_AL": col("ALPHA") * col("ALPHA")}
    sums |= {"SUM_LA": col("LA"), "N_LA": _count(col("LA").isNotNull()), "N_LA_UP": _count(col("LA") > 0)}
    for n, side in (("UP", col("BRET") > 0), ("DOWN", col("BRET") < 0)):
        sums |= {f"{n}_LR": F.when(side, col("LR")), f"{n}_LB": F.when(side, col("LB")), f"{n}_N": _count(side)}
    sums |= {"ST": col("T"), "STT": col("T") * col("T")}
    for x in "CA":
        sums |= {f"S{x}": col(x), f"S{x}{x}": col(x) * col(x), f"ST{x}": col("T") * col(x)}
    falls = {"BENCH": Fall("BENCH_NAV", back=False), "EXCESS": Fall("P", open=True, back="ALPHA_MAXDD_RECOVER" in columns)}
    used = {x for c in columns for x in _MADE_OF[c]}
    rows = window_segments(_pair_moves(panel), windows, {n: c for n, c in sums.items() if n in used}, {n: x for n, x in falls.items() if n in used}, [NAV, "BENCH_NAV", "T", "A"], strict, first=True, laid_out=True)
    empty = dict.fromkeys(sums, "double") | {"BENCH_DD": "double", "EXCESS_DD": "double", "EXCESS_DAY": "date", "EXCESS_BACK": "date"}
    rows = rows.withColumns({n: F.lit(None).cast(t) for n, t in empty.items() if n not in rows.columns})
    n, t0, a0 = col("N"), col("FIRST_T"), col("FIRST_A")
    tt, cc, tc = (col(f"S{a}{b}") - safe_div(col(f"S{a}") * col(f"S{b}"), n) for a, b in ("TT", "CC", "TC"))
    level = cc <= 1e-13 * col("SCC")  # a flat line: what is left is rounding
    return rows.withColumns(
        {
            "F0": col(f"FIRST_{NAV}"),
            "F1": col(f"LAST_{NAV}"),
            "B0": col("FIRST_BENCH_NAV"),
            "B1": col("LAST_BENCH_NAV"),
            "BVOL": deviation("N_B", "S_B", "SS_B"),
            "AVOL": deviation("N_AL", "S_AL", "SS_AL"),
            "BENCH_MAXDD": col("BENCH_DD"),
            "STABILITY": F.when(n > 1, F.when(level, F.lit(1.0)).otherwise(safe_div(tc * tc, tt * cc))),
            "TY": col("STA") - t0 * col("SA") - a0 * col("ST") + n * t0 * a0,
            "TT": col("STT") - 2 * t0 * col("ST") + n * t0 * t0,
            "YY": col("SAA") - 2 * a0 * col("SA") + n * a0 * a0,
            "ALPHA_WIN_RATE": safe_div(F.coalesce("N_LA_UP", F.lit(0.0)), col("N_LA")),
            "ALPHA_MAXDD": col("EXCESS_DD"),
            "AMDD_DATE": col("EXCESS_DAY"),
            "ARECOVERY": col("EXCESS_BACK"),
        }
    )


def benchmark_stats(panel: DataFrame, windows: DataFrame | None = None, strict: bool = False, columns: Sequence[str] = tuple(_MADE_OF), own: bool = False) -> DataFrame:
    """Everything that needs a benchmark, or the named ``columns`` of it, one row per (entity, window) with at least two days.

    ``own``: beside whole histories, the entity's ``ANNUAL_RETURN`` and ``MAXDD`` as in :func:`classic_stats`, from the same pass."""
    if own and windows is not None:
        raise ValueError("the entity's own statistics stand beside whole histories only")
    rows = _benchmark_rows(panel) if windows is None else _benchmark_window_rows(panel, windows, strict, columns)
    days = F.greatest(F.lit(0), F.datediff("LAST_DATE", "SECOND_DATE") + 1)
    cum, bcum = safe_div(F.col("F1"), F.col("F0")) - 1, safe_div(F.col("B1"), F.col("B0")) - 1
    up, down = _capture_ratio("UP"), _capture_ratio("DOWN")
    found = rows.where(F.col("SECOND_DATE").isNotNull()).select(
        *GROUP,
        bcum.alias("BENCH_CUM_RETURN"),
        annualise(bcum, days).alias("BENCH_ANNUAL_RETURN"),
        (F.col("BVOL") * F.sqrt(F.lit(TRADING_DAYS))).alias("BENCH_ANNUAL_VOLATILITY"),
        "BENCH_MAXDD",
        (cum - bcum).alias("ALPHA"),
        _nz(annualise(cum - bcum, days)).alias("ANNUAL_ALPHA"),
        _nz(safe_div(annualise(F.exp("SUM_LA") - 1, days), F.col("AVOL") * F.sqrt(F.lit(TRADING_DAYS)))).alias("IR"),
        _nz(up).alias("UP_CAPTURE"),
        _nz(down).alias("DOWN_CAPTURE"),
        _nz(safe_div(up, down)).alias("UP_DOWN_CAPTURE"),
        _nz(F.col("STABILITY")).alias("STABILITY"),
        safe_div(F.col("TY") * F.col("TY"), F.col("TT") * F.col("YY")).alias("ALPHA_STABILITY"),
        "ALPHA_WIN_RATE",
        "ALPHA_MAXDD",
        F.coalesce(F.datediff("ARECOVERY", "AMDD_DATE"), F.lit(NEVER_RECOVERED)).alias("ALPHA_MAXDD_RECOVER"),
        *([annualise(_nz(cum), days).alias("ANNUAL_RETURN"), F.col("OWN_MAXDD").alias("MAXDD")] if own else []),
    )
    return found.select(*GROUP, *columns, *(["ANNUAL_RETURN", "MAXDD"] if own else []))


def timing_models(panel: DataFrame, windows: DataFrame | None = None, risk_free: float = 0.03, strict: bool = False) -> DataFrame:
    """Two timing regressions of excess return on benchmark excess: quadratic, and up/down beta.

    Both have two regressors, so their coefficients follow from the second moments Spark aggregates natively.
    """
    rf = risk_free / TRADING_DAYS
    points = (pair_points(panel) if windows is None else _pair_moves(panel)).withColumns({"Y": F.col("RET") - rf, "X": F.col("BRET") - rf})
    points = points.withColumns({"X2": F.col("X") * F.col("X"), "XN": F.least(F.col("X"), F.lit(0.0)), "XP": F.greatest(F.col("X"), F.lit(0.0))})
    pairs = {"Q": ("X", "X2"), "P": ("XN", "XP")}
    if windows is None:
        known = points.where(F.col("RET").isNotNull())
        moments = [m for tag, (u, v) in pairs.items() for m in _two_regressors(u, v, tag)]
        rows = known.groupBy(*GROUP).agg(F.avg("Y").alias("MY"), *moments)
    else:
        rows = _timing_window_rows(points, windows, pairs, strict)

    def solve(tag: str) -> tuple[Column, Column, Column]:
        uu, vv, uv, uy, vy, mu, mv = (F.col(f"{tag}{s}") for s in ("UU", "VV", "UV", "UY", "VY", "MU", "MV"))
        det = uu * vv - uv * uv
        if windows is not None:  # two or three days, or days on one line: no plane through them
            det = F.when(det > FLAT * uu * vv, det)
        bu, bv = safe_div(vv * uy - uv * vy, det), safe_div(uu * vy - uv * uy, det)
        return F.col("MY") - bu * mu - bv * mv, bu, bv

    qa, _, qc = solve("Q")
    pa, pn, pp = solve("P")
    return rows.select(
        *GROUP,
        (F.pow(1 + qa, TRADING_DAYS) - 1).alias("QUAD_ALPHA"),
        qc.alias("QUAD_TIMING"),
        (F.pow(1 + pa, TRADING_DAYS) - 1).alias("UPDOWN_ALPHA"),
        (pp - pn).alias("UPDOWN_TIMING"),
    )


FLAT = 1e-9  # share of a determinant below which two regressors count as one


def _two_regressors(u: str, v: str, tag: str) -> list[Column]:
    return [
        F.var_samp(u).alias(f"{tag}UU"), F.var_samp(v).alias(f"{tag}VV"), F.covar_samp(u, v).alias(f"{tag}UV"),
        F.covar_samp(u, "Y").alias(f"{tag}UY"), F.covar_samp(v, "Y").alias(f"{tag}VY"),
        F.avg(u).alias(f"{tag}MU"), F.avg(v).alias(f"{tag}MV"),
    ]


def _timing_window_rows(points: DataFrame, windows: DataFrame, pairs: Mapping[str, tuple[str, str]], strict: bool) -> DataFrame:
    known = F.col("RET").isNotNull() & F.col("BRET").isNotNull()
    names = ["Y", *[x for pair in pairs.values() for x in pair]]
    products = {(a, b) for u, v in pairs.values() for a, b in ((u, u), (v, v), (u, v), (u, "Y"), (v, "Y"))}
    sums = {"N": _count(known)} | {f"S_{n}": F.when(known, F.col(n)) for n in names} | {f"S_{a}_{b}": F.when(known, F.col(a) * F.col(b)) for a, b in sorted(products)}
    rows = window_segments(points, windows, sums, {}, [], strict, laid_out=True)
    mean = lambda x: safe_div(F.col(f"S_{x}"), F.col("N"))
    cov = lambda a, b: safe_div(F.col(f"S_{a}_{b}") - F.col(f"S_{a}") * mean(b), F.col("N") - 1)
    out = {"MY": mean("Y")}
    for tag, (u, v) in pairs.items():
        out |= {f"{tag}UU": cov(u, u), f"{tag}VV": cov(v, v), f"{tag}UV": cov(u, v), f"{tag}UY": cov(u, "Y"), f"{tag}VY": cov(v, "Y"), f"{tag}MU": mean(u), f"{tag}MV": mean(v)}
    return rows.where(F.col("N") > 1).withColumns(out)


# fixed values: rolling horizons in rows and their labels
ROLLING_HORIZONS = {
    7: "7天", 20: "1个月", 40: "2个月", 60: "3个月", 120: "6个月", 180: "9个月",
    240: "1年", 480: "2年", 720: "3年", 960: "4年", 1200: "5年",
}


def rolling_horizons(panel: DataFrame, horizons: Mapping[int, str] = ROLLING_HORIZONS) -> DataFrame:
    """Quartiles and share of positive values of the n-row return, per entity and horizon.

    The returns of a horizon are made and sorted beside the entity's days, which travel once; an entity has at most one row a day.
    """
    days = panel.select(KEY, F.unix_date(F.col(DATE).cast("date")).alias("DAY"), F.col(NAV).cast("double").alias(NAV))

    def entity(tag: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        nav = frame[NAV].to_numpy()[np.argsort(frame["DAY"].to_numpy(), kind="stable")]
        rows = []
        for n in horizons:
            moves = _quotient(nav[n:], nav[:-n]) - 1
            moves = np.sort(moves[~np.isnan(moves)])
            rows.append([*_quartiles(moves), (moves > 0).mean()] if len(moves) else [np.nan] * 4)
        out = pd.DataFrame(rows, columns=["P25", "MEDIAN", "P75", "WIN_RATE"], dtype=float)
        out.insert(0, "HORIZON", list(horizons.values()))
        out.insert(0, KEY, pd.Series([tag[0]] * len(out), dtype=object))
        return out

    numbers = ["P25", "MEDIAN", "P75", "WIN_RATE"]
    rows = days.groupBy(KEY).applyInPandas(entity, f"{KEY} {dict(panel.dtypes)[KEY]}, HORIZON string, " + ", ".join(f"{c} double" for c in numbers))
    return rows.select(KEY, "HORIZON", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in numbers])


def _quartiles(ordered: np.ndarray) -> list[float]:
    """With linear interpolation, weighed as the built-in ``percentile`` does."""
    found = []
    for q in (0.25, 0.5, 0.75):
        at = (len(ordered) - 1) * q
        low, high = int(np.floor(at)), int(np.ceil(at))
        same = ordered[low] == ordered[high]
        found.append(ordered[low] if same else (high - at) * ordered[low] + (at - low) * ordered[high])
    return found


def ic_summary(ics: DataFrame, keys: Sequence[str], ic: str = "IC") -> DataFrame:
    """Summary of a series of information coefficients (population deviation)."""
    rows = ics.groupBy(*keys).agg(
        F.count(ic).alias("N"), F.avg(ic).alias("MEAN"), F.stddev_pop(ic).alias("STD"),
        F.avg(F.when(F.col(ic) > 0, 1.0).otherwise(0.0)).alias("POSITIVE"),
        F.avg(F.when(F.col(ic) < 0, 1.0).otherwise(0.0)).alias("NEGATIVE"),
    )
    ir = safe_div(F.col("MEAN"), F.col("STD"))
    return rows.select(*keys, "N", "MEAN", F.abs("MEAN").alias("ABS_MEAN"), "STD", ir.alias("IR"), (ir * F.sqrt("N")).alias("T_VALUE"), "POSITIVE", "NEGATIVE")


def per_window(panel: DataFrame, windows: DataFrame, func: Callable, schema: str) -> DataFrame:
    """User function ``pandas series frame -> frame`` per (entity, window); a group is one entity's days in one window.

    A metric that is one number is far cheaper by :func:`metric_per_window`, which multiplies no rows.
    """
    return fan_out(panel, windows).groupBy(*GROUP).applyInPandas(func, schema)


def metric_per_window(panel: DataFrame, windows: DataFrame, func: Callable[[np.ndarray, np.ndarray], float], name: str) -> DataFrame:
    """User function ``(days, values) -> number`` per (entity, window) as column ``name``, null where it gives not a number.

    ``days`` (since 1970-01-01, rising) and ``values`` are numpy slices of one entity's series.  An entity's days travel once and a window is a
    slice of them; more than ``SPANS`` windows meet the entities' days as rows, by :func:`per_window`.
    """
    spans = windows.select("START_DATE", "END_DATE").where("START_DATE <= END_DATE").distinct()
    pinned = pin_small(spans, SPANS)
    epoch = F.lit("1970-01-01").cast("date")
    shape = f"WIN_START int, WIN_END int, `{name}` double"
    if pinned is None:
        numbered = fan_out(panel, windows).select(*GROUP, F.datediff(DATE, epoch).alias("DAY"), F.col(NAV).cast("double").alias(NAV))
        dated = numbered.withColumns({c: F.datediff(c, epoch) for c in GROUP[1:]})

        def window(tag: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("DAY")
            return pd.DataFrame({c: pd.Series([v], dtype=object if c == KEY else None) for c, v in zip(GROUP, tag)} | {name: float(func(frame["DAY"].to_numpy(), frame[NAV].to_numpy()))})

        rows = dated.groupBy(*GROUP).applyInPandas(window, f"{KEY} {dict(panel.dtypes)[KEY]}, {shape}")
    else:
        table = pinned.select(F.datediff("START_DATE", epoch).alias("A"), F.datediff("END_DATE", epoch).alias("B")).orderBy("B", "A").toPandas()
        starts, ends = (table[c].to_numpy(dtype=np.int64) for c in "AB")

        def entity(tag: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            days, values = frame["DAY"].to_numpy(), frame[NAV].to_numpy()
            order = np.argsort(days, kind="stable")
            days, values = days[order], values[order]
            days.flags.writeable = values.flags.writeable = False  # windows overlap
            first, last = np.searchsorted(days, starts), np.searchsorted(days, ends, side="right")
            there = first < last
            found = [func(days[a:b], values[a:b]) for a, b in zip(first[there], last[there])]
            return pd.DataFrame({KEY: pd.Series([tag[0]] * len(found), dtype=object), "WIN_START": starts[there], "WIN_END": ends[there], name: np.array(found, dtype=float)})

        days = panel.select(KEY, F.datediff(DATE, epoch).alias("DAY"), F.col(NAV).cast("double").alias(NAV)).where("DAY IS NOT NULL")
        rows = days.groupBy(KEY).applyInPandas(entity, f"{KEY} {dict(panel.dtypes)[KEY]}, {shape}")
    return rows.withColumns({c: F.date_add(epoch, c) for c in GROUP[1:]})


# registry: metric name -> (Column over the segments of one window, multiplier)
METRICS: dict[str, tuple[Callable[[], Column], float]] = {
    "CUM_RETURN": (lambda: safe_div(F.col("LAST_NAV"), F.col("FIRST_NAV")) - 1, 100.0),
    "VOLATILITY": (lambda: F.col("VOL"), 100.0),
    "ANNUAL_VOLATILITY": (lambda: F.col("VOL") * F.sqrt(F.lit(TRADING_DAYS)), 100.0),
    "MAXDD": (lambda: F.col("MDD"), 100.0),
    "WIN_RATE": (lambda: F.col("WIN_RATE"), 1.0),
}


def chosen_metrics(panel: DataFrame, windows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named metrics of the registry, per (entity, window), strict coverage."""
    rows = window_rows(panel, windows, strict=True, classic=False)
    return rows.select(*GROUP, *[(METRICS[n][0]() * METRICS[n][1]).alias(n) for n in names])
