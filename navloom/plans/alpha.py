"""Returns and alpha against peers, classes and indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.functions.series import by, running_product, running_sum, upto
from navloom.operators.aggregates import class_averages, union_all
from navloom.operators.joins import interval_join, previous_period
from navloom.operators.ranks import fits
from navloom.session import cut_lineage

T, D = "TICKER_SYMBOL", "END_DATE"


def return_to_previous_day(nav: DataFrame, cal: DataFrame, value: str = "NAV") -> DataFrame:
    """Percent return against the calendar's previous trading day; a day after a gap has none."""
    joined = previous_period(nav.select(T, D, value), cal, [T], D, value, "_BEFORE")
    return joined.select(T, D, ((safe_div(F.col(value), F.col("_BEFORE")) - 1) * 100).alias("RETURN_RATE"))


def class_returns(ret: DataFrame, types: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Median and mean return of each class and day, all levels at once.

    A fund has one return per day, so the members of the largest class bound the groups; only the class table is measured.
    """
    small = fits(types.unpivot([T], list(levels), "LEVEL", "CLASS"), ["LEVEL", "CLASS"])
    return class_averages(ret.join(types.select(T, *levels), T), levels, [D], "RETURN_RATE", bounded=small)


def log_alpha(ret: DataFrame, types: DataFrame, levels: Sequence[str], average: str = "MEDIAN") -> DataFrame:
    """Daily log alpha against the entity's class at each level, its running sum and the NAV it implies (start 1).

    ``ret`` has ``TICKER_SYMBOL, END_DATE, RETURN_RATE`` in percent.  A missing class return counts as 0.
    """
    classes = cut_lineage(class_returns(ret, types, levels).select(D, "LEVEL", "CLASS", F.col(average).alias("CLASS_RET")))  # a row for each class and day
    out = ret.select(T, D, "RETURN_RATE").join(types.select(T, *levels), T)
    for level in levels:
        own = classes.where(F.col("LEVEL") == level).select(D, F.col("CLASS").alias(level), F.col("CLASS_RET").alias(f"_{level}"))
        out = out.join(own, [D, level], "left")
    log = F.log1p(F.col("RETURN_RATE") / 100)
    alphas = {level: (log - F.log1p(F.coalesce(F.col(f"_{level}"), F.lit(0.0)) / 100)) * 100 for level in levels}
    w = by([T], D)
    out = out.select(T, D, *[a.alias(f"_A_{level}") for level, a in alphas.items()])
    out = out.withColumns({f"_C_{level}": running_sum(F.col(f"_A_{level}"), w) for level in levels})
    each = F.explode(F.array(*[F.struct(F.lit(level).alias("LEVEL"), F.col(f"_A_{level}").alias("LOG_ALPHA"), F.col(f"_C_{level}").alias("CUM_ALPHA")) for level in levels]))
    return out.select(T, D, each.alias("_E")).select(T, D, "_E.LEVEL", "_E.LOG_ALPHA", "_E.CUM_ALPHA", F.exp(F.col("_E.CUM_ALPHA") / 100).alias("ALPHA_NAV"))


def tracked_alpha(ret: DataFrame, tracking: DataFrame, index_ret: DataFrame) -> DataFrame:
    """Log alpha against the index tracked on the day.

    ``tracking`` is the validity table ``TICKER_SYMBOL, INDEX_CODE, ENTRY_DT, REMOVE_DT``.
    """
    held = interval_join(ret, tracking, T, D, "ENTRY_DT", "REMOVE_DT", closed=True)
    joined = held.join(index_ret.select("INDEX_CODE", D, F.col("RETURN_RATE").alias("INDEX_RET")), ["INDEX_CODE", D])
    alpha = (F.log1p(F.col("RETURN_RATE") / 100) - F.log1p(F.col("INDEX_RET") / 100)) * 100
    out = joined.withColumn("LOG_ALPHA", alpha)
    return out.select(T, D, "INDEX_CODE", "LOG_ALPHA", running_sum(F.col("LOG_ALPHA"), by([T], D)).alias("CUM_ALPHA")).withColumn("ALPHA_NAV", F.exp(F.col("CUM_ALPHA") / 100))


def alpha_nav(alpha: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """NAV that grows with each daily alpha (fraction): ``columns`` maps the alpha column to its NAV column."""
    w = by([T], D)
    return alpha.withColumns({nav: running_product(1 + F.coalesce(F.col(a), F.lit(0.0)), w) for a, nav in columns.items()})


def patch_columns(stored: DataFrame, patch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace columns of the rows that the patch names, keep the others."""
    p = patch.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    return stored.join(p, list(keys), "left").withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}).select(*stored.columns)


def benchmark_returns(sources: Sequence[DataFrame]) -> DataFrame:
    """One table from many index sources (``TRADE_DT, TICKER_SYMBOL, RETURN_RATE``), return and log return in percent."""
    merged = union_all([s.select("TRADE_DT", T, "RETURN_RATE") for s in sources]).distinct()
    return merged.withColumn("LOG_RETURN_RATE", F.log1p(F.col("RETURN_RATE") / 100) * 100)


def fund_vs_index(ret: DataFrame, index_ret: DataFrame) -> DataFrame:
    """Log return of fund and index, their difference, and the three running sums."""
    joined = ret.join(index_ret.select(D, F.col("RETURN_RATE").alias("INDEX_RET")), D)
    logs = joined.select(T, D, (F.log1p(F.col("RETURN_RATE") / 100) * 100).alias("LOG_RET"), (F.log1p(F.col("INDEX_RET") / 100) * 100).alias("LOG_INDEX"))
    logs = logs.withColumn("LOG_ALPHA", F.col("LOG_RET") - F.col("LOG_INDEX"))
    w = by([T], D)
    return logs.select(T, D, *[running_sum(F.col(c), w).alias(f"CUM_{c[4:]}") for c in ("LOG_RET", "LOG_INDEX", "LOG_ALPHA")])


def rebased(nav: DataFrame, columns: Sequence[str], keys: Sequence[str] = (T,), date: str = D) -> DataFrame:
    """Every column divided by its first value in the group."""
    w = by(keys, date)
    return nav.withColumns({c: safe_div(F.col(c), F.first(c).over(upto(w))) for c in columns})


def vendor_calmar(df: DataFrame, horizons: Sequence[str]) -> list[Column]:
    """``RETURN_{h} / abs(MAXDD_{h})`` per horizon."""
    return [safe_div(F.col(f"RETURN_{h}"), F.abs(F.col(f"MAXDD_{h}"))).alias(f"CALMAR_{h}") for h in horizons]


def spreads(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Named differences of columns."""
    return [(F.col(a) - F.col(b)).alias(n) for n, (a, b) in pairs.items()]
