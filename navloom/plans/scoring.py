"""Peer ranks and scores of funds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.operators import ranks
from navloom.operators.aggregates import split_name

T, D = "TICKER_SYMBOL", "END_DATE"

# fixed values: indicators where a small number is good, default weights, horizons of the score
LOW_IS_GOOD = ["MAXDD", "VOL", "ANNUAL_VOL", "ANNUAL_VOLATILITY"]
NAME_WEIGHTS = {"IR": 0.3, "MAXDD": 0.2, "ALPHA": 0.3, "VOL": 0.2}
PERIOD_WEIGHTS = {"3M": 0.2, "6M": 0.2, "1Y": 0.2, "2Y": 0.2, "3Y": 0.2}
MODEL_WEIGHTS = {"IR": 0.4, "ALPHA": 0.3, "MAXDD": 0.2}
SCORE_PERIODS = ["3M", "6M", "9M", "1Y", "2Y", "3Y"]


def _level_path(levels: Sequence[str], depth: int) -> Column:
    return F.concat_ws("|", *levels[:depth])


def by_each_level(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Every row once per class depth: ``LEVEL`` and the class path ``PATH`` down to that depth."""
    each = F.array(*[F.struct(F.lit(levels[i]).alias("LEVEL"), _level_path(levels, i + 1).alias("PATH")) for i in range(len(levels))])
    return df.select("*", F.inline(each))


def performance_ranks(long: DataFrame, types: DataFrame, levels: Sequence[str], low_is_good: Sequence[str], as_text: bool = False) -> DataFrame:
    """Rank of every indicator inside the class at each depth: ``RANK`` as percent, or ``r/n`` text.

    ``long`` has ``TICKER_SYMBOL, END_DATE, INDICATOR, PERIOD, VALUE`` with one value per key, so the members of the largest
    class bound the groups and only the class table is measured.  All indicators and levels are ranked in one pass; a metric
    where low is good is negated first.
    """
    small = ranks.fits(by_each_level(types.select(T, *levels), levels), ["LEVEL", "PATH"])
    signed = F.when(F.col("INDICATOR").isin(list(low_is_good)), -F.col("VALUE")).otherwise(F.col("VALUE"))
    rows = by_each_level(long.join(types.select(T, *levels), T), levels).withColumn("_V", signed)
    group = [D, "INDICATOR", "PERIOD", "LEVEL", "PATH"]
    ranked = ranks.peer_rank(rows, "_V", group, bounded=small, **({"text": "RANK"} if as_text else {"pct": "RANK"}))
    return ranked.select(T, D, "LEVEL", "INDICATOR", "PERIOD", "RANK")


def return_rank_pivot(long: DataFrame, types: DataFrame, levels: Sequence[str], periods: Sequence[str]) -> DataFrame:
    """Percent rank of the return (best = 0) by class and period, one column per period."""
    rows = long.where(F.col("PERIOD").isin(list(periods))).join(types.select(T, *levels), T)
    ranked = ranks.percent_rank(rows, "VALUE", [D, *levels, "PERIOD"], "_PR", descending=True)
    return ranked.groupBy(T, D).agg(*[F.max(F.when(F.col("PERIOD") == p, F.round(F.col("_PR") * 100, 2))).alias(p) for p in periods])


def tracked_index_ranks(long: DataFrame, index_of: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Percent rank among the funds that track the same index; 100 - rank where low is good; one column per period."""
    rows = long.where(F.col("VALUE").isNotNull() & F.col("PERIOD").isin(list(periods))).join(index_of, T)
    ranked = ranks.percent_rank(rows, "VALUE", [D, "INDEX_NAME", "INDICATOR", "PERIOD"], "_PR", descending=True)
    pct = F.col("_PR") * 100
    ranked = ranked.withColumn("_R", F.when(F.col("INDICATOR").isin(LOW_IS_GOOD), 100 - pct).otherwise(pct))
    return ranked.groupBy(D, T, "INDEX_NAME", "INDICATOR").agg(*[F.max(F.when(F.col("PERIOD") == p, F.col("_R"))).alias(f"{p}_RANK") for p in periods])


def metric_grid(long: DataFrame, names: Mapping[str, str], periods: Sequence[str], base: str) -> DataFrame:
    """Long table with every (metric, period) of the funds that have the base period; a missing number counts as 0.

    ``names`` maps the stored indicator to its short name.
    """
    kept = long.join(long.where((F.col("PERIOD") == base) & F.col("VALUE").isNotNull()).select(T, D).distinct(), [T, D], "left_semi")
    cells = [(i, p, f"{short}_{p}") for i, short in names.items() for p in periods]
    wide = kept.groupBy(D, T).agg(
        *[F.sum(F.when((F.col("INDICATOR") == i) & (F.col("PERIOD") == p), F.col("VALUE")).otherwise(0.0)).alias(c) for i, p, c in cells]
    )
    stacked = wide.unpivot([D, T], [c for *_, c in cells], "NAME", "VALUE")
    return split_name(stacked, "NAME", "INDICATOR", "PERIOD").drop("NAME")


def grid_percentiles(grid: DataFrame, types: DataFrame, levels: Sequence[str]) -> DataFrame:
    """SQL percent rank of each metric in its class; the best value gets 1."""
    signed = F.when(F.col("INDICATOR").isin(LOW_IS_GOOD), -F.col("VALUE")).otherwise(F.col("VALUE"))
    rows = grid.join(types.select(T, *levels), T).withColumn("_V", signed)
    return ranks.percent_rank(rows, "_V", [D, *levels, "INDICATOR", "PERIOD"], "SCORE").drop("_V")


def alpha_total_score(
    percentiles: DataFrame,
    levels: Sequence[str],
    name_weights: Mapping[str, float] = NAME_WEIGHTS,
    period_weights: Mapping[str, float] = PERIOD_WEIGHTS,
    groups: int = 10,
) -> DataFrame:
    """Weighted sub-score per metric, total score, and equal-frequency groups of each inside the class (1 = best)."""

    def weight(column: str, table: Mapping[str, float]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.col(column))

    names = sorted(name_weights)
    rows = percentiles.withColumns({"_NW": weight("INDICATOR", name_weights), "_PW": weight("PERIOD", period_weights)}).dropna(subset=["_NW", "_PW"])
    scored = rows.groupBy(D, T, *levels).agg(
        *[F.sum(F.when(F.col("INDICATOR") == n, F.col("SCORE") * F.col("_PW"))).alias(n) for n in names],
        F.sum(F.col("SCORE") * F.col("_PW") * F.col("_NW")).alias("TOTAL_SCORE"),
    )
    scored = scored.select(D, T, *levels, *[F.round(c, 8).alias(c) for c in (*names, "TOTAL_SCORE")])
    scored, small = ranks.sized(scored, [D, *levels])
    for c in (*names, "TOTAL_SCORE"):
        scored = ranks.quantile_group(scored, groups, [D, *levels], [F.col(c), F.col(T)], f"{c}_GROUP", bounded=small)
    return scored


def inner_alpha_model(percentiles: DataFrame, levels: Sequence[str], changed: DataFrame) -> DataFrame:
    """Mean percentile of three metrics over five horizons, their weighted total, deciles and the manager-change flag.

    The weights add to 0.9 by definition of the model.  ``changed`` lists the funds whose manager left lately.
    """
    mean = {n: F.round(F.sum(F.when((F.col("INDICATOR") == n) & F.col("PERIOD").isin(list(PERIOD_WEIGHTS)), F.col("SCORE") * 0.2)), 4) * 100 for n in MODEL_WEIGHTS}
    scored = percentiles.groupBy(D, T, *levels).agg(*[c.alias(f"{n}_SCORE") for n, c in mean.items()])
    total = reduce(lambda a, b: a + b, [F.col(f"{n}_SCORE") * w for n, w in MODEL_WEIGHTS.items()])
    scored = scored.withColumn("TOTAL_SCORE", F.round(total, 6))
    flagged = scored.join(changed.select(T, F.lit(1).alias("IF_MANAGER_CHANGE_6M")).distinct(), T, "left").fillna({"IF_MANAGER_CHANGE_6M": 0})
    flagged, small = ranks.sized(flagged, [D, *levels])
    for name, column in (("IR_GROUP", "IR_SCORE"), ("MAXDD_GROUP", "MAXDD_SCORE"), ("ALPHA_GROUP", "ALPHA_SCORE"), ("TOTAL_SCORE_GROUP", "TOTAL_SCORE")):
        flagged = ranks.ntile(flagged, 10, [D, *levels], [-F.col(column), F.col(T)], name, bounded=small)
    return flagged


def screen(long: DataFrame, indicator: str, period: str, types: DataFrame, levels: Sequence[str], info: DataFrame, groups: int, min_asset: float, as_of: Column, best_high: bool = True) -> DataFrame:
    """One metric: percentile and NTILE group in its class, for funds alive on the day with enough assets."""
    values = long.where((F.col("INDICATOR") == indicator) & (F.col("PERIOD") == period) & F.col("VALUE").isNotNull())
    alive = info.where((F.col("ESTABLISH_DATE") <= as_of) & (F.coalesce("EXPIRE_DATE", F.to_date(F.lit("2099-12-31"))) >= as_of) & (F.col("NET_ASSET") >= min_asset))
    rows = values.join(types.select(T, *levels), T).join(alive.select(T, "IS_MAIN"), T).select(T, D, *levels, "IS_MAIN", "VALUE")
    rows, small = ranks.sized(rows, [D, *levels])
    scored = ranks.percent_rank(rows, "VALUE", [D, *levels], "_PR", bounded=small)
    order = [-F.col("VALUE") if best_high else F.col("VALUE"), F.col(T)]
    out = ranks.ntile(scored.withColumn("SCORE", F.col("_PR") * 100).drop("_PR"), groups, [D, *levels], order, "GROUP_NO", bounded=small)
    return out.drop("VALUE")


def total_score(stored: DataFrame, types: DataFrame, levels: Sequence[str], special: str, weights: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Total fund score at every class level.

    ``stored``: ``TICKER_SYMBOL, LEVEL`` and per metric the percent ranks ``{m}_1Y`` and ``{m}_3Y`` (0 = best).  Funds of the class
    ``special`` take their level-1 ranks and are ranked again inside their own buckets at each level (the 3-year sharpe rank
    too is taken inside its own level).  A missing 3-year rank counts as 50; the score of a metric is the mean of 100 - rank
    over both horizons; ``weights`` has ``LEVEL_1`` and one weight column per metric.
    """
    columns = [f"{m}_{h}" for m in metrics for h in ("1Y", "3Y")]
    typed = stored.join(types.select(T, *levels), T)
    own = typed.where((F.col("LEVEL_1") == special) & (F.col("LEVEL") == "LEVEL_1")).drop("LEVEL")
    own = own.select(T, *levels, *columns, F.inline(F.array(*[F.struct(F.lit(lv).alias("LEVEL"), F.col(lv).alias("_CLASS")) for lv in levels])))
    long = own.unpivot([T, *levels, "LEVEL", "_CLASS"], columns, "METRIC", "VALUE")
    again = ranks.percent_rank(long, "VALUE", ["LEVEL", "_CLASS", "METRIC"], "_PR")
    again = again.withColumn("RANK", F.when(F.col("VALUE").isNotNull(), F.col("_PR") * 100))
    special_rows = again.groupBy(T, *levels, "LEVEL").agg(*[F.max(F.when(F.col("METRIC") == c, F.col("RANK"))).alias(c) for c in columns])
    rest = typed.where(F.col("LEVEL_1") != special).select(T, *levels, "LEVEL", *columns)
    rows = special_rows.unionByName(rest).where(F.col(f"{metrics[0]}_1Y").isNotNull())
    rows = rows.withColumns(
        {
            m: F.round((F.round(100 - F.col(f"{m}_1Y"), 2) + F.round(100 - F.coalesce(F.col(f"{m}_3Y"), F.lit(50.0)), 2)) / 2, 2)
            for m in metrics
        }
    )
    weighted = weights.select("LEVEL_1", *[F.col(m).alias(f"_W_{m}") for m in metrics])
    joined = rows.join(weighted, "LEVEL_1")
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(m) * F.col(f"_W_{m}"), F.lit(0.0)) for m in metrics])
    return joined.select(T, *levels, "LEVEL", *metrics, F.round(total, 2).alias("TOTAL_SCORE"))
