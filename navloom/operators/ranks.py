"""Ranks, quantiles and equal-frequency groups that stay exact when one group holds a large share of all rows.

A plain window by group sends a whole group through one task.  Each operator therefore first asks for the size of the
largest group.  The input is computed once, into a checkpoint that the question and the result both read.  Up to
``BLOCK_ROWS`` the plain window is used: one shuffle, one sort.  Beyond it equal values are pre-aggregated, a large group is cut into value blocks, the running count is taken inside each block and the block
offsets are added afterwards.  The cut points are the values whose hash falls into a fixed residue class, so they are a pure
function of the data: a task that is run again after an executor loss makes the same cuts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.session import cut_lineage

BLOCK_ROWS = 1_000_000  # rows one task orders; larger groups are cut into blocks


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return cond


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; a single number reaches the driver."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("N")).agg(F.max("N")).first()[0] or 0


def fits(df: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS) -> bool:
    """Size check of a stored table, which several ranks over its groups can share (pass it on as ``bounded``)."""
    return largest_group(df, keys) <= block_rows


def sized(df: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, bool]:
    """The rows of a plan, computed once, and whether their groups fit."""
    rows = cut_lineage(df)
    return rows, fits(rows, keys, block_rows)


def position_counts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per distinct order value of each group: ``_ORD, N_BEFORE, N_EQUAL, N_TOTAL``.

    ``order`` is ascending; negate a number to rank it downwards.  The distinct values are checkpointed because the blocked
    path reads them several times.
    """
    return _position_counts(df.select(*keys, F.struct(*order).alias("_ORD")), list(keys), block_rows)


def _position_counts(placed: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    distinct = cut_lineage(placed.groupBy(*keys, "_ORD").agg(F.count(F.lit(1)).alias("N_EQUAL")))
    if largest_group(distinct, keys) <= block_rows:
        w = Window.partitionBy(*keys).orderBy("_ORD")
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return distinct.select(
            *keys, "_ORD", F.coalesce(F.sum("N_EQUAL").over(before), F.lit(0)).alias("N_BEFORE"), "N_EQUAL", F.sum("N_EQUAL").over(whole).alias("N_TOTAL")
        )
    return _blocked_counts(distinct, keys, block_rows)


def _blocked_counts(distinct: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    sizes = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("_DISTINCT"), F.sum("N_EQUAL").alias("N_TOTAL"))
    hot = sizes.where(F.col("_DISTINCT") > block_rows).select(*keys, F.lit(max(1, block_rows)).cast("long").alias("_RATE"))
    cuts = (
        distinct.alias("d")
        .join(hot.alias("h"), _same("d", "h", keys))
        .where(F.pmod(F.xxhash64(*[F.col(f"d.{k}") for k in keys], F.col("d._ORD")), F.col("_RATE")) == 0)
        .select("d.*")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_ORD")).alias("_CUTS"))
    )
    groups = (
        sizes.alias("s")
        .join(cuts.alias("c"), _same("s", "c", keys), "left")
        .select(*[F.col(f"s.{k}") for k in keys], "N_TOTAL", "_CUTS")
    )
    # halving the sorted cuts finds the number of cuts below a value in as many steps as their number has bits
    half = lambda acc: F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
    block = F.aggregate(
        F.sequence(F.lit(1), F.lit(32)),
        F.struct(F.lit(0).alias("lo"), F.size("_CUTS").alias("hi")),
        lambda acc, _: F.when(
            acc["lo"] < acc["hi"],
            F.when(F.get("_CUTS", half(acc)) < F.col("_ORD"), F.struct((half(acc) + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), half(acc).alias("hi"))),
        ).otherwise(acc),
        lambda acc: acc["lo"],
    )
    placed = (
        distinct.alias("d")
        .join(groups.alias("g"), _same("d", "g", keys))
        .select("d.*", "N_TOTAL", F.when(F.col("_CUTS").isNull(), 0).otherwise(block).alias("_BLOCK"), F.col("_CUTS").isNotNull().alias("_HOT"))
        .repartition(*keys, "_BLOCK")
    )
    before = Window.partitionBy(*keys, "_BLOCK").orderBy("_ORD").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_LOCAL", F.coalesce(F.sum("N_EQUAL").over(before), F.lit(0)))
    earlier = Window.partitionBy(*keys).orderBy("_BLOCK").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.where("_HOT")
        .groupBy(*keys, "_BLOCK")
        .agg(F.sum("N_EQUAL").alias("_N"))
        .withColumn("_OFFSET", F.coalesce(F.sum("_N").over(earlier), F.lit(0)))
        .drop("_N")
    )
    return (
        local.alias("l")
        .join(offsets.alias("o"), _same("l", "o", [*keys, "_BLOCK"]), "left")
        .select(
            *[F.col(f"l.{k}") for k in keys],
            "_ORD",
            (F.col("_LOCAL") + F.coalesce(F.col("_OFFSET"), F.lit(0))).alias("N_BEFORE"),
            "N_EQUAL",
            "N_TOTAL",
        )
    )


def with_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], where: Column | None = None, block_rows: int = BLOCK_ROWS, bounded: bool = False
) -> DataFrame:
    """Every row of ``df`` plus ``N_BEFORE, N_EQUAL, N_TOTAL`` (null for rows outside ``where``).

    ``bounded`` skips the size check for groups whose size has a proven bound (days of one entity, members of a level table).
    """
    keys = list(keys)
    rows = df.withColumn("_ORD", F.struct(*order) if where is None else F.when(where, F.struct(*order)))
    if not bounded:
        rows, bounded = sized(rows, keys, block_rows)
    if bounded:
        w = Window.partitionBy(*keys).orderBy(F.col("_ORD").asc_nulls_last())
        ranked = F.col("_ORD").isNotNull()
        peers, whole = w.rangeBetween(Window.currentRow, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return rows.select(
            *df.columns,
            F.when(ranked, F.rank().over(w).cast("long") - 1).alias("N_BEFORE"),
            F.when(ranked, F.count("_ORD").over(peers)).alias("N_EQUAL"),
            F.when(ranked, F.count("_ORD").over(whole)).alias("N_TOTAL"),
        )
    counted = _position_counts(rows.where(F.col("_ORD").isNotNull()).select(*keys, "_ORD"), keys, block_rows)
    return (
        rows.alias("r")
        .join(counted.alias("c"), _same("r", "c", keys) & (F.col("r._ORD") == F.col("c._ORD")), "left")
        .select(*[F.col(f"r.{c}") for c in df.columns], "N_BEFORE", "N_EQUAL", "N_TOTAL")
    )


def _drop_counts(df: DataFrame) -> DataFrame:
    return df.drop("N_BEFORE", "N_EQUAL", "N_TOTAL")


def _directed(value: str, descending: bool) -> Column:
    return -F.col(value) if descending else F.col(value)


def average_rank(truncate: bool) -> Column:
    """Rank with ties sharing their mean position, from the counts of ``with_positions``."""
    mean = F.col("N_BEFORE") + (F.col("N_EQUAL") + 1) / F.lit(2)
    return F.floor(mean).cast("long") if truncate else mean


def peer_rank(df: DataFrame, value: str, keys: Sequence[str], pct: str | None = None, text: str | None = None, descending: bool = True, **kw) -> DataFrame:
    """0..100 percent rank and / or ``3/120`` text: mean tie position cut to an integer, nulls not counted, a lone value gives a null percent."""
    out = with_positions(df, keys, [_directed(value, descending)], F.col(value).isNotNull(), **kw)
    if pct:
        out = out.withColumn(pct, F.try_divide((average_rank(True) - 1) * F.lit(100.0), (F.col("N_TOTAL") - 1).cast("double")))
    if text:
        out = out.withColumn(text, F.concat(average_rank(True).cast("string"), F.lit("/"), F.col("N_TOTAL").cast("string")))
    return _drop_counts(out)


def rank_pct(df: DataFrame, value: str, keys: Sequence[str], out: str, descending: bool = True, **kw) -> DataFrame:
    return peer_rank(df, value, keys, pct=out, descending=descending, **kw)


def rank_str(df: DataFrame, value: str, keys: Sequence[str], out: str, descending: bool = True, **kw) -> DataFrame:
    return peer_rank(df, value, keys, text=out, descending=descending, **kw)


def percent_rank(df: DataFrame, value: str, keys: Sequence[str], out: str, descending: bool = False, **kw) -> DataFrame:
    """SQL ``PERCENT_RANK``: ties share the lowest rank, nulls take part (first ascending, last descending), one row gives 0."""
    present = F.col(value).isNotNull()
    filled = F.coalesce(_directed(value, descending), F.lit(0.0))
    order = [~present, filled] if descending else [present, filled]
    ranked = with_positions(df, keys, order, **kw)
    return _drop_counts(ranked.withColumn(out, F.coalesce(F.try_divide(F.col("N_BEFORE").cast("double"), (F.col("N_TOTAL") - 1).cast("double")), F.lit(0.0))))


def rank_fraction(df: DataFrame, value: str, keys: Sequence[str], out: str, descending: bool = False, **kw) -> DataFrame:
    """Mean-tie rank over the number of values, in (0, 1]."""
    ranked = with_positions(df, keys, [_directed(value, descending)], F.col(value).isNotNull(), **kw)
    return _drop_counts(ranked.withColumn(out, F.try_divide(average_rank(False), F.col("N_TOTAL").cast("double"))))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, total: str | None = None, **kw) -> DataFrame:
    """``ROW_NUMBER``; ``order`` must be unique inside a group."""
    ranked = with_positions(df, keys, order, **kw).withColumn(out, F.col("N_BEFORE") + 1)
    if total:
        ranked = ranked.withColumn(total, F.col("N_TOTAL"))
    return _drop_counts(ranked)


def sql_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, **kw) -> DataFrame:
    """SQL ``RANK``."""
    return _drop_counts(with_positions(df, keys, order, **kw).withColumn(out, F.col("N_BEFORE") + 1))


def ntile(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[Column], out: str, **kw) -> DataFrame:
    """SQL ``NTILE``: the first ``total mod n`` buckets get one row more; ``order`` must be unique inside a group."""
    ranked = with_positions(df, keys, order, **kw)
    size, extra = F.floor(F.col("N_TOTAL") / n), F.col("N_TOTAL") % n
    in_large = F.floor(F.col("N_BEFORE") / (size + 1)) + 1
    in_small = extra + F.floor((F.col("N_BEFORE") - extra * (size + 1)) / F.greatest(size, F.lit(1))) + 1
    return _drop_counts(ranked.withColumn(out, F.when(F.col("N_BEFORE") < extra * (size + 1), in_large).otherwise(in_small).cast("int")))


def quantile_group(df: DataFrame, q: int, keys: Sequence[str], order: Sequence[Column], out: str, **kw) -> DataFrame:
    """Equal-frequency groups by rank quantile, best (largest) = 1; a group with fewer than ``q`` rows is all 1."""
    ranked = with_positions(df, keys, order, **kw)
    bin_no = F.greatest(F.lit(1), F.ceil(F.col("N_BEFORE") * q / F.greatest(F.col("N_TOTAL") - 1, F.lit(1))))
    return _drop_counts(ranked.withColumn(out, F.when(F.col("N_TOTAL") < q, 1).otherwise(F.lit(q + 1) - bin_no).cast("int")))


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, qs: dict[str, float], extra: Sequence[Column] = (), block_rows: int = BLOCK_ROWS, bounded: bool = False
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``qs``, next to ``extra`` aggregates of the group.

    Groups that fit one task use the built-in aggregate; larger ones are read off the running counts.
    """
    keys = list(keys)
    present = df.where(F.col(value).isNotNull())
    if not bounded:
        present, bounded = sized(present, keys, block_rows)
    if bounded:
        return present.groupBy(*keys).agg(*[F.percentile(value, q).alias(name) for name, q in qs.items()], *extra)
    counts = position_counts(present, keys, [F.col(value).alias("V")], block_rows)
    aggs, outs = [], []
    for name, q in qs.items():
        at = (F.col("N_TOTAL") - 1) * F.lit(float(q))
        for side, pos in (("LO", F.floor(at)), ("HI", F.ceil(at))):
            hit = (F.col("N_BEFORE") <= pos) & (pos < F.col("N_BEFORE") + F.col("N_EQUAL"))
            aggs.append(F.max(F.when(hit, F.col("_ORD.V"))).alias(f"_{name}_{side}"))
        aggs += [F.max(F.ceil(at) - at).alias(f"_{name}_DN"), F.max(at - F.floor(at)).alias(f"_{name}_UP")]
        lo, hi, down, up = (F.col(f"_{name}_{s}") for s in ("LO", "HI", "DN", "UP"))
        outs.append(F.when(lo == hi, lo.cast("double")).otherwise(down * lo + up * hi).alias(name))  # as the built-in aggregate weighs them
    out = counts.groupBy(*keys).agg(*aggs).select(*keys, *outs)
    if not extra:
        return out
    others = present.groupBy(*keys).agg(*extra)
    named = [c for c in others.columns if c not in keys]
    return out.alias("q").join(others.alias("e"), _same("q", "e", keys)).select("q.*", *[F.col(f"e.{c}") for c in named])


def rolling_ranks(df: DataFrame, ranked: Mapping[str, str], keys: Sequence[str], order: str, rows: int, descending: bool = True) -> DataFrame:
    """Adds mean-tie fractional ranks of columns (``column: rank``) among the last ``rows`` values of an entity; null before there are that many.

    The last values are kept sorted: a value comes in and the oldest goes by binary search, so a row costs the logarithm of
    ``rows``, and no list is made for it.  A null among the last rows makes the rank null.  An entity holds at most one row per day.
    """
    schema = T.StructType([*df.schema.fields, *[T.StructField(out, T.DoubleType()) for out in ranked.values()]])

    def rank(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, ignore_index=True)
        for column, out in ranked.items():
            frame[out] = rolling_rank(frame[column].to_numpy(dtype=float, na_value=np.nan), rows, descending)
        return frame

    return df.groupBy(*keys).applyInPandas(rank, schema)


def rolling_rank(values: np.ndarray, rows: int, descending: bool) -> np.ndarray:
    out, last = np.full(len(values), np.nan), []
    listed = [None if v != v else -v if descending else v for v in values.tolist()]
    for at, value in enumerate(listed):
        if at >= rows and listed[at - rows] is not None:
            del last[bisect_left(last, listed[at - rows])]
        if value is None:
            continue
        insort(last, value)
        if len(last) == rows:
            ahead = bisect_left(last, value)
            out[at] = (ahead + (bisect_right(last, value, ahead) - ahead + 1) / 2) / rows
    return out
