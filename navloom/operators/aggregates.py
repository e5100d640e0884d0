"""Grouped aggregates: conditional pivots, grouping sets, weighted means, linking, covariance, latest per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.operators.ranks import quantiles, row_numbers

ALL = "ALL"  # fixed value: label of a column that a grouping set leaves out


def conditional_sums(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One sum per category as columns; a category without rows gives 0, not null."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(name) == n, F.col(value)).otherwise(0.0)).alias(n) for n in names])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, by partial aggregation (no sort, no hot window)."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def level_grouping_sets(levels: Sequence[str], others: Sequence[str]) -> list[list[str]]:
    """Every subset of {first level} + others; a set with the first level also appears with each deeper level path added."""
    base = [levels[0], *others]
    sets = [list(c) for n in range(len(base) + 1) for c in combinations(base, n)]
    deeper = [s + list(levels[1 : depth + 1]) for s in sets if levels[0] in s for depth in range(1, len(levels))]
    return sets + deeper


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], columns: Sequence[str], aggs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """One pass over all grouping sets; absent columns read ``ALL``.  ``keys`` belong to every set.

    ``GROUP_SET`` names the set so that a real value "ALL" cannot be confused with an absent column.
    """
    grouped = df.groupingSets([[F.col(c) for c in (*keys, *s)] for s in sets], *[F.col(c) for c in (*keys, *columns)])
    marks = [F.grouping(c).alias(f"_{c}") for c in columns]
    out = grouped.agg(*aggs, *marks)
    named = F.concat_ws("+", *[F.when(F.col(f"_{c}") == 0, F.lit(c)) for c in columns])
    out = out.withColumns({c: F.when(F.col(f"_{c}") == 1, F.lit(ALL)).otherwise(F.col(c)) for c in columns})
    return out.withColumn("GROUP_SET", named).drop(*[f"_{c}" for c in columns])


def weighted_mean(value: str, weight: str) -> Column:
    """Weighted mean over the rows that have both numbers."""
    both = F.col(value).isNotNull() & F.col(weight).isNotNull()
    return safe_div(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(both, F.col(weight))))


def share_of(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Value over the sum of its group; the sums are aggregated first, so a hot group is not collected."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_TOTAL"))
    return df.join(totals, list(keys)).withColumn(out, safe_div(F.col(value), F.col("_TOTAL"))).drop("_TOTAL")


def linked_return(rate: Column) -> Column:
    """Compound of period returns (fractions)."""
    return F.product(1 + rate) - 1


def linked_from_logs(log_pct: Column) -> Column:
    """Compound of log returns held in percent, as a fraction."""
    return F.exp(F.sum(log_pct) / 100) - 1


def last_periods_mean(df: DataFrame, key: Sequence[str], date: str, n: int, values: Sequence[str]) -> DataFrame:
    """Mean of each value over the ``n`` latest report dates present in the table."""
    dates = df.select(date).distinct().orderBy(F.desc(date)).limit(n)
    return df.join(F.broadcast(dates), date, "left_semi").groupBy(*key).agg(*[F.avg(v).alias(v) for v in values])


def class_averages(df: DataFrame, levels: Sequence[str], keys: Sequence[str], value: str, bounded: bool = False) -> DataFrame:
    """Median and mean of a value per class, all class levels in one pass: ``keys, LEVEL, CLASS, MEDIAN, MEAN, N``."""
    long = df.unpivot([*keys, value], list(levels), "LEVEL", "CLASS").where(F.col("CLASS").isNotNull())
    extra = [F.avg(value).alias("MEAN"), F.count(value).alias("N")]
    return quantiles(long, [*keys, "LEVEL", "CLASS"], value, {"MEDIAN": 0.5}, extra, bounded=bounded)


BLOCK_MEMBERS = 256  # entities of one block of a covariance matrix


def annualised_covariance(panel: DataFrame, key: str, date: str, value: str, scale: int = 252, members: int = BLOCK_MEMBERS) -> DataFrame:
    """Covariance of every pair of entities over complete dates: ``A, B, COV`` (both triangles).

    A date counts only when every entity has a value on it.  Entities are dealt to blocks by a hash; the values of a block on a
    date are one vector, and a task adds up the outer products of two blocks over the dates.  No pair of rows is ever formed,
    and a task holds ``members`` squared numbers a pair of blocks, however many entities there are.
    """
    rows = panel.where(F.col(value).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("K"), F.col(date).alias("D"), F.col(value).cast("double").alias("V"))
    entities = rows.agg(F.count_distinct("K")).first()[0]
    blocks = max(1, -(-entities // members))
    complete = rows.groupBy("D").agg(F.count(F.lit(1)).alias("N")).where(F.col("N") == entities).select("D")
    placed = rows.join(complete, "D", "left_semi").groupBy("D", F.pmod(F.xxhash64("K"), F.lit(blocks)).cast("int").alias("I"))
    vectors = placed.agg(F.sort_array(F.collect_list(F.struct("K", "V"))).alias("S"))
    vectors = vectors.select("D", "I", F.transform("S", lambda s: s["K"]).alias("A"), F.transform("S", lambda s: s["V"]).alias("X"))
    other = vectors.select("D", F.col("I").alias("J"), F.col("A").alias("B"), F.col("X").alias("Y"))
    pairs = vectors.join(other, "D").where("I <= J").repartition("I", "J")

    def outer_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], list] = {}

        def table() -> Iterator[pd.DataFrame]:
            for a, b, n, sx, sy, sxy in sums.values():
                yield pd.DataFrame({"A": np.repeat(a, len(b)), "B": np.tile(b, len(a)), "N": n, "SX": np.repeat(sx, len(b)), "SY": np.tile(sy, len(a)), "SXY": sxy.ravel()})
            sums.clear()

        for pdf in batches:
            for at, part in pdf.groupby(["I", "J"]):
                x, y = np.stack(part["X"].to_numpy()), np.stack(part["Y"].to_numpy())
                if at not in sums and len(sums) >= 16:
                    yield from table()
                own = sums.setdefault(at, [list(part["A"].iloc[0]), list(part["B"].iloc[0]), 0, 0.0, 0.0, 0.0])
                own[2:] = [own[2] + len(x), own[3] + x.sum(axis=0), own[4] + y.sum(axis=0), own[5] + x.T @ y]
        yield from table()

    kind = dict(rows.dtypes)["K"]
    sums = pairs.select("I", "J", "A", "B", "X", "Y").mapInPandas(outer_sums, f"A {kind}, B {kind}, N bigint, SX double, SY double, SXY double")
    sums = sums.groupBy("A", "B").agg(*[F.sum(c).alias(c) for c in ("N", "SX", "SY", "SXY")])
    cov = safe_div(F.col("SXY") - F.col("SX") * F.col("SY") / F.col("N"), F.col("N") - 1) * scale
    half = sums.select("A", "B", cov.alias("COV"))
    spread_over = F.pmod(F.xxhash64("A"), F.lit(blocks)) != F.pmod(F.xxhash64("B"), F.lit(blocks))  # inside a block both triangles are there
    return half.unionByName(half.where(spread_over).select(F.col("B").alias("A"), F.col("A").alias("B"), "COV"))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "RANK_NO") -> DataFrame:
    """First ``k`` rows of each group in a unique order."""
    return row_numbers(df, keys, order, out).where(F.col(out) <= k)


def listed(column: str, separator: str = ",") -> Column:
    """Values of a group as sorted text."""
    return F.array_join(F.array_sort(F.collect_list(column)), separator)


def non_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are null throughout (one aggregate pass)."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def relaxed_union(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Append with the stored column order and types; columns missing on either side are null, new ones go last."""
    types = dict(stored.dtypes)
    aligned = new.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in new.columns])
    return stored.unionByName(aligned, allowMissingColumns=True)


def mean_pivot(df: DataFrame, index: Sequence[str], columns: str, value: str, names: Sequence[str], how: str = "avg") -> DataFrame:
    """Pivot with a fixed column list (mean by default)."""
    agg = getattr(F, how)
    return df.groupBy(*index).pivot(columns, list(names)).agg(agg(value))


def split_name(df: DataFrame, column: str, first: str, second: str, separator: str = "_") -> DataFrame:
    """``IR_3M`` -> ``IR`` and ``3M`` (cut at the last separator)."""
    return df.withColumns({first: F.regexp_extract(column, f"^(.*){separator}[^{separator}]+$", 1), second: F.substring_index(column, separator, -1)})
