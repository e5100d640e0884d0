"""Running totals and running linear recurrences over event tables whose groups have no size bound.

A group is cut into blocks of consecutive rows.  Each block is worked on alone; the few block results of a group are then
chained, and the block's starting value is added back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.operators.ranks import _same, row_numbers

BLOCK = 100_000  # rows of one block


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], block: int = BLOCK) -> DataFrame:
    """Adds the row number ``RN``, the group size ``N`` and the block number ``BLOCK``; ``order`` must be unique in a group."""
    rows = row_numbers(df, keys, order, "RN", "N")
    return rows.withColumn("BLOCK", F.floor((F.col("RN") - 1) / block))


def running_total(rows: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` in the order of ``RN`` (rows from ``numbered``)."""
    inside = Window.partitionBy(*keys, "BLOCK").orderBy("RN").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("BLOCK").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys, "BLOCK").agg(F.sum(value).alias("_SUM"))
    starts = starts.withColumn("_START", F.coalesce(F.sum("_SUM").over(before), F.lit(0.0))).drop("_SUM")
    local = rows.withColumn(out, F.sum(value).over(inside))
    joined = local.alias("l").join(starts.alias("s"), _same("l", "s", [*keys, "BLOCK"]))
    return joined.select("l.*", "s._START").withColumn(out, F.col(out) + F.col("_START")).drop("_START")


STEPS = 256  # steps that one array holds; a fold copies the array that it grows at every step


def _solved(steps: DataFrame, keys: Sequence[str], steps_a_block: int, levels: int) -> DataFrame:
    """``keys, POS, BEFORE, AFTER, ROW`` of x <- A * x + B from x = 0 along ``POS`` (from 0 on, without gaps).

    Linear steps compose, so a block of steps is one step of the next level; a level has one array of bounded length per block.
    ``levels`` levels reach ``steps_a_block ** levels`` rows of one key.
    """
    packed = steps.withColumn("_BLOCK", F.floor(F.col("POS") / steps_a_block)).groupBy(*keys, "_BLOCK").agg(F.array_sort(F.collect_list(F.struct("POS", "A", "B", "ROW"))).alias("S"))
    if levels > 1:
        both = F.aggregate("S", F.struct(F.lit(1.0).alias("A"), F.lit(0.0).alias("B")), lambda acc, s: F.struct((s["A"] * acc["A"]).alias("A"), (s["A"] * acc["B"] + s["B"]).alias("B")))
        above = packed.select(*keys, F.col("_BLOCK").alias("POS"), both.alias("P")).select(*keys, "POS", "P.A", "P.B", F.lit(None).cast("int").alias("ROW"))
        starts = _solved(above, keys, steps_a_block, levels - 1).select(*keys, F.col("POS").alias("_BLOCK"), F.col("BEFORE").alias("START"))
        packed = packed.alias("p").join(starts.alias("s"), _same("p", "s", [*keys, "_BLOCK"])).select("p.*", "s.START")
    else:
        packed = packed.withColumn("START", F.lit(0.0))
    kind = dict(steps.dtypes)["ROW"]
    empty = F.array().cast(f"array<struct<POS:bigint,BEFORE:double,AFTER:double,ROW:{kind}>>")

    def step(acc, s):
        after = s["A"] * acc["x"] + s["B"]
        done = F.struct(s["POS"].alias("POS"), acc["x"].alias("BEFORE"), after.alias("AFTER"), s["ROW"].alias("ROW"))
        return F.struct(after.alias("x"), F.concat(acc["done"], F.array(done)).alias("done"))

    done = F.aggregate("S", F.struct(F.col("START").alias("x"), empty.alias("done")), step, lambda acc: acc["done"])
    return packed.select(*keys, F.explode(done).alias("D")).select(*keys, "D.*")


def linear_recurrence(rows: DataFrame, keys: Sequence[str], a: Column, b: Column, out: str, block: int = STEPS) -> DataFrame:
    """x_t = a_t * x_(t-1) + b_t from x = 0 in the order of ``RN`` (rows from ``numbered``): columns ``out`` and ``{out}_before``."""
    names = [f"_K{k}" for k in range(len(keys))]
    size = min(block, STEPS)
    levels = 4 if size == STEPS else 8
    steps = rows.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], (F.col("RN") - 1).cast("long").alias("POS"), a.cast("double").alias("A"), b.cast("double").alias("B"), F.struct(*rows.columns).alias("ROW")
    )
    return _solved(steps, names, size, levels).select("ROW.*", F.col("AFTER").alias(out), F.col("BEFORE").alias(f"{out}_before"))
