"""Mixing of sources to target weights by Poisson replication, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import broadcast_if_small, measured, quoted, text_of, whole_row

#: Mean of one Poisson draw; a larger rate is the sum of several draws, so that no term underflows.
DRAW_MEAN = 8.0
#: Terms of the distribution function of one draw; beyond them it is 1 in double precision for every mean up to DRAW_MEAN.
TERMS = 64


def uniform(*parts: Column) -> Column:
    """52 bits of a hash of the parts as a number in [0, 1)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, exponent: float = 0.5, total: float | None = None, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Mean number of copies of a document by source: target share times the wanted total over the source's size in code points.

    Without ``weights`` the target share is the size to the power ``exponent``, scaled to sum to one; a source
    that ``weights`` leaves out gets none.  ``total`` is the wanted size of the mixture, the size of the input by default.
    Sources without text have the rate 0.
    """
    sizes = docs.groupBy(F.col(quoted(source_col)).alias("source")).agg(F.sum(F.length(text_of(text_col))).cast("double").alias("size"))
    if weights is None:
        share = F.pow("size", F.lit(exponent))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(share)
    sizes = sizes.select("source", "size", F.when(F.col("size") > 0, share).otherwise(0.0).alias("share"))
    sums = sizes.agg(F.sum("share").alias("shares"), F.sum("size").alias("all"))
    wanted = F.col("all") if total is None else F.lit(float(total))
    rate = F.when((F.col("size") > 0) & (F.col("shares") > 0), F.col("share") / F.col("shares") * wanted / F.col("size")).otherwise(0.0)
    return sizes.crossJoin(F.broadcast(sums)).select("source", rate.alias("rate"))


def _with_draws(rates: DataFrame) -> DataFrame:
    """Draws for each rate, and the distribution function of one draw as an array."""
    draws = F.greatest(F.ceil(F.col("rate") / DRAW_MEAN), F.lit(1)).cast("int")
    rates = rates.withColumn("draws", draws).withColumn("mean", F.col("rate") / F.col("draws"))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.exp(-F.col("mean")).alias("sum"), F.array(F.exp(-F.col("mean"))).alias("below")),
        lambda acc, k: F.struct(
            (acc["p"] * F.col("mean") / k).alias("p"),
            (acc["sum"] + acc["p"] * F.col("mean") / k).alias("sum"),
            F.concat(acc["below"], F.array(acc["sum"] + acc["p"] * F.col("mean") / k)).alias("below"),
        ),
    )
    return rates.select("source", "draws", terms["below"].alias("below"))


def copies(key: Column, draws: Column, below: Column, seed: int) -> Column:
    """Poisson count: each draw is the number of values of the distribution function that its uniform number reaches."""
    one = lambda draw: F.size(F.filter(below, lambda p: p <= uniform(F.lit(str(seed)), key, draw.cast("string"))))
    return F.aggregate(F.sequence(F.lit(1), draws), F.lit(0), lambda acc, draw: acc + one(draw))


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None, exponent: float = 0.5, total: float | None = None, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Every copy of every document: ``row`` (the input row as a struct), ``copy_no`` from 1, ``shuffle_key``; dealt out at random.

    The number of copies depends on the seed, the id and the source's rate alone, so a task that runs again makes the
    same copies.  The copies are dealt to partitions by a hash of (seed, id, copy) and ordered by it inside: a global
    shuffle in which no source, however large, meets in one task.

    Null source: a source of its own.  Null text: size 0.  Null id: drawn as the id "null".  Repeated rows get the same
    number of copies.  Empty table: no rows.  A source's rate may be 0, which leaves its documents out by design.
    """
    rates, found = measured(_with_draws(source_rates(docs, weights, exponent, total, source_col, text_col)))
    rows = docs.select(whole_row(docs), F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("null")).alias("key"), F.col(quoted(source_col)).alias("from"))
    rows = rows.join(broadcast_if_small(rates, found), F.col("from").eqNullSafe(F.col("source")))
    rows = rows.select("row", "key", copies(F.col("key"), F.col("draws"), F.col("below"), seed).alias("n")).where("n > 0")
    rows = rows.select("row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy_no"))
    rows = rows.select("row", "copy_no", F.md5(F.concat_ws(":", F.lit(f"shuffle {seed}"), "key", "copy_no")).alias("shuffle_key"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return rows.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")
