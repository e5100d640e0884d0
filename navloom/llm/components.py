"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.session import cut_lineage


def _smallest(links: DataFrame) -> DataFrame:
    """Each link (u, v) with the smallest of u and all its neighbours; a join that adaptive execution can split at a hub."""
    least = links.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest reachable id) of every id in ``links`` (columns ``a``, ``b``); a loop links an id with itself.

    Each round replaces the links by at most as many; they end as a star around each smallest id.  Null ends are left
    out.  No links: no rows.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    ids = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    stars = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        small = _smallest(large)
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).union(small.select("u", F.col("least").alias("v"))).where("u <> v").distinct()
        stars = cut_lineage(small)
        seen = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state:
            break
        state = seen
    return ids.join(stars.select(F.col("u").alias("id"), F.col("v").alias("least")), "id", "left").select("id", F.coalesce("least", "id").alias("component"))
