"""Exact duplicates: a 128-bit content hash finds the groups, a comparison of the bytes excludes collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import BLANK, quoted, text_of, whole_row
from navloom.session import cut_lineage


def _rank(length: Column, key: Column) -> Column:
    """Length first, then the smallest id, in one decimal that a hash aggregate can keep; no id ranks last."""
    place = F.coalesce(F.expr("9223372036854775808BD").cast("decimal(20,0)") - key.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (length.cast("decimal(12,0)") * F.expr("100000000000000000000BD") + place).cast("decimal(38,0)")


def _ranked_id(rank: Column) -> Column:
    place = F.pmod(rank, F.expr("100000000000000000000BD"))
    return F.when(place > 0, (F.expr("9223372036854775808BD").cast("decimal(20,0)") - place).cast("long"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 128) -> DataFrame:
    """One row per input row: ``row`` (the input row as a struct), ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are, blanks left out; of equal texts the longest stays, then the one with the
    smallest id.  The group table is built from texts that every task has already reduced to its distinct ones, so a
    group of a third of all rows reaches the shuffle as one row per task; it comes back to the rows by an equi-join
    that adaptive execution can split.  Texts are joined by their bytes only under a hash that two texts share.

    Null text: empty.  Null id: a row of its own that is kept only if its whole group has no id.  A row that repeats
    another (same id, equal text) gets the same answer.  Empty table: no rows.  Other columns travel in ``row``.
    ``hash_bits`` below 128 makes collisions likely and serves to test them.
    """
    text = text_of(text_col)
    bare = F.regexp_replace(text, BLANK, "")
    sha = F.sha2(bare, 256)
    rows = docs.select(whole_row(docs), F.col(quoted(id_col)).alias("id"), bare.alias("bare"), sha.alias("sha"), F.length(text).alias("length"))
    rows = rows.withColumn("hash", F.substring("sha", 1, hash_bits // 4))
    texts = rows.groupBy("hash", "bare").agg(F.count(F.lit(1)).alias("n"), F.max(_rank(F.col("length"), F.col("id"))).alias("best"))
    groups = cut_lineage(texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts"), F.max("n").alias("n"), F.max("best").alias("best")))
    found = rows.select("row", "id", "sha", "hash").join(groups.where("texts = 1"), "hash")
    shared = groups.where("texts > 1").select("hash")
    if not shared.isEmpty():
        apart = rows.join(shared, "hash").join(texts.join(shared, "hash", "left_semi"), ["hash", "bare"])
        found = found.select("row", "id", "sha", "n", "best").unionByName(apart.select("row", "id", "sha", "n", "best"))
    keep = _ranked_id(F.col("best"))
    return found.select("row", keep.alias("keep_id"), F.col("n").alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))
