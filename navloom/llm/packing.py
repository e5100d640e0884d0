"""Packing into length buckets whose bounds a dynamic program over the global histogram chooses."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.common import BLANK, broadcast_if_small, measured, quoted, text_of, whole_row

#: Rows that one window numbers; a bucket is cut into as many shards as it has this many rows.
SHARD_ROWS = 10_000


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.size(F.filter(F.split(text, BLANK + "+"), lambda w: w != "")).cast("long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding; of equal plans the one with lower bounds.

    Padding of lengths i..j in one bucket is ``length[j] * rows - tokens``, which meets the quadrangle inequality, so the
    best cut moves to the right with the end and a layer is solved by divide and conquer.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, dtype=np.float64)[order], np.asarray(counts, dtype=np.float64)[order]
    m = len(lengths)
    if m == 0:
        return []
    rows, tokens = np.concatenate(([0.0], np.cumsum(counts))), np.concatenate(([0.0], np.cumsum(counts * lengths)))
    cost = np.concatenate(([0.0], lengths * rows[1:] - tokens[1:]))  # one bucket for the first j lengths
    layers = []
    for _ in range(1, min(buckets, m)):
        new, cut = np.empty(m + 1), np.zeros(m + 1, dtype=np.int64)
        new[0] = 0.0
        todo = [(1, m, 0, m - 1)]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(left, min(right, j - 1) + 1)
            total = cost[i] + lengths[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            k = int(np.argmin(total))
            new[j], cut[j] = total[k], i[k]
            todo += [(lo, j - 1, left, int(i[k])), (j + 1, hi, int(i[k]), right)]
        layers.append(cut)
        cost = new
    bounds, j = [], m
    for cut in reversed(layers):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(cut[j])
    if j:
        bounds.append(int(lengths[j - 1]))
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 65_536, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``row``, ``n_tokens``, ``bucket``, ``bucket_length``, ``batch``, ``place``, ``padding``.

    Tokens are words.  The histogram of all lengths goes to the driver: its rows are at most the square root of twice
    the tokens of the corpus.  A batch holds as many rows as the budget has room for at the bucket's length, one at
    least, so a row longer than the budget is a batch of its own; nothing is cut.  Batches are numbered by
    ``bucket`` and ``batch``; all but the last of a bucket are full.  Rows are numbered in shards of a hash of the id, whose
    number follows the bucket's rows, and the shards' offsets make the numbering run through the bucket.

    Null or empty text: 0 tokens.  Null id: hashed as "null".  Repeated rows each get a place.  Empty table: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(whole_row(docs), word_count(text_of(text_col)).alias("n_tokens"), F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("null")).alias("key"))
    histogram = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    lengths, counts = np.array([r.n_tokens for r in histogram]), np.array([r.n for r in histogram])
    bounds = best_bounds(lengths, counts, buckets)
    at = np.searchsorted(bounds, lengths) if bounds else np.zeros(0, dtype=int)
    plan = [(b, int(bound), int(max(1, token_budget // max(bound, 1))), int(max(1, -(-counts[at == b].sum() // SHARD_ROWS)))) for b, bound in enumerate(bounds)]
    buckets_table = spark.createDataFrame(plan or [(0, 0, 1, 1)], "bucket int, bucket_length long, per_batch long, shards long")
    bucket = F.lit(0)
    for b, bound in enumerate(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") > bound, F.lit(b + 1)).otherwise(bucket)
    rows = rows.withColumn("bucket", bucket.cast("int")).join(F.broadcast(buckets_table), "bucket")
    hashed = F.xxhash64(F.lit(seed), "key")
    rows = rows.withColumn("hash", hashed).withColumn("shard", F.pmod("hash", "shards"))
    sizes = rows.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets, found = measured(sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    number = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("hash", "key", "n_tokens")) - 1
    rows = rows.withColumn("number", number).join(broadcast_if_small(offsets, found), ["bucket", "shard"])
    position = F.col("offset") + F.col("number")
    batch = F.floor(position / F.col("per_batch")).cast("long")
    return rows.select("row", "n_tokens", "bucket", "bucket_length", batch.alias("batch"), F.pmod(position, F.col("per_batch")).cast("int").alias("place"), (F.col("bucket_length") - F.col("n_tokens")).alias("padding"))
