"""Structured Streaming forms of the incremental jobs.

Every job reads a file stream and keeps a parquet dataset; results never pass through the driver.  Progress and state live under
``checkpoint``, which must be in a folder all executors share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from navloom.operators.aggregates import keep_last
from navloom.sources import versions
from navloom.sources.ingest import staged, write_dataset

WATERMARK = "5 days"  # fixed value: how late a correction may be (trailing days of the daily re-run)
#: Groups of entities that share a state; a call costs some milliseconds, whatever it holds, so entities do not get one each.
ENTITY_GROUPS = 1024


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over the parquet files of a folder or glob pattern, with the schema of the files already there.

    A batch takes all files that are there, or at most ``files_per_batch``.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with time zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def run(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "update") -> None:
    """Work off everything available, then stop."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
    query.awaitTermination()


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append-only results straight to a file sink."""
    query = df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def upsert_latest(path: str, keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Keep the newest row per key over all batches; running a batch twice changes nothing."""

    def each(batch: DataFrame, _: int) -> None:
        versions.upsert(batch, path, keys, order, newest=True)

    return each


def upsert_rows(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Rows of the batch replace stored rows with the same key: results of an aggregation by that key in update mode, so the
    key is unique in a batch and any order will do."""

    def each(batch: DataFrame, _: int) -> None:
        versions.upsert(batch, path, keys, list(keys))

    return each


def tumbling_bars(ticks: DataFrame, minutes: int, delay: str = WATERMARK) -> DataFrame:
    """Right-closed bars from a stream of trades (``code, trade_time, seq, price, amount``)."""
    at = F.struct("trade_time", "seq")
    marked = with_event_time(ticks, "trade_time").withWatermark("trade_time", delay)
    return (
        marked.groupBy("code", F.window(F.col("trade_time") - F.expr("INTERVAL 1 MICROSECOND"), f"{minutes} minutes").alias("w"))
        .agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("amount").alias("amount"))
        .select("code", F.col("w.end").alias("trade_time"), "open", "high", "low", "close", "amount")
    )


def sliding_mean(df: DataFrame, time: str, value: str, size: str, slide: str, keys: Sequence[str] = (), delay: str = WATERMARK) -> DataFrame:
    marked = with_event_time(df, time).withWatermark(time, delay)
    out = marked.groupBy(*keys, F.window(time, size, slide).alias("w")).agg(F.avg(value).alias("MEAN"), F.count(value).alias("N"))
    return out.select(*keys, F.col("w.start").alias("WINDOW_START"), F.col("w.end").alias("WINDOW_END"), "MEAN", "N")


def running_drawdown(df: DataFrame, key: str, time: str, seq: str, value: str) -> DataFrame:
    """Running high and drawdown per entity; the high is carried from batch to batch as state.

    A micro-batch is bounded by the number of files it takes, and so are the rows of one entity that are ordered at a time.
    """

    def step(tag: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values([time, seq])
        before = state.get[0] if state.exists else float("-inf")
        high = rows[value].cummax().clip(lower=before)
        state.update((float(high.iloc[-1]),))
        yield pd.DataFrame({key: tag[0], seq: rows[seq], "HIGH": high, "DRAWDOWN": 1 - rows[value] / high})

    types = dict(df.dtypes)
    return df.select(key, time, seq, value).groupBy(key).applyInPandasWithState(
        step, f"{key} {types[key]}, {seq} {types[seq]}, HIGH double, DRAWDOWN double", "HIGH double", "append", GroupStateTimeout.NoTimeout
    )


def corrected_drawdown(df: DataFrame, key: str, time: str, seq: str, value: str, delay: str = WATERMARK, expiry_days: int = 400, groups: int = ENTITY_GROUPS) -> DataFrame:
    """Running high and drawdown per entity in event-time order, whatever order the rows come in: ``key, seq, HIGH, DRAWDOWN``.

    The state of an entity is its high up to the watermark and the rows since then.  A row that comes late, but not later than
    ``delay``, is put in its place, and rows behind it whose high it changes are given out again: write them with
    :func:`upsert_rows` by (key, seq), and the stored rows are those of one sorted pass.  What falls behind the watermark is folded into the
    high, so the state is bounded by the rows of ``delay``; rows older than the watermark are dropped, as everywhere.  An entity without
    rows for ``expiry_days`` behind its last one loses its state and begins anew.  Rows without a time or a value are left out.

    Entities are dealt by their hash to ``groups`` (a checkpoint keeps their number), whose rows are sorted in one go; more rows inside ``delay`` ask for more groups.
    """
    types = dict(df.dtypes)
    shape = f"NAMES array<{types[key]}>, TOPS array<double>, LASTS array<bigint>, CODES array<int>, TIMES array<bigint>, SEQS array<{types[seq]}>, VALS array<double>, HIGHS array<double>"
    expiry = expiry_days * 86_400_000

    def step(tag: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, tops, lasts, *held = state.get if state.exists else ([], [], [], [], [], [], [], [])
        codes, times, seqs, values, highs = (list(x) for x in held)
        mark, of_fresh, before = state.getCurrentWatermarkMs(), [], len(codes)
        if not state.hasTimedOut:
            fresh = pd.concat(list(frames))
            of_fresh = fresh[key].tolist() if tag[0] >= 0 else [None] * len(fresh)  # rows without a key are a group
            times += (fresh[time].astype("int64") // _unit(fresh[time])).tolist()
            seqs += fresh[seq].tolist()
            values += fresh[value].tolist()
            highs += [float("nan")] * len(fresh)
        known = {n: k for k, n in enumerate(names)}
        codes += [known.setdefault(n, len(known)) for n in of_fresh]
        new = len(known) - len(names)
        names, top, last = list(known), np.array([*tops, *[float("-inf")] * new]), np.array([*lasts, *[mark] * new], dtype=np.int64)
        rows = pd.DataFrame({"CODE": np.array(codes, dtype=np.int64), "TIME": np.array(times, dtype=np.int64), "SEQ": seqs, "VALUE": np.array(values, dtype=float), "BEFORE": np.array(highs, dtype=float)})
        seen = np.zeros(len(names), dtype=bool)
        seen[rows["CODE"].to_numpy()[before:]] = True
        rows = rows.sort_values(["CODE", "TIME", "SEQ"], ignore_index=True)
        code, at = rows["CODE"].to_numpy(), rows["TIME"].to_numpy()
        run = np.maximum(rows.groupby("CODE")["VALUE"].cummax().to_numpy(dtype=float), top[code])
        changed = run != rows["BEFORE"].to_numpy()  # rows that were not given out yet have no high before
        settled = at < mark
        np.maximum.at(top, code[settled], run[settled])
        last[seen] = np.maximum(last[seen], mark)
        own = seen[code]
        np.maximum.at(last, code[own], at[own])
        alive = seen | (last + expiry >= mark)
        if alive.any():
            stay, place = ~settled & alive[code], np.cumsum(alive) - 1
            kept = rows[stay]
            state.update(([n for n, a in zip(names, alive) if a], top[alive].tolist(), last[alive].tolist(), place[code[stay]].tolist(), kept["TIME"].tolist(), kept["SEQ"].tolist(), kept["VALUE"].tolist(), run[stay].tolist()))
            state.setTimeoutTimestamp(int(max(last[alive].min() + expiry, mark + 1)))
        else:
            state.remove()
        if changed.any():
            high, worth = run[changed], rows["VALUE"].to_numpy()[changed]
            yield pd.DataFrame({key: pd.Series([names[k] for k in code[changed]], dtype=None if tag[0] >= 0 else object), seq: rows["SEQ"].to_numpy()[changed], "HIGH": high, "DRAWDOWN": 1 - worth / high})

    rows = with_event_time(df.select(key, time, seq, F.col(value).cast("double").alias(value)), time).dropna(subset=[time, value])
    group = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(groups))).cast("int")
    return rows.withWatermark(time, delay).withColumn("_GROUP", group).groupBy("_GROUP").applyInPandasWithState(
        step, f"{key} {types[key]}, {seq} {types[seq]}, HIGH double, DRAWDOWN double", shape, "update", GroupStateTimeout.EventTimeTimeout
    )


def _unit(times: pd.Series) -> int:
    """Ticks of a column of times in a millisecond."""
    return {"ns": 1_000_000, "us": 1_000, "ms": 1}[getattr(times.dt, "unit", "ns")]


def enrich(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Stream of events joined to a static table of holdings."""
    return stream.join(static, key)


def without_duplicates(df: DataFrame, keys: Sequence[str], time: str, delay: str = WATERMARK) -> DataFrame:
    return with_event_time(df, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def late_corrections(
    raw: str, daily: str, date: str, key: Sequence[str], group: Sequence[str], aggregates: Sequence[Column], order: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """Merge a batch into the raw rows and compute again only the dates it touches.

    ``order`` says which of several rows of a key in one batch is the last; without it the key must be unique in a batch.
    """

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        with staged(batch) as kept:
            write_dataset(kept, raw, [date], "update", [*key, date], order=list(order) or list(key))
            touched = kept.select(date).distinct()
            rows = spark.read.schema(batch.schema).parquet(raw).join(touched, date, "left_semi")
            write_dataset(rows.groupBy(date, *group).agg(*aggregates), daily, [date], "overwrite")

    return each


def late_deltas(raw: str, daily: str, key: Sequence[str], group: Sequence[str], sums: Mapping[str, Column], order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Keep sums by group under corrections: what a stored row of the same key gave is taken back, what the new one gives is added.

    ``raw`` and ``daily`` are stored tables with versions, by ``key`` and by ``group``; ``sums`` are terms over a row, and ``N`` counts the rows of a
    group (0: all of them went elsewhere).  A batch reads and rewrites only the files that hold its keys and its groups.  The sums
    are published first, with the batch's number, and the rows after them: a batch that runs again finds its number and
    changes nothing twice.
    """
    terms = {"N": F.lit(1)} | dict(sums)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with staged(keep_last(batch, list(key), list(order) or list(key))) as kept:
            if int(versions.note(spark, daily) or -1) < number:
                both = kept.withColumn("_SIGN", F.lit(1))
                if versions.exists(spark, raw):
                    both = both.unionByName(versions.lookup(kept, raw, key).withColumn("_SIGN", F.lit(-1)))
                change = both.groupBy(*group).agg(*[F.sum(F.col("_SIGN") * F.coalesce(c, F.lit(0))).alias(n) for n, c in terms.items()])
                with staged(change) as delta:
                    old = versions.lookup(delta, daily, group) if versions.exists(spark, daily) else delta.limit(0)
                    total = delta.unionByName(old).groupBy(*group).agg(*[F.sum(n).alias(n) for n in terms])
                    versions.upsert(total, daily, group, list(group), left=str(number))
            versions.upsert(kept, raw, key, list(key))

    return each
