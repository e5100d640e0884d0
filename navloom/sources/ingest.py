"""Loading and keeping tables: upsert, watermark loads, tombstones, partitioned writes.

A table is a parquet dataset.  Parquet has no row-level merge, so a change rewrites the touched partitions: the merged rows are
first written to the shared folder, a note beside the table names them, and then they replace the partitions.  A job that dies
while it replaces leaves the note; the next change of the table first finishes what the note says.  The change is not atomic
across partitions for readers; running it again with the same batch gives the same table.  Tables that readers must see whole, or whose batches
touch few keys, are kept with versions (:mod:`navloom.sources.versions`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.operators.aggregates import keep_last, relaxed_union
from navloom.session import shared_dir
from navloom.sources import versions

BATCH_ROWS = 10_000  # fixed value: rows per statement of a database write


def normalise(df: DataFrame) -> DataFrame:
    """Dates to timestamps of microseconds, infinities and the text "inf" to null."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when((F.abs(c) != F.lit(float("inf"))) & ~F.isnan(c), c)
        elif isinstance(f.dataType, T.StringType):
            c = F.when(~F.lower(c).isin("inf", "-inf"), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def merge_rows(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool = False) -> DataFrame:
    """Upsert: rows of the batch replace stored rows with the same key; within the batch the last by ``order`` wins.

    ``newest`` compares with the stored row too, so that a late batch does not undo a newer one.
    """
    if not order:
        raise ValueError("an upsert needs the order that makes one row of a key the last")
    latest = keep_last(batch, list(keys), order)
    if newest:
        return keep_last(relaxed_union(stored, latest), list(keys), order)
    return _replaced(stored, latest, keys)


def _replaced(stored: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    return relaxed_union(stored.join(latest.select(*keys), list(keys), "left_anti"), latest)


def insert_missing(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert-ignore: only rows whose key is not stored yet, of a key in the batch the first by ``order``."""
    rest = [c for c in batch.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")
    fresh = first.select(*[c for c in batch.columns if c in stored.columns]).join(stored.select(*keys), list(keys), "left_anti")
    return relaxed_union(stored, fresh)


def after_watermark(source: DataFrame, column: str, target: DataFrame) -> DataFrame:
    """Source rows from the target's highest mark on (inclusive: the last batch is read again and deduplicated by key)."""
    mark = F.broadcast(target.agg(F.max(column).alias("_MARK")))  # one row
    return source.join(mark, F.col("_MARK").isNull() | (F.col(column) >= F.col("_MARK"))).drop("_MARK")


def apply_deletes(table: DataFrame, log: DataFrame, key: str, logged: str) -> tuple[DataFrame, DataFrame]:
    """Survivors, and the removed keys that the log accounts for."""
    gone = log.select(F.col(logged).alias(key)).distinct()
    return table.join(gone, key, "left_anti"), table.select(key).join(gone, key, "left_semi")


def delete_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    return table.join(keys, keys.columns, "left_anti")


def harmonise(df: DataFrame, rename: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Vendor names to house names, technical columns dropped."""
    return df.drop(*drop).withColumnsRenamed(dict(rename))


def coverage(df: DataFrame, key: str, date: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(date).alias("START_DATE"), F.max(date).alias("END_DATE"))


@dataclass(frozen=True)
class Mirror:
    """One vendor table mirrored into a house table."""

    rename: Mapping[str, str]
    keys: Sequence[str]
    watermark: str
    drop: Sequence[str] = field(default_factory=tuple)
    codes: tuple[str, str] | None = None  # (internal id in the source, house code column)


def mirror(source: DataFrame, target: DataFrame, job: Mirror, codes: DataFrame | None = None) -> DataFrame:
    """Rows of one incremental load, ready to be merged: watermark, code lookup, house names, one row per key."""
    renamed = harmonise(source, job.rename, job.drop)
    fresh = after_watermark(renamed, job.watermark, target)
    if job.codes and codes is not None:
        inner, house = job.codes
        fresh = fresh.join(codes.select(F.col(inner), F.col(house)), inner).drop(inner)
    return keep_last(fresh, list(job.keys), [job.watermark])


# --- datasets on the file system ---


BUCKET = "_BUCKET"  # partition column of tables that have none of their own


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _note(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The rows written to the shared folder and read back; the files go when the block ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int = 8) -> DataFrame:
    """Adds the partition column ``BUCKET``, a hash of the key, so that a change touches a part of a table."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table, with versions or without."""
    if versions.exists(spark, path):
        return versions.read(spark, path)
    finish_pending(spark, path)
    return spark.read.parquet(path).drop(BUCKET)


def _replace(rows: DataFrame, path: str, partition: Sequence[str]) -> None:
    writer = rows.write.mode("overwrite")
    if partition:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition)
    writer.parquet(path)


def finish_pending(spark: SparkSession, path: str) -> None:
    """Do what the note of an interrupted change says; without a note nothing."""
    if not _exists(spark, _note(path)):
        return
    lines = spark.read.text(_note(path)).collect()
    try:
        note = json.loads("".join(r[0] for r in lines))
    except ValueError:  # the job died while it wrote the note, the table is untouched
        _remove(spark, _note(path))
        return
    if _exists(spark, note["rows"]):
        _replace(spark.read.schema(T.StructType.fromJson(note["schema"])).parquet(note["rows"]), path, note["partition"])
    _remove(spark, _note(path))
    _remove(spark, note["rows"])


def _publish(rows: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Rows that a plan makes from the dataset itself: written aside, noted, then put in place."""
    spark = rows.sparkSession
    aside = f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    fs, note = _file_system(spark, _note(path))
    out = fs.create(note, True)
    out.write(bytearray(json.dumps({"rows": aside, "partition": list(partition), "schema": rows.schema.jsonValue()}).encode()))
    out.close()
    finish_pending(spark, path)


def write_dataset(
    df: DataFrame, path: str, partition: Sequence[str] = (), action: str = "update", keys: Sequence[str] = (), excluded: Sequence[str] = (), order: Sequence[str] = (), newest: bool = False
) -> None:
    """Write rows to a parquet dataset.

    ``update`` merges by key into the touched partitions only, the last row of a key by ``order`` first (``newest``: compared
    with the stored row too); ``overwrite`` replaces those partitions (the whole dataset when it has none); ``skip`` leaves an
    existing dataset alone.
    """
    if action not in ("update", "overwrite", "skip"):
        raise ValueError(f"unknown action {action}")
    spark = df.sparkSession
    finish_pending(spark, path)
    present = _exists(spark, path)
    if present and action == "skip":
        return
    rows = df
    if action == "update":
        if not keys or not order:
            raise ValueError("update needs the unique key, and the order that makes one row of a key the last")
        rows = keep_last(rows, list(keys), order)
    rows = rows.drop(*excluded)
    if not (present and action == "update"):
        _replace(rows, path, partition)
        return
    with staged(rows) as batch:
        stored = spark.read.parquet(path)
        if partition:
            stored = stored.join(batch.select(*partition).distinct(), list(partition), "left_semi")
        _publish(merge_rows(stored, batch, keys, order, newest=True) if newest else _replaced(stored, batch, keys), path, partition)


def export_snapshot(df: DataFrame, path: str, date: str, day: str) -> None:
    """One date's rows into its own partition."""
    write_dataset(df.where(F.col(date) == F.to_date(F.lit(day))), path, [date], "overwrite")


def load_incremental(source: DataFrame, path: str, job: Mirror, codes: DataFrame | None = None) -> int:
    """Mirror job against a stored table (:mod:`navloom.sources.versions`); the new version's number.

    The watermark comes from the table's manifest, so the stored rows are not read for it, and a load rewrites the files that hold its keys.
    """
    spark = source.sparkSession
    of_type = dict(harmonise(source, job.rename, job.drop).dtypes)[job.watermark]
    target = spark.range(1).select(versions.highest_mark(spark, path, of_type).alias(job.watermark))
    return versions.upsert(mirror(source, target, job, codes), path, job.keys, [job.watermark], mark=job.watermark)


def copy_table(source: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Whole table into another store, merged by key."""
    write_dataset(bucketed(source, keys), path, [BUCKET], "update", keys, order=order)


def write_query(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Append to a database table; needs the vendor's JDBC driver."""
    df.write.option("batchsize", BATCH_ROWS).jdbc(url, table, mode="append", properties=dict(properties or {}))
