"""Session settings and the few helpers that run a job while a plan is being built."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_SIDE_ROWS = 100_000


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("navloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("NAVLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees: the one the cluster names, or a fresh one where none is set (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    fresh = tempfile.mkdtemp(prefix="navloom-")
    spark.conf.set("spark.checkpoint.dir", fresh)
    return fresh


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def pin_small(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame | None:
    """The rows of a small dimension as a local relation, or None when it has more than ``max_rows`` rows.

    At most ``max_rows + 1`` rows ever reach the driver, so the check is safe on a table of any size.  Callers must
    have another way for the None case.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def broadcast_checked(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame | None:
    pinned = pin_small(df, max_rows)
    return None if pinned is None else F.broadcast(pinned)
