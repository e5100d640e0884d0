"""Registry of queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its oracle, with derived views written in front of it."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = fx.with_views(sql, extra)
        return fn

    return wrap


def r6(name: str, digits: int = 6):
    return F.round(F.col(name), digits).alias(name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and drop the sign of zero."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def nav_panel(df: DataFrame) -> DataFrame:
    return df.select("TICKER_SYMBOL", "END_DATE", F.col("ADJ_NAV").alias("NAV"))


def half_up(expr: str, digits: int) -> str:
    """Oracle text that rounds the shortest decimal form of a double half away from zero, as Spark's ``round`` does."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"
