"""Reading tables: parquet, SQL over files, JDBC, delimited text; generic filters and lookups."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY, LAST_DAY = "1990-01-01", "2099-12-31"  # fixed values: default date bounds
CHUNK_IDS, READ_PARTITIONS = 500_000, 16  # fixed values: ids per chunk and partitions of a database read


def read_table(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Mapping[str, Sequence] | None = None,
    date: str | None = None,
    start: str | None = None,
    end: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Fixed columns, optional key lists and date bounds, optional order; every part reaches the scan as a filter."""
    for key, allowed in (keys or {}).items():
        if allowed:
            df = df.where(F.col(key).isin(list(allowed)))
    if date and (start or end):
        df = df.where(F.col(date).between(F.to_date(F.lit(start or FIRST_DAY)), F.to_date(F.lit(end or LAST_DAY))))
    df = df.select(*columns) if columns else df
    return df.orderBy(*order) if order else df


def read_nav(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """NAV panel from a dataset partitioned by END_DATE: three columns, date bounds prune partitions."""
    df = spark.read.schema("TICKER_SYMBOL string, ADJ_NAV double, END_DATE date").parquet(path)
    bounded = read_table(df, date="END_DATE", start=start, end=end)
    return bounded.select("TICKER_SYMBOL", "END_DATE", F.col("ADJ_NAV").alias("NAV"))


def sql_over_parquet(spark: SparkSession, path: str, query: str) -> DataFrame:
    """``query`` names the dataset as ``{data}``."""
    return spark.sql(query, data=spark.read.parquet(path))


def read_query(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    """One query against a database; needs the vendor's JDBC driver on the class path."""
    return spark.read.jdbc(url, f"({sql}) q", properties=dict(properties or {}))


def partition_options(column: str, lower: int, upper: int, partitions: int = READ_PARTITIONS) -> dict[str, str]:
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}


def read_partitioned(spark: SparkSession, url: str, sql: str, column: str, lower: int, upper: int, partitions: int = READ_PARTITIONS) -> DataFrame:
    """Parallel database read split on a numeric column."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({sql}) q")
    return reader.options(**partition_options(column, lower, upper, partitions)).load()


def id_ranges(column: str, first: int, last: int, step: int = CHUNK_IDS) -> list[str]:
    """Predicates that cover [first, last] in chunks of ``step`` ids."""
    return [f"{column} BETWEEN {lo} AND {min(lo + step - 1, last)}" for lo in range(first, last + 1, step)]


def read_chunked(spark: SparkSession, url: str, table: str, column: str, first: int, last: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, predicates=id_ranges(column, first, last), properties=dict(properties or {}))


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Attach ``columns`` of a dimension by key for all rows at once; unknown keys give nulls."""
    wanted = dim.select(*[F.col(d).alias(k) for k, d in on.items()], *columns)
    return df.join(wanted, list(on), "left")


def predicate_sql(text: str) -> str:
    """House spelling of a stored predicate (``==``, double quotes) to SQL."""
    return text.replace("==", "=").replace('"', "'")


def stored_predicates(df: DataFrame, predicates: Mapping[str, str], tag: str = "PORTFOLIO_NAME") -> DataFrame:
    """Rows that satisfy each named predicate, tagged with its name.

    All predicates are evaluated in one pass over the table: each row carries the array of the names it satisfies.
    """
    hits = F.array_compact(F.array(*[F.when(F.expr(predicate_sql(p)), F.lit(n)) for n, p in predicates.items()]))
    return df.withColumn(tag, F.explode(hits))


def clean_headers(df: DataFrame) -> DataFrame:
    """Lower case, without ``.()``, blanks to underscores."""
    return df.toDF(*[re.sub(r"\s", "_", re.sub(r"[.()]", "", c.strip().lower())) for c in df.columns])


def read_delimited(spark: SparkSession, path: str, schema: str, rename: Mapping[str, str], date_format: str, separator: str = ";") -> DataFrame:
    """One broker file to the ledger's column names; the columns keep the order of ``schema``."""
    df = spark.read.csv(path, sep=separator, header=True, schema=schema, dateFormat=date_format)
    return df.withColumnsRenamed(dict(rename))


def merge_ledgers(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in frames])
