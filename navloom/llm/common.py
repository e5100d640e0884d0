"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.session import cut_lineage

#: ASCII blanks; everything else is part of a word.
BLANK = r"[\x20\x09-\x0D]"
#: Rows up to which a measured table is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns of a row in one struct named ``row``, so that no name of the input can clash with a working column."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The table, computed once into the shared folder, and its number of rows."""
    kept = cut_lineage(df)
    return kept, kept.count()


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
