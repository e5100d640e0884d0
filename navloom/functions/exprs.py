"""Scalar Column builders shared by every job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OVERFLOW = 1e8  # fixed value: stored numbers beyond this are treated as overflow


def safe_div(x: Column, y: Column) -> Column:
    """x / y, null when y is zero or either side is null."""
    return F.try_divide(x.cast("double"), y.cast("double"))


def clip_overflow(x: Column, limit: float = OVERFLOW) -> Column:
    """Null beyond +-limit and for NaN: the stored value of an overflow is null."""
    return F.when(F.abs(x) <= limit, x)


def simple_return(value: Column, previous: Column) -> Column:
    return safe_div(value, previous) - 1


def log_return(value: Column, previous: Column) -> Column:
    return F.ln(safe_div(value, previous))


def compound(rate_pct: Column) -> Column:
    """Growth factor of a rate held in percent."""
    return 1 + rate_pct / 100


def null_ratio_pct(x: Column, base: Column) -> Column:
    """Share of ``base`` in percent, missing value counts as 0."""
    return safe_div(F.coalesce(x, F.lit(0.0)), base) * 100


def bucket_label(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for x < edges[i]; the last label is open-ended.  Null stays null."""
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(x < edge, label)
    return out.otherwise(labels[-1])


def map_values(x: Column, mapping: Mapping[str, str], strict: bool = False) -> Column:
    """Replace categories; unmapped values are kept, or raise when ``strict``."""
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    hit = F.element_at(table, x)
    if strict:
        return F.when(x.isNull() | hit.isNotNull(), hit).otherwise(F.raise_error(F.concat(F.lit("no mapping for "), x)))
    return F.coalesce(hit, x)


def fixed_text(x: Column, digits: int = 4) -> Column:
    """Fixed decimals, empty for null or NaN."""
    return F.when(x.isNull() | F.isnan(x), "").otherwise(F.format_string(f"%.{digits}f", x))


def percent_text(x: Column, digits: int = 2) -> Column:
    return F.when(x.isNotNull(), F.concat(F.format_string(f"%.{digits}f", F.round(x, digits)), F.lit("%")))


def pad_code(x: Column, width: int = 6) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def round_floats(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column, leave the others."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name) for f in df.schema.fields]
    )


def cast_dates(df: DataFrame, fmt: str) -> DataFrame:
    """Temporal columns as text."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[F.date_format(f.name, fmt).alias(f.name) if isinstance(f.dataType, temporal) else F.col(f.name) for f in df.schema.fields]
    )


def arg_max(columns: Sequence[str]) -> Column:
    """Name of the column that holds the largest value of the row; the first one on a tie."""
    pairs = F.array(*[F.struct(F.col(c).alias("v"), F.lit(-i).alias("i"), F.lit(c).alias("name")) for i, c in enumerate(columns)])
    return F.array_max(F.filter(pairs, lambda p: p["v"].isNotNull()))["name"]
