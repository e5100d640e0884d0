"""Rows that travel packed: the rows of a group that a task holds are one row with compressed columns.

A row that travels by itself costs its strings and eight bytes a number; packed, sorted and compressed it costs a few bytes.  A task
that has all packs of a group works on plain arrays, and the rows it makes of them do not travel any more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from navloom.session import cut_lineage

PACK_ROWS = 1_000_000  # rows a task holds before it packs them


def coded(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the values (a null is a value) and the values."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    d = pc.dictionary_encode(whole, null_encoding="encode")
    d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def numbered(codes: Sequence[np.ndarray], rows: int) -> np.ndarray:
    """One number for each combination of codes, from nought on."""
    out = np.zeros(rows, dtype=np.int64)
    for c in codes:
        out = np.unique(out * (int(c.max(initial=0)) + 1) + c, return_inverse=True)[1]
    return out


def pack(df: DataFrame, keys: Sequence[str], first: str, value: str) -> DataFrame:
    """``keys, _ROWS, _PACK``, stored: the rows of ``df`` by ``keys``, sorted by ``first``; ``value`` is a double, which may be an amount of cents."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_ROWS", T.LongType()), T.StructField("_PACK", T.BinaryType())])

    def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = numbered([coded(table[k])[0] for k in keys], table.num_rows)
        code, names = coded(table[first])
        place = np.empty(len(names), dtype=np.int64)
        place[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        order = np.lexsort((place[code], group))
        table, group = table.take(pa.array(order)), group[order]
        ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) + 1
        starts = np.append(0, ends[:-1])
        found = table.select(keys).take(pa.array(starts)).combine_chunks()
        blobs = [_blob(table.select(rest).slice(a, b - a), value) for a, b in zip(starts.tolist(), ends.tolist())]
        columns = [found[k].combine_chunks() for k in keys]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(ends - starts), pa.array(blobs, pa.binary())], names=[*keys, "_ROWS", "_PACK"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield from packed(pa.Table.from_batches(held))
                held, rows = [], 0
        if held:
            yield from packed(pa.Table.from_batches(held))

    return cut_lineage(df.mapInArrow(run, schema))


def _blob(table: pa.Table, value: str) -> bytes:
    """Strings by number, an amount of cents as a whole number where that loses nothing."""
    columns = {}
    for name in table.column_names:
        column = table[name].combine_chunks()
        if name == value:
            plain = column.fill_null(0.0).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                cents = np.rint(plain * 100)
                whole = (np.abs(cents) < 2.0**52) & (cents / 100 == plain) & ~((plain == 0) & np.signbit(plain))
            columns[name] = pa.array(cents.astype(np.int64), mask=column.is_null().to_numpy(zero_copy_only=False)) if whole.all() else column
            continue
        code, names = coded(column)
        small = next(t for t in (np.int8, np.int16, np.int32, np.int64) if len(names) <= np.iinfo(t).max)
        columns[name] = pa.DictionaryArray.from_arrays(pa.array(code.astype(small)), names)
    out = pa.BufferOutputStream()
    batch = pa.record_batch(columns)
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpacked(blobs: Sequence[bytes], value: str) -> pa.Table:
    """The rows of packs, with plain columns."""
    tables = []
    for blob in blobs:
        with pa.ipc.open_stream(blob) as reader:
            t = reader.read_all()
        columns = {}
        for name in t.column_names:
            column = t[name]
            if name != value:
                column = column.cast(column.type.value_type)
            elif pa.types.is_integer(column.type):
                column = pc.divide(column.cast(pa.float64()), 100.0)
            columns[name] = column
        tables.append(pa.table(columns))
    return pa.concat_tables(tables)


def half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Doubles rounded half away from zero in their shortest decimal form, as Spark's ``round`` does."""
    scale = 10.0**digits
    with np.errstate(invalid="ignore", over="ignore"):
        y = np.abs(x) * scale
        out = np.floor(y + 0.5) / scale
        part = y - np.floor(y)
        doubtful = np.isfinite(x) & ((np.abs(part - 0.5) < np.maximum(1e-6, y * 1e-12)) | (y > 1e14))
    out = np.copysign(out, x) + 0.0
    if doubtful.any():
        values, back = np.unique(x[doubtful], return_inverse=True)
        step = Decimal(1).scaleb(-digits)
        each = [float(Decimal(repr(v)).quantize(step, ROUND_HALF_UP)) if abs(v) < 1e20 else v for v in values.tolist()]
        out[doubtful] = np.array(each, dtype=float)[back]
    return np.where(np.isfinite(x), out, x)


def mean_rank_fraction(values: np.ndarray, group: np.ndarray, known: np.ndarray) -> np.ndarray:
    """``ranks.rank_fraction`` over arrays: mean-tie rank in the group over the known values there; NaN where ``known`` is false."""
    out = np.full(len(values), np.nan)
    at = np.flatnonzero(known)
    if not len(at):
        return out
    v, g = values[at], group[at]
    order = np.lexsort((v, g))
    v, g = v[order], g[order]
    new_group = np.append(True, g[1:] != g[:-1])
    same = (v[1:] == v[:-1]) | ((v[1:] != v[1:]) & (v[:-1] != v[:-1]))
    new_run = new_group | np.append(True, ~same)
    run, block = np.cumsum(new_run) - 1, np.cumsum(new_group) - 1
    run_start, block_start = np.flatnonzero(new_run), np.flatnonzero(new_group)
    run_size, block_size = np.diff(np.append(run_start, len(v))), np.diff(np.append(block_start, len(v)))
    before = run_start[run] - block_start[block]
    out[at[order]] = (before + (run_size[run] + 1) / 2) / block_size[block]
    return out
