"""Spans of regular expressions as arrays, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,hit:string>>"


#: Matches that one fold goes through; an array that grows in a fold is copied at every step.
CHUNK = 256


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; inside a lambda function an expression is computed at every call."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spans_of(text: Column, pattern: str, wanted: Column | None = None) -> Column:
    """Leftmost matches that do not overlap: ``start`` and ``end`` in code points, and the text ``hit``.

    The pieces between the matches and the matches themselves give the positions; both come from the same search.  They are added up
    in chunks, each from 0, and the lengths of the chunks before are added to them, so time grows with the number of matches.  Where
    ``wanted`` is false the text is not read.
    """
    pairs = F.arrays_zip(F.split(text, F.lit(pattern), -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.coalesce(F.length(pair["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.when(pair["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    def chunks(p: Column) -> Column:
        each = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / CHUNK).cast("int"))
        return F.transform(each, lambda c: F.aggregate(F.slice(p, c * CHUNK + 1, F.lit(CHUNK)), start, add))

    def placed(done: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        before = F.aggregate(done, zero, lambda acc, d: F.struct((acc["at"] + d["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        moved = lambda s, o: F.struct((s["start"] + o).alias("start"), (s["end"] + o).alias("end"), s["hit"].alias("hit"))
        return F.flatten(F.zip_with(done, before, lambda d, o: F.transform(d["out"], lambda s: moved(s, o))))

    found = _with(pairs, lambda p: _with(chunks(p), placed))
    there = text.rlike(pattern) if wanted is None else F.coalesce(wanted, F.lit(False)) & text.rlike(pattern)
    return F.when(there, found).otherwise(F.array().cast(SPAN))


def labelled(spans: Column, kind: str, place: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then by the order of the kinds, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
