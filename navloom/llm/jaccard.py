"""Jaccard join of word n-gram sets: rare-first prefixes with length, positional and suffix filters, one verification per pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from navloom.llm.common import BROADCAST_ROWS, broadcast_if_small, measured, quoted, text_of
from navloom.llm.components import components
from navloom.session import cut_lineage
from navloom.sources.ingest import staged

#: N-grams that a task counts at once, and most n-grams whose frequency every task is told; neither depends on the corpus.
COUNTED_AT_ONCE, FREQUENT = 1 << 22, 1 << 19
#: Length of a posting list beyond which it is dealt out to several hubs.
HOT_LIST = 50_000
#: Length of a posting list from which on its pairs meet only if they have no rarer n-gram in common.
LONG_LIST = 16


def shingles(text: str, width: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all word n-grams; a shorter text is one n-gram, a text without words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = list(map(known.get, words))
    if None in ids:
        for k, value in enumerate(ids):
            if value is None:
                ids[k] = known[words[k]] = xxhash.xxh3_64_intdigest(words[k])
    hashes = np.array(ids, dtype=np.uint64)
    span = min(width, len(hashes))
    mixed = np.zeros(len(hashes) - span + 1, dtype=np.uint64)
    for k in range(span):
        mixed = (mixed ^ hashes[k : len(hashes) - span + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed + np.uint64(span)) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def key_of(grams: np.ndarray) -> int:
    """A set's 64-bit name; sets of one name are one class."""
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


#: Rows whose sets a task holds at once, and words whose hashes it remembers.
ROWS_AT_ONCE, WORDS_KNOWN = 512, 200_000


def gram_sets(frames: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    known: dict[bytes, int] = {}
    for frame in frames:
        for cut in range(0, len(frame), ROWS_AT_ONCE):
            if len(known) > WORDS_KNOWN:
                known.clear()
            part = frame.iloc[cut : cut + ROWS_AT_ONCE].reset_index(drop=True)
            yield part, [shingles(t, width, known) for t in part["text"]]


def repeated(sets: list[np.ndarray]) -> pd.DataFrame:
    """The n-grams that several of these sets have, and how many do; equal sets count once."""
    grams = np.concatenate(list({key_of(s): s for s in sets}.values()))
    grams.sort()
    same = np.concatenate(([0], grams[1:] == grams[:-1], [0])).astype(np.int8)
    edges = np.flatnonzero(np.diff(same))
    return pd.DataFrame({"gram": grams[edges[::2]].view(np.int64), "n": edges[1::2] - edges[::2] + 1})


def frequent_grams(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted, and about how many documents have each; the last entry is a sentinel.

    Every n-gram is counted in blocks, and what stands once in a block is left there, so an n-gram of more documents than there
    are blocks is always found; rarer ones are found by chance."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for _, sets in gram_sets(frames, width):
            held += sets
            n += sum(map(len, sets))
            if n >= COUNTED_AT_ONCE:
                yield repeated(held)
                held, n = [], 0
        if n:
            yield repeated(held)

    counted = cut_lineage(docs.select("text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    level = F.floor(F.lit(8) * F.log2("n")).cast("int")  # at most some hundred levels
    least, room = 0, FREQUENT
    for r in sorted(counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r.n
        if room < 0:
            least = r.level + 1
            break
    told = counted.where(level >= least).toArrow()
    grams = np.append(told["gram"].to_numpy().view(np.uint64), np.uint64(2**64 - 1))
    order = np.argsort(grams, kind="stable")
    return grams[order], np.append(told["n"].to_numpy(), 0)[order]


def parities(grams: np.ndarray) -> np.ndarray:
    """A bit for each slot, set where an odd number of the n-grams fall, in 64-bit words; at least as many slots as n-grams, a power of two."""
    slots = 1 << max(6, (len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], width: int, percent: int) -> DataFrame:
    """By document: size, name and parity map of the set, and its prefix, n-grams that are not frequent first, then rare ones first."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = shared.value
        for frame, sets in gram_sets(frames, width):
            out: dict[str, list] = {"size": [], "key": [], "odd": [], "prefix": [], "salts": []}
            for s in sets:
                n = len(s)
                at = np.searchsorted(known, s)
                freq = np.where(known[at] == s, counts[at], 0)
                order = np.lexsort((s, freq))[: n - -(-percent * n // 100) + 1] if n else np.zeros(0, dtype=np.int64)
                out["size"].append(n)
                out["key"].append(key_of(s))
                out["odd"].append(parities(s))
                out["prefix"].append(s[order].view(np.int64))
                salts = freq[order] // HOT_LIST + 1
                out["salts"].append(salts.astype(np.int32) if (salts > 1).any() else None)
            yield pd.DataFrame({"id": frame["id"], "mark": frame["mark"]} | out)

    return docs.mapInPandas(cut, "id long, mark long, size int, key long, odd array<long>, prefix array<long>, salts array<int>")


def _needed(size_a: str, size_b: str, percent: int) -> Column:
    """Smallest number of common n-grams at which two sets of these sizes are linked."""
    return F.ceil(F.lit(percent) * (F.col(size_a) + F.col(size_b)) / F.lit(100 + percent))


def _possible(percent: int) -> Column:
    """Length and positional filter of a pair that meets at ``place_a`` and ``place_b``: what follows bounds the overlap."""
    long_enough = F.lit(100) * F.least("size_a", "size_b") >= F.lit(percent) * F.greatest("size_a", "size_b")
    room = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    return long_enough & (room >= _needed("size_a", "size_b", percent))


def _differing(a: str, b: str) -> Column:
    """Suffix filter: no fewer n-grams are in one set alone than slots whose parities differ.  The longer map is folded to the length of the shorter."""
    n = F.least(F.size(a), F.size(b))
    every = lambda x, k: F.aggregate(F.sequence(k, F.size(x) - 1, n), F.lit(0).cast("long"), lambda word, at: word.bitwiseXOR(F.get(x, at)))
    folded = lambda x: F.when(F.size(x) == n, F.col(x)).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda k: every(x, k)))
    return F.aggregate(F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, bits: total + bits)


@F.pandas_udf(IntegerType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), assume_unique=True)) for x, y in zip(a, b)], dtype="int32")


def _verified(pairs: DataFrame, heads: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are as similar as asked; only pairs that pass the suffix filter fetch their sets, each set once a pair.

    ``heads``: name, size, parity map and id of one document of each class."""
    head = lambda x: heads.select(F.col("key").alias(x), F.col("id").alias(f"id_{x}"), F.col("size").alias(f"size_{x}"), F.col("odd").alias(f"odd_{x}"))
    kept = pairs.join(head("a"), "a").join(head("b"), "b")
    apart = F.col("size_a") + F.col("size_b") - 2 * _needed("size_a", "size_b", percent)
    kept = cut_lineage(kept.where(_differing("odd_a", "odd_b") <= apart).select("a", "b", "id_a", "id_b", "size_a", "size_b"))
    side = lambda x: kept.select(F.col(x).alias("key"), F.col(f"id_{x}").alias("id"), "a", "b", "size_a", "size_b")
    asked, n = measured(side("a").union(side("b")))

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, found in gram_sets(frames, width):
            yield pd.DataFrame({"id": frame["id"], "key": [key_of(s) for s in found], "grams": [s.tobytes() for s in found]})

    texts = docs.select("id", "text").join(broadcast_if_small(asked.select("id").distinct(), n), "id", "left_semi")
    grams = texts.mapInPandas(whole, "id long, key long, grams binary").join(broadcast_if_small(asked, n), ["id", "key"])
    of = lambda x: F.min(F.when(F.col("key") == F.col(x), F.col("grams")))  # noqa: E731  rows that stand more than once have equal sets
    pairs = grams.groupBy("a", "b", "size_a", "size_b").agg(of("a").alias("grams_a"), of("b").alias("grams_b"))
    pairs = pairs.select("a", "b", "size_a", "size_b", _common("grams_a", "grams_b").alias("common"))
    return cut_lineage(pairs.where(F.col("common") >= _needed("size_a", "size_b", percent)).select("a", "b"))


def mark_of(text: str = "text") -> Column:
    """What tells the rows of one id apart."""
    return F.xxhash64(text_of(text))


def jaccard_components(rows: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``mark`` (:func:`mark_of` the text), ``n_shingles``, ``component``, ``kept`` of every row.  Ids are integers.

    Two documents link when 100 * common >= percent * union over their sets of word n-grams; a component is named by the smallest
    id that links reach, and one of its rows is ``kept``: a row with that id (of several texts, the set with the smallest name).
    Equal sets are one class.  Every class posts the prefix that a linked set must meet, in the order of an approximate
    document frequency (any order gives right results; rare first keeps the lists short).  Each posting list first compares its
    members with one hub, the member with the fewest rarer n-grams; what these links connect needs no further comparison, so a
    list of near copies costs its length and not its square.  The pairs that are left, between different components of a
    list, are then compared each once: in a long list they meet only if they share no rarer n-gram.  Links are the same as those of all pairs, up
    to 64-bit hashes.

    Null or empty text: an empty set, linked with nothing.  Null id: the row is returned with a null component and is
    linked with nothing.  Repeated rows get the same answer; several texts of one id are linked each.  Empty table: no rows.
    Other columns are not read.
    """
    docs = rows.select(F.col(quoted(id_col)).cast("long").alias("id"), text_of(text_col).alias("text"), mark_of(text_col).alias("mark"))
    frequent = frequent_grams(docs, width)
    with staged(_prefixes(docs, frequent, width, percent)) as prefixed:
        sets = cut_lineage(prefixed.select("id", "mark", "size", "key"))
        members, links = _linked(docs, prefixed, sets.where("size > 0 AND id IS NOT NULL"), width, percent)
    parts = members.join(components(links).toDF("key", "part"), "key")
    named = parts.groupBy("part").agg(F.min(F.struct("class", "key")).alias("least"))
    parts = parts.join(named, "part").select("key", F.col("least.class").alias("component"), F.col("least.key").alias("head"))
    classes = members.join(parts, "key", "left").select("key", F.coalesce("component", "class").alias("component"), F.coalesce("head", "key").alias("head"))
    found = sets.join(classes, "key", "left")
    known = F.col("id").isNotNull()
    own = F.when(known, F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("id")))
    kept = ~known | (F.col("size") == 0) | ((F.col("id") == F.col("component")) & (F.col("key") == F.col("head")))
    return found.select("id", "mark", F.col("size").cast("long").alias("n_shingles"), own.alias("component"), kept.alias("kept"))


def _heads(prefixed: DataFrame, full: DataFrame, members: DataFrame) -> DataFrame:
    """The prefixes of one row of each class, its smallest id: all rows but those that a small table of the others names."""
    others, n = measured(full.join(members, "key").where("id <> class").select("id", "key").distinct())
    chosen = prefixed.where("size > 0 AND id IS NOT NULL").join(F.broadcast(others) if n <= 5 * BROADCAST_ROWS else others, ["id", "key"], "left_anti")
    rows = full.agg(F.count(F.lit(1)).alias("all"), F.count_distinct("id", "key").alias("different")).first()
    return chosen if rows["all"] == rows.different else chosen.dropDuplicates(["key"])


def _linked(docs: DataFrame, prefixed: DataFrame, full: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (``key``, ``class``), and enough links (a, b) between their names to connect what is linked."""
    full = full.select("id", "key")
    members = full.groupBy("key").agg(F.min("id").alias("class"))
    chosen = _heads(prefixed, full, members)
    heads = cut_lineage(chosen.select("key", "id", "size", "odd"))

    posted = chosen.select("key", "size", "salts", F.posexplode("prefix").alias("place", "gram"))
    salts = F.get("salts", F.col("place"))
    posted = posted.select("key", "size", "place", "gram", F.when(salts > 1, F.pmod(F.xxhash64("key"), salts)).alias("salt"))
    by_list = Window.partitionBy("gram", "salt").orderBy("place", "key")
    first = F.first(F.struct("key", "size", "place")).over(by_list)
    posted = posted.select("*", first.alias("hub"), F.row_number().over(by_list).alias("nth"), F.lead("key").over(by_list).alias("next"))
    again = F.expr("salt IS NOT NULL OR nth > 2 OR (nth = 2 AND next IS NOT NULL)").alias("again")
    posted = posted.where("salt IS NOT NULL OR next IS NOT NULL OR nth > 1").select("key", "size", "place", "gram", "hub", again)
    with staged(posted) as listed:
        near = listed.where("key <> hub.key").select(
            F.col("hub.key").alias("a"), F.col("key").alias("b"), F.col("hub.size").alias("size_a"), F.col("size").alias("size_b"), F.col("hub.place").alias("place_a"), F.col("place").alias("place_b")
        )
        pairs = cut_lineage(near.where(_possible(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        links = _verified(pairs, heads, docs, width, percent)
        rest = cut_lineage(_between(listed.where("again"), components(links), percent).join(pairs, ["a", "b"], "left_anti"))
    return members, links.union(_verified(rest, heads, docs, width, percent))


def _between(listed: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs of one posting list that lie in different components and can still be linked.

    Sizes meet in bands whose ends have the ratio of the threshold: the larger set of a linked pair lies in the band of the
    smaller one or in the next.  Documents that share a passage meet in the list of each of its n-grams; all prefixes are in one
    order, so the entries of a long list carry the rarer n-grams of their prefix, and a pair meets in the first of its lists alone.  Only
    lists with several components can hold such a pair, so no other n-grams need be carried.  ``listed`` has no entry whose pairs
    have all met: the hub of a list that is in one piece, and the other one of two.
    """
    entries = listed.select("key", "size", "place", "gram").join(parts.toDF("key", "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed = entries.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high").select("gram", "n")
    before = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rarer = F.when(F.col("n") > LONG_LIST, F.collect_list("gram").over(before))
    entries = cut_lineage(entries.join(mixed, "gram").select("key", "size", "place", "gram", "component", rarer.alias("rarer")))
    band = F.floor(F.log("size") / float(np.log(100 / percent)) + 1e-9).cast("int")
    side = lambda x: [F.col(c).alias(f"{n}{x}") for c, n in (("key", ""), ("size", "size_"), ("place", "place_"), ("component", "part_"), ("rarer", "rarer_"))]
    left, right = entries.select("gram", band.alias("band"), *side("a")), entries.select("gram", F.explode(F.array(band, band + 1)).alias("band"), *side("b"))
    larger = (F.col("size_a") > F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    once = F.col("rarer_a").isNull() | F.col("rarer_b").isNull() | ~F.arrays_overlap("rarer_a", "rarer_b")
    met = left.join(right, ["gram", "band"]).where(larger & (F.col("part_a") != F.col("part_b")) & _possible(percent) & once)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
