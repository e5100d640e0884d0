"""Spelling variants: words at one edit from each other, found in a trie of letter-group counts, and the form each word varies."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import quoted, text_of
from navloom.session import cut_lineage

#: UTF-8 of maximal runs of A-Z, a-z and U+00C0 to U+00FF once A-Z is lower case, and a byte that no run holds.
RUN, OUTSIDE = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+"), re.compile(rb"[^a-z\x80-\xff]")
#: Bytes of a text that are cut into words at once, and distinct words a task counts before it passes them on.
PIECE, WORDS_HELD = 1 << 20, 200_000
#: Letter groups, the levels of the trie below the length: a letter's group is its code point modulo their number.
GROUPS = 16
#: Words of a shard that the cut of the trie aims at, and words of the bounded sample from which the cut is made.
SHARD_WORDS, SAMPLE_WORDS = 2_000, 50_000
#: Words below which a node is searched as a leaf, and above which a full-depth leaf is searched by deletions.
LEAF_WORDS, WIDE_LEAF = 16, 512
#: Letters of the pairs that are compared at once.
LETTERS_AT_ONCE = 1 << 22

#: What has been spent on the way from a word to others: nothing, a surplus, a surplus and a deficit; or, towards words longer by
#: one letter, nothing, the surplus.  255: over the budget of one each.  A pair is found from its shorter word, or from the
#: one whose first differing count is smaller, so a deficit is only ever spent after a surplus.
EQUAL, UP, BOTH, LONGER, LONGER_UP, OVER = 0, 1, 2, 3, 4, 255
SURPLUS = np.array([UP, OVER, OVER, LONGER_UP, OVER], dtype=np.uint8)
DEFICIT = np.array([OVER, BOTH, OVER, OVER, OVER], dtype=np.uint8)


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about a megabyte, cut between runs."""
    start = 0
    while len(text) - start > PIECE:
        found = OUTSIDE.search(text, start + PIECE)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, slip: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n``: runs of letters in lower case (A-Z only) with at least so many code points and occurrences.

    ``slip``: where the crc32 of ``id:run`` is divisible by it, the run loses the letter at that number modulo its length (0: never),
    which plants misspellings that grow with the corpus.  Every task passes on its own sums, so a frequent word
    reaches the shuffle as a few rows of each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(key)
                for piece in _pieces(text.as_py().lower()):
                    for run, n in Counter(RUN.findall(piece)).items():
                        if slip and (h := zlib.crc32(run, start)) % slip == 0:
                            letters = run.decode()
                            at = h % len(letters)
                            run = (letters[:at] + letters[at + 1 :]).encode()
                        if len(run) >= least_length and (len(run) >= 2 * least_length or len(run.decode()) >= least_length):
                            held[run] += n
                if len(held) > WORDS_HELD:
                    yield passed()
                    held.clear()
        yield passed()

    key = F.concat(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")), F.lit(":")).cast("binary")
    parts = docs.select(key.alias("key"), text_of(text_col).cast("binary").alias("text")).mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count).select(F.col("word").cast("string").alias("word"), "n")


def letter_vectors(words: list[str]) -> np.ndarray:
    """A row for each word: its length, then the number of its letters in each group."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    cells = np.repeat(np.arange(len(words)), lengths) * GROUPS + letters % GROUPS
    return np.concatenate([lengths[:, None], np.bincount(cells, minlength=len(words) * GROUPS).reshape(-1, GROUPS)], axis=1).astype(np.int32)


def cut_of(sample: list[str], share: float) -> set[tuple[int, ...]]:
    """The open nodes (count prefixes) at the top of the trie: those that hold more than this share of a sample of the words."""
    vectors = [tuple(v) for v in letter_vectors(sample).tolist()]
    opened = {()}
    for depth in range(1, GROUPS + 1):
        found = Counter(v[:depth] for v in vectors if v[: depth - 1] in opened)
        opened |= {p for p, n in found.items() if n > share * len(vectors)}
    return opened


def shards_of(vector: list[int], opened: set[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], int]]:
    """Depth first through the open nodes: every closed node that one surplus and one deficit reach, and what was spent."""
    stack: list[tuple[tuple[int, ...], int]] = [((), EQUAL)]
    while stack:
        prefix, spent = stack.pop()
        if prefix not in opened or len(prefix) > GROUPS:
            yield prefix, spent
            continue
        n = vector[len(prefix)]
        stack.append(((*prefix, n), spent))
        more, less = (LONGER, OVER) if not prefix else (int(SURPLUS[spent]), int(DEFICIT[spent]))
        if more != OVER:
            stack.append(((*prefix, n + 1), more))
        if less != OVER and n:
            stack.append(((*prefix, n - 1), less))


def _letters(words: list[str], width: int) -> np.ndarray:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    out = np.zeros((len(words), width), dtype=np.uint8)
    out[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return out


def _one_edit(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Rows of letters that differ in one place (``same``: words of one length), or of which b has one letter more."""
    near = np.zeros(len(a), dtype=bool)
    near[same] = (a[same] != b[same]).sum(axis=1) == 1
    x, y = a[~same][:, :-1], b[~same]
    left, right = x == y[:, :-1], (x == y[:, 1:])[:, ::-1]
    run = lambda m: np.where(m.all(axis=1), m.shape[1], m.argmin(axis=1)) if m.shape[1] else np.zeros(len(m), dtype=np.int64)
    near[~same] = run(left) + run(right) >= x.shape[1]
    return near


def _by_deletions(words: list[str], ask: np.ndarray, leaf: range) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a leaf of very many words with the same counts: equal rests after a letter is taken out, no pair compared."""
    width = len(words[leaf[0]])
    rests: dict[tuple[int, str], list[int]] = {}
    for j in leaf:
        for k in range(width):
            rests.setdefault((k, words[j][:k] + words[j][k + 1 :]), []).append(j)
    pairs = set()
    for i in ask.tolist():
        w = words[i]
        if len(w) == width:
            pairs |= {(i, j) for k in range(width) for j in rests.get((k, w[:k] + w[k + 1 :]), ()) if words[j] != w}
        else:
            pairs |= {(i, j) for k in range(width) for j in rests.get((k, w), ())}
    found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def pairs_in_shard(words: list[str], spent: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs at one edit between all words (queries) and those with nothing spent, which make up the trie.

    The trie is the sorted table of count vectors; a node is a range of rows that agree in the first counts.  An explicit stack
    goes through it depth first with all queries that still reach a node; leaf words are compared letter by letter.
    """
    vectors = letter_vectors(words)
    order = np.lexsort((*vectors.T[::-1], spent))
    words, spent, vectors = [words[k] for k in order], spent[order], vectors[order]
    size = int((spent == EQUAL).sum())
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = len(words[0])
    letters = _letters(words, width)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        for cut in range(0, len(a), step := max(1, LETTERS_AT_ONCE // max(1, width))):
            x, y = a[cut : cut + step], b[cut : cut + step]
            ok = _one_edit(letters[x], letters[y], vectors[x, 0] == vectors[y, 0])
            found.append((x[ok], y[ok]))

    def leaf(low: int, high: int, level: int, ask: np.ndarray, state: np.ndarray) -> None:
        if high - low > WIDE_LEAF:
            x, y = _by_deletions(words, ask, range(low, high))
            once = (x < low) | (x >= high) | (x < y)
            found.append((x[once], y[once]))
            return
        for cut in range(0, len(ask), step := max(1, (1 << 16) // (high - low))):
            a, b = np.repeat(ask[cut : cut + step], high - low), np.tile(np.arange(low, high), len(ask[cut : cut + step]))
            s = np.repeat(state[cut : cut + step], high - low)
            rest = vectors[b, level:] - vectors[a, level:]
            up, down = np.where(rest > 0, rest, 0).sum(axis=1), np.where(rest < 0, -rest, 0).sum(axis=1)
            head = rest[np.arange(len(rest)), (rest != 0).argmax(axis=1)] if rest.shape[1] else np.zeros(len(a))
            once = (s != EQUAL) | (head > 0) | ((up + down == 0) & (a < b))
            ok = once & (up + np.isin(s, (UP, BOTH, LONGER_UP)) <= 1) & (down + (s == BOTH) <= np.where(s >= LONGER, 0, 1))
            compare(a[ok], b[ok])

    stack = [(0, size, depth, np.arange(len(words)), spent)]
    while stack:
        low, high, level, ask, state = stack.pop()
        if high - low <= LEAF_WORDS or level > GROUPS:
            leaf(low, high, level, ask, state)
            continue
        column = vectors[low:high, level]
        edges = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
        asked = vectors[ask, level]
        for start, end in zip(edges, edges[1:]):
            gap = column[start] - asked
            after = np.where(gap == 0, state, np.where(gap == 1, SURPLUS[state], np.where(gap == -1, DEFICIT[state], OVER)))
            keep = after != OVER
            if keep.any():
                stack.append((low + start, low + end, level + 1, ask[keep], after[keep].astype(np.uint8)))
    a, b = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), ())))
    return order[a], order[b]


def near_words(words: DataFrame) -> DataFrame:
    """All pairs (``a``, ``n_a``, ``b``, ``n_b``) of distinct words that differ by one inserted, deleted or replaced letter, each once.

    The top of the trie is cut at nodes of about ``SHARD_WORDS`` words by the shares in a sample of about ``SAMPLE_WORDS`` (the cut
    moves work, not results, and its size does not grow with the vocabulary); a word belongs to one shard and is asked in every shard that
    the budget reaches.
    """
    total = words.count()
    sample = words.where(F.pmod(F.xxhash64("word"), F.lit(max(total, 1))) < SAMPLE_WORDS).select("word").toArrow()["word"].to_pylist()
    opened = cut_of(sample, max(SHARD_WORDS / max(total, 1), 20 / SAMPLE_WORDS))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(".".join(map(str, p)), k, s) for k, v in enumerate(letter_vectors(list(frame["word"])).tolist()) for p, s in shards_of(v, opened)]
            shard, at, spent = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"shard": shard, "word": frame["word"].to_numpy()[list(at)], "n": frame["n"].to_numpy()[list(at)], "spent": np.array(spent, dtype=np.int32)})

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        found = list(frame["word"])
        a, b = pairs_in_shard(found, frame["spent"].to_numpy().astype(np.uint8), key[0].count(".") + 1)
        word, n = frame["word"].to_numpy(), frame["n"].to_numpy()
        return pd.DataFrame({"a": word[a], "n_a": n[a], "b": word[b], "n_b": n[b]})

    dealt = words.select("word", "n").mapInPandas(deal, "shard string, word string, n long, spent int")
    return dealt.groupBy("shard").applyInPandas(search, "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last form that forms (``word``, ``form``) lead to.

    A form is several times as frequent as its word, so there is no circle; every round doubles the steps that a
    row has gone, and a chain is no longer than the logarithm of the largest count.
    """
    ends = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = cut_lineage(ends.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if ends.where("moved").isEmpty():
            return ends.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of every row of ``words`` (``word`` distinct, ``n``).

    Two words are near at one inserted, deleted or replaced letter.  The form of a word is its most frequent near word (of equally
    frequent ones the smallest in code-point order), if it is at least ``ratio`` times as frequent; the root is where forms
    end, the word itself if it has none.  No words: no rows.  Words hold letters up to U+00FF only.
    """
    words = cut_lineage(words.select("word", "n"))
    side = lambda x, y: F.struct(F.col(x).alias("word"), F.struct((-F.col(f"n_{y}")).alias("less"), F.col(y).alias("form")).alias("near"))
    both = near_words(words).select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("p")).select("p.word", "p.near")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    joined = words.join(near, "word", "left")
    varies = -F.col("near.less") >= ratio * F.col("n")
    rows = cut_lineage(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(varies, F.col("near.form")).alias("form"), F.when(varies, -F.col("near.less")).alias("form_n")))
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
