"""Hashed maximum-entropy language model: n-gram and skip features, class-factored softmax, distributed gradient updates."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import quoted, text_of
from navloom.session import cut_lineage

#: Classes, and places in each class; a word has a place of its own or shares one with the rare words of its hash.
CLASSES, PLACES, SHARED = 32, 32, 256
OWN = CLASSES * PLACES - SHARED
#: Rows of the hashed weights of each of the two factors, as a power of two.
BITS = 14
#: Features of a token: the word before, the two words before, and the word before the last.
FEATURES = 3
#: The end of a text, a token that no word equals.
END = b""
#: Tokens of one gradient step.
STEP = 16_384


@dataclass
class MaxentModel:
    """Counts of the training tokens, the frequent words, and the weights; its size is set by the parameters."""

    train_tokens: int
    distinct: int
    words: dict[bytes, int]
    hashes: np.ndarray  # by frequent word: CRC
    slots: np.ndarray  # by frequent word: class * PLACES + place
    log_counts: np.ndarray  # by frequent word: log10(c + 1)
    known: np.ndarray  # by frequent word: c > 0
    shared_logs: np.ndarray  # by shared place: log10 of its tokens + distinct words + 1
    class_bias: np.ndarray
    place_bias: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((2 << BITS, CLASSES), dtype=np.float32))


def tokens_of(text: str) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def placed(slot: np.ndarray) -> np.ndarray:
    """Class * PLACES + place; neighbouring frequencies go to different classes."""
    return slot % CLASSES * PLACES + slot // CLASSES


def shared_slot(crc: np.ndarray) -> np.ndarray:
    return placed(OWN + crc.astype(np.int64) % SHARED)


@dataclass
class Batch:
    """Tokens of some texts: place among the frequent words (-1: not there), CRC, slot, and bounds of the texts."""

    index: np.ndarray
    crc: np.ndarray
    slot: np.ndarray
    starts: np.ndarray
    rare: np.ndarray
    rare_words: list[bytes]


def encode(model: MaxentModel, texts: pd.Series) -> Batch:
    words: list[bytes] = []
    starts = []
    for text in texts:
        starts.append(len(words))
        words += tokens_of(text)
    index = np.fromiter(map(model.words.get, words, repeat(-1)), dtype=np.int32, count=len(words))
    crc, slot = model.hashes[index], model.slots[index]
    rare = np.flatnonzero(index < 0)
    rare_words = [words[k] for k in rare]
    crc[rare] = np.fromiter(map(zlib.crc32, rare_words), dtype=np.uint32, count=len(rare_words))
    slot[rare] = shared_slot(crc[rare])
    return Batch(index, crc, slot, np.array(starts, dtype=np.int64), rare, rare_words)


def features(batch: Batch) -> list[np.ndarray]:
    """32-bit hashes of the features of every token; a feature that would reach before its text is 0."""
    n = len(batch.crc)
    one, two = np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=np.uint32)
    one[1:], two[2:] = batch.crc[:-1], batch.crc[:-2]
    one[batch.starts] = 0
    two[batch.starts] = 0
    second = batch.starts + 1
    two[second[second < n]] = 0
    first = one * np.uint32(0x9E3779B1)
    skip = (two ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B)
    both = (one * np.uint32(0xC2B2AE35) ^ two) * np.uint32(0x27D4EB2F)
    return [first ^ (first >> np.uint32(15)), both ^ (both >> np.uint32(13)), skip ^ (skip >> np.uint32(14))]


def _rows(hashes: list[np.ndarray], classes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Weight rows of the class factor, and of the place factor, which sees the class too."""
    shift = np.uint32(32 - BITS)
    mixed = classes.astype(np.uint32) * np.uint32(0x9E3779B1)
    above = [(h * np.uint32(0x2C1B3C6D)) >> shift for h in hashes]
    below = [((h ^ mixed) * np.uint32(0x297A2D39)) >> shift for h in hashes]
    return above, below


ONES = np.ones(max(CLASSES, PLACES), dtype=np.float32)
#: Weights stay within these bounds, so that the exponential of a sum of a bias and FEATURES weights is a finite float.
BOUND = 8.0


def _logits(bias: np.ndarray, weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = bias + weights.take(rows[0], axis=0)
    for r in rows[1:]:
        z += weights.take(r, axis=0)
    return z


def _log_chance(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the softmax at the target of each row; overwrites ``z``."""
    own = z[np.arange(len(z)), target].astype(np.float64)
    np.exp(z, out=z)
    return own - np.log(z @ ONES[: z.shape[1]])


def log_likelihood(model: MaxentModel, batch: Batch) -> np.ndarray:
    """Natural log of class and place probability of every token."""
    hashes, out = features(batch), np.empty(len(batch.slot), dtype=np.float64)
    lower = 1 << BITS
    for cut in range(0, len(out), STEP):
        part = slice(cut, cut + STEP)
        classes, places = np.divmod(batch.slot[part], PLACES)
        above, below = _rows([h[part] for h in hashes], classes)
        out[part] = _log_chance(_logits(model.class_bias, model.weights[:lower], above), classes)
        out[part] += _log_chance(_logits(model.place_bias.take(classes, axis=0), model.weights[lower:], below), places)
    return out


def _summed(values: np.ndarray, rows: np.ndarray, few: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values.  Most rows stand a few times in a batch and are added place by place; of
    the others two numbers are added at a time, as one complex number."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    placed_rows = rows[order]
    start = np.flatnonzero(np.concatenate(([True], placed_rows[1:] != placed_rows[:-1])))
    size = np.diff(np.append(start, len(rows)))
    total = values.take(order[start], axis=0)
    more = np.flatnonzero(size > 1)
    for k in range(1, few):
        total[more] = total.take(more, axis=0) + values.take(order[start[more] + k], axis=0)
        more = more[size[more] > k + 1]
    if len(more):
        left = size[more] - few
        offset = np.concatenate(([0], np.cumsum(left)[:-1]))
        at = np.repeat(start[more] + few - offset, left) + np.arange(left.sum())
        rest = np.add.reduceat(values.take(order[at], axis=0).view(np.complex64), offset, axis=0)
        total[more] += rest.view(np.float32)
    return placed_rows[start], total


def gradient_steps(model: MaxentModel, batch: Batch, weights: np.ndarray, energy: np.ndarray, rate: float) -> None:
    """Adaptive gradient steps in place; ``energy`` holds the squared gradients of every weight row so far."""
    hashes, lower = features(batch), 1 << BITS
    for cut in range(0, len(batch.slot), STEP):
        part = slice(cut, cut + STEP)
        classes, places = np.divmod(batch.slot[part], PLACES)
        rows = _rows([h[part] for h in hashes], classes)
        at = np.arange(len(classes))
        for half, (bias, target) in enumerate(((model.class_bias, classes), (model.place_bias.take(classes, axis=0), places))):
            own, power = weights[half * lower : (half + 1) * lower], energy[half * lower : (half + 1) * lower]
            pull = _logits(bias, own, rows[half])
            np.exp(pull, out=pull)
            pull *= (-1.0 / (pull @ ONES[: pull.shape[1]]))[:, None]
            pull[at, target] += 1
            for r in rows[half]:
                touched, total = _summed(pull, r)
                power[touched] += np.einsum("ij,ij->i", total, total) / CLASSES
                total *= (rate / np.sqrt(power[touched] + 1.0))[:, None]
                own[touched] = np.clip(own.take(touched, axis=0) + total, -BOUND, BOUND)


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (binary; the end of a text is empty) and ``n``, summed in every task before the shuffle."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for frame in frames:
            for text in frame["text"]:
                total.update(tokens_of(text))
            if len(total) > 400_000:
                yield pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})
                total.clear()
        yield pd.DataFrame({"word": pd.Series(list(total.keys()), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

    return texts.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def start_model(counts: DataFrame, vocabulary: int) -> MaxentModel:
    """The model before training: at most ``vocabulary`` most frequent words by name, biases from the counts."""
    crc = F.crc32("word")
    shares = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).toArrow().to_pandas().sort_values("n", ascending=False)
    within = shares["words"].cumsum() <= vocabulary
    least = int(shares["n"][within].min()) if within.any() else int(shares["n"].max()) + 1 if len(shares) else 1
    tokens, distinct = int((shares["n"] * shares["words"]).sum()), int(shares["words"].sum())
    frequent = counts.where((F.col("n") >= least) & (F.length("word") > 0)).toArrow().to_pandas().sort_values(["n", "word"], ascending=[False, True])
    ends = counts.where(F.length("word") == 0).first()
    words = [END, *map(bytes, frequent["word"])]
    n = np.concatenate(([float(ends.n) if ends else 0.0], frequent["n"].to_numpy(dtype=np.float64)))
    hashes = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    slots = np.where(np.arange(len(words)) < OWN, placed(np.arange(len(words))), shared_slot(hashes)).astype(np.int64)
    named = words[:OWN]
    shared = counts.where(~F.col("word").isin([bytearray(w) for w in named])) if named else counts
    sums = shared.groupBy(F.pmod(crc, F.lit(SHARED)).alias("place")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    mass = np.zeros(OWN + SHARED)
    mass[: min(len(words), OWN)] = n[:OWN]
    shared_total = np.ones(SHARED)
    for r in sums:
        mass[OWN + r.place] = r.n
        shared_total[r.place] = r.n + r.words + 1
    by_class = (mass + 1.0).reshape(PLACES, CLASSES).T
    return MaxentModel(
        tokens, distinct, {w: k for k, w in enumerate(words)}, hashes, slots, np.log10(n + 1.0), n > 0, np.log10(shared_total),
        np.log(by_class.sum(axis=1) / by_class.sum()).astype(np.float32), np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32),
    )


def train(texts: DataFrame, model: MaxentModel, rounds: tuple[float, ...] = (0.125, 0.875), rate: float = 0.15) -> MaxentModel:
    """One pass over all texts, dealt to rounds by the hash of the text.

    In a round every task starts from the same weights, makes gradient steps on its texts and sends the change of the
    rows that it touched; a row moves by the mean of these changes.  What is sent is a fixed number of rows a task.
    """
    spark = texts.sparkSession
    tasks = max(texts.rdd.getNumPartitions(), 1)
    names = [f"g{k}" for k in range(CLASSES)]
    schema = "row int, " + ", ".join(f"{c} float" for c in names)
    place, done = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20)) / float(1 << 20), 0.0
    for share in rounds:
        shared = spark.sparkContext.broadcast(model)

        def steps(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            own = shared.value
            weights, energy = own.weights.copy(), np.zeros(len(own.weights), dtype=np.float32)
            for frame in frames:
                for cut in range(0, len(frame), 64):
                    gradient_steps(own, encode(own, frame["text"].iloc[cut : cut + 64]), weights, energy, rate)
            touched = np.flatnonzero(energy)
            out = pd.DataFrame(weights[touched] - own.weights[touched], columns=names)
            out.insert(0, "row", touched.astype(np.int32))
            yield out

        part = texts.where((place >= done) & (place < done + share)).coalesce(max(1, math.ceil(tasks * share)))
        moved = part.mapInPandas(steps, schema).groupBy("row").agg(*[F.avg(c).cast("float").alias(c) for c in names]).toArrow().to_pandas()
        weights = model.weights.copy()
        weights[moved["row"].to_numpy()] += moved[names].to_numpy(dtype=np.float32)
        model = replace(model, weights=weights)
        done += share
        shared.unpersist()
    return model


SCORED = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.binary()))])


def score_texts(rows: DataFrame, model: MaxentModel, counts: DataFrame) -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` of rows with ``id``, ``held_out``, ``text``.

    Frequent words are scored from the model; the counts of all other words are looked up in ``counts`` by a join and
    summed by row, so the vocabulary that scores a text has no bound.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    base_log = math.log10(model.train_tokens + model.distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for cut in range(0, whole.num_rows, 256):
                part = whole.slice(cut, 256)
                batch = encode(own, part.column("text").to_pylist())
                logs = own.log_counts[batch.index]
                logs[batch.rare] = 0.0
                known = own.known[batch.index]
                known[batch.rare] = False
                sizes = np.diff(np.append(batch.starts, len(batch.index)))
                base = np.add.reduceat(logs, batch.starts) - sizes * base_log
                likely = log_likelihood(own, batch) / math.log(10)
                slot = (batch.slot % PLACES) * CLASSES + batch.slot // PLACES
                inside = slot >= OWN
                likely[inside] += logs[inside] - own.shared_logs[slot[inside] - OWN]
                rare_rows = np.searchsorted(batch.starts, batch.rare, side="right")
                offsets = np.searchsorted(rare_rows, np.arange(1, len(batch.starts) + 2))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("held_out"), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), batch.starts)),
                        pa.array(base), pa.array(np.add.reduceat(likely, batch.starts)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(batch.rare_words, type=pa.binary())),
                    ],
                    schema=SCORED,
                )

    found = rows.select("id", "held_out", "text").mapInArrow(score, "id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<binary>")
    found = cut_lineage(found.withColumn("row_number", F.monotonically_increasing_id()))
    looked = found.select("row_number", F.explode("rare").alias("word")).join(counts, "word")
    sums = looked.groupBy("row_number").agg(F.sum(F.log10(F.col("n") + 1)).alias("logs"), F.count(F.lit(1)).alias("seen"))
    logs, seen = F.coalesce("logs", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return found.drop("rare").join(sums, "row_number", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + seen).alias("n_known"), (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score")
    )


def maxent_scores(docs: DataFrame, held_out: Column, vocabulary: int = 131_072, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    The model learns from all rows that are not held out: counts of every word, then one pass of gradient updates.
    A token's probability is that of its class, times that of its place in the class, both from the features, times its
    smoothed share of the place where words share one; the shares of a place leave one part for all unseen words.

    Null or empty text: the end token alone.  Repeated rows count again.  Without training rows every count is 0.
    Empty table: no rows.  Other columns are not read.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), held_out.alias("held_out"), text_of(text_col).alias("text"))
    texts = rows.where(~F.col("held_out")).select("text")
    counts = cut_lineage(count_words(texts))
    model = train(texts, start_model(counts, vocabulary))
    return score_texts(rows, model, counts).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))
