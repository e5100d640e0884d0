"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme-value statistics."""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import quoted, text_of, whole_row
from navloom.llm.jaccard import gram_sets, key_of

PUNCTUATION = string.punctuation.encode()
#: Bytes of the stems that a word shares with its inflected forms.
STEMS = (4, 5, 6, 7)


@dataclass(frozen=True)
class ToxicityModel:
    """Log-odds by word (``b"loser"``) and stem (``b"lose*"``), the cost of any other token, and the calibration."""

    odds: dict[bytes, float]
    drift: float
    rate: float  # lambda of the extreme-value law
    scale: float  # K of the same law
    intercept: float = 0.0
    slope: float = 1.0


def words_of(text: str) -> list[bytes]:
    """Lower-case words without punctuation at their ends; a word of punctuation alone is an empty one."""
    return [w.strip(PUNCTUATION) for w in text.encode("utf-8", "surrogatepass").lower().split()]


def stems_of(word: bytes) -> list[bytes]:
    return [word[:n] + b"*" for n in STEMS if len(word) > n]


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last token, score), left to right, in linear time.

    ``scores`` holds the tokens with a positive score by position; every other token costs ``drift``.  A segment keeps the
    place of the last one before it with a smaller sum before, so those in between are passed over in one step.
    """
    found: list[list[float]] = []  # first, last, sum before, sum after, place of the last segment with a smaller sum before
    total, before = 0.0, -1
    for at, score in scores:
        left = total - drift * (at - before - 1)
        total, before = left + score, at
        new = [at, at, left, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(int(a), int(b), r - l) for a, b, l, r, _ in found]


def evidence(model: ToxicityModel, scored: list[float], tokens: int) -> float:
    """Minus the log of the chance that clean text of this length has segments as good, by the best number of them; 0 without any."""
    if not scored:
        return 0.0
    base = math.log(max(model.scale * max(tokens, 1), 1e-300))
    total, best = 0.0, 0.0
    for r, s in enumerate(sorted(scored, reverse=True), 1):
        gain = model.rate * s - base
        if gain <= 0 and r > 1:
            break
        total += gain
        if total > 0:
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def passages(model: ToxicityModel, words: list[bytes], cache: dict[bytes, float]) -> list[tuple[int, int, float]]:
    hits = []
    for at, word in enumerate(words):
        score = cache.get(word)
        if score is None:
            score = max(model.odds.get(f, 0.0) for f in (word, *stems_of(word)))
            if len(cache) >= 200_000:
                cache.clear()
            cache[word] = score
        if score:
            hits.append((at, score))
    return segments(hits, model.drift) if hits else []


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences of words and stems in toxic and clean texts, summed in a task as far as its memory allows; all tokens as b""."""
    tokens, rows = [Counter(), Counter()], Counter()

    def summed() -> Iterator[pd.DataFrame]:
        keys = list(tokens[0].keys() | tokens[1].keys())
        for start in range(0, len(keys), 50_000):
            part = keys[start : start + 50_000]
            yield pd.DataFrame({"feature": part, "toxic": [tokens[1][k] for k in part], "clean": [tokens[0][k] for k in part], "toxic_rows": [rows[k] for k in part]})
        for counter in (*tokens, rows):
            counter.clear()

    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"]):
            words = [w for w in words_of(text) if w]
            features = words + [s for w in words for s in stems_of(w)]
            tokens[toxic].update(features)
            tokens[toxic][b""] += len(words)
            if toxic:
                rows.update({b"", *features})
            if len(tokens[0]) + len(tokens[1]) > 200_000:
                yield from summed()
    yield from summed()


def labelled(docs: DataFrame, labels: DataFrame, per_class: int, seed: int) -> tuple[DataFrame, dict[int, float]]:
    """Labelled texts: about ``per_class`` ids of each class at most, chosen by a hash of the id, and one of the near copies
    of a class, so that the words of a text that was copied often do not look like words of its class.

    The bound makes the label table small enough to be broadcast, so that no text is shuffled to find its label.  With the
    texts goes how many labelled ids of its class a chosen one stands for, so that both classes can keep their true sizes.
    """
    labels = labels.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    sizes = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**30)) / float(2**30)
    weights = {toxic: max(1.0, sizes.get(toxic, 0) / per_class) for toxic in (0, 1)}
    chosen = labels.where(place * weight_of(weights) < 1).select(F.col("doc_id").alias("id"), "toxic")
    texts = docs.join(F.broadcast(chosen), docs.doc_id == chosen.id).select("text", "toxic").mapInPandas(_sketched, "text string, toxic int, hash long, a long, b long")
    for key in ("a", "b"):
        texts = texts.groupBy("toxic", key).agg(F.min_by(F.struct("text", "hash", "a", "b"), "hash").alias("t")).select("t.text", "toxic", "t.hash", "t.a", "t.b")
    return texts.select("text", "toxic"), weights


def weight_of(weights: dict[int, float]) -> Column:
    return F.when(F.col("toxic") == 1, weights[1]).otherwise(weights[0])


def _sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Two smallest hashes of a text's 5-word n-grams under different orders: near copies mostly share one of them."""
    for part, grams in gram_sets(frames, 5):
        first = [int(g.min()) if len(g) else 0 for g in grams]
        second = [int((g * np.uint64(0xD6E8FEB86659FD93)).min()) if len(g) else 0 for g in grams]
        keys = {n: np.array(v, dtype=np.uint64).view(np.int64) for n, v in (("a", first), ("b", second))}
        yield pd.DataFrame({"text": part["text"], "toxic": part["toxic"], "hash": np.array([key_of(g) for g in grams], dtype=np.int64)} | keys)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 20_000, prior_share: float = 0.01, least_ratio: float = 10.0, least_rows: int = 3, lexicon: int = 50_000, drift: float = 0.2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on the labelled rows: log-odds under an informative Dirichlet prior, then the calibration.

    The prior spreads ``prior_share`` of all tokens like the words of both classes together.  A word or stem is a toxic one if
    it is ``least_ratio`` times as frequent in toxic texts even at the near ends of both counts' 95 % intervals; the
    ``lexicon`` strongest are kept.  Without toxic or without clean rows the model finds nothing.
    """
    texts, weights = labelled(docs.select(F.col(quoted(id_col)).alias("doc_id"), text_of(text_col).alias("text")), labels, per_class, seed)
    counts = texts.mapInPandas(_count, "feature binary, toxic long, clean long, toxic_rows long").groupBy("feature")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("toxic_rows").alias("toxic_rows"))
    counts = counts.where(F.col("toxic_rows") >= least_rows)
    totals = counts.where(F.length("feature") == 0).collect()
    empty = ToxicityModel({}, drift, 1.0, 1.0, intercept=-4.0)
    if not totals or not totals[0].toxic or not totals[0].clean:
        return empty
    n1, n0 = float(totals[0].toxic), float(totals[0].clean)
    w1, w0 = weights[1], weights[0]
    prior = prior_share * (w1 * n1 + w0 * n0)
    alpha = F.lit(prior_share) * (w1 * F.col("toxic") + w0 * F.col("clean"))
    p1, p0 = (w1 * F.col("toxic") + alpha) / (w1 * n1 + prior), (w0 * F.col("clean") + alpha) / (w0 * n0 + prior)
    odds = F.log(p1 / (1 - p1)) - F.log(p0 / (1 - p0))
    least, most = F.col("toxic") - 1.645 * F.sqrt("toxic"), F.col("clean") + 1.0 + 1.645 * F.sqrt(F.col("clean") + 1.0)
    strong = counts.where(F.length("feature") > 0).select("feature", odds.alias("odds"), (least / n1 / (most / n0)).alias("ratio"), p0.alias("p0"))
    strong = strong.where((F.col("ratio") >= least_ratio) & (F.col("odds") > 0)).orderBy(F.desc("ratio"), "feature").limit(lexicon).collect()
    if not strong:
        return empty
    table = {bytes(r.feature): float(r.odds) for r in strong}
    rate = _karlin_rate(np.array([r.p0 for r in strong]), np.array([r.odds for r in strong]), drift)
    model = ToxicityModel(table, drift, rate, 1.0 - math.exp(-rate * drift))
    return _calibrated(model, texts, weights)


def _karlin_rate(chance: np.ndarray, odds: np.ndarray, drift: float) -> float:
    """The positive root of ``sum p * exp(rate * score) = 1`` over the tokens of clean text."""
    rest = max(1.0 - chance.sum(), 1e-9)
    low, high = 1e-6, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        if float(np.sum(chance * np.exp(np.minimum(mid * odds, 700.0)))) + rest * math.exp(-mid * drift) > 1.0:
            high = mid
        else:
            low = mid
    return (low + high) / 2


def _calibrated(model: ToxicityModel, texts: DataFrame, weights: dict[int, float], ridge: float = 0.01) -> ToxicityModel:
    """Logistic curve of the evidence, fitted by Newton steps to a histogram with bins of a quarter.

    Rows count by their weight, so that the curve has the classes' true shares, whatever the sample's; the weights are
    scaled to the number of rows, so that the penalty means the same.
    """
    found = texts.select("toxic", weight_of(weights).alias("weight"), toxic_passages(model, F.col("text")).alias("found"))
    histogram = found.groupBy(F.least(F.round(F.col("found.evidence") * 4), F.lit(800)).alias("x")).agg(F.sum(F.col("toxic") * F.col("weight")).alias("ones"), F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    each = sum(r.rows for r in histogram) / sum(r.n for r in histogram)
    x = np.array([[1.0, r.x / 4] for r in histogram])
    n, ones = np.array([r.n * each for r in histogram]), np.array([r.ones * each for r in histogram])
    beta, penalty = np.zeros(2), np.diag([ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (ones - n * p) - penalty @ beta)
        beta = beta + np.clip(step, -2.0, 2.0)
    return ToxicityModel(model.odds, model.drift, model.rate, model.scale, float(beta[0]), float(beta[1]))


def toxic_passages(model: ToxicityModel, text: Column) -> Column:
    """Struct of ``evidence`` and ``passages`` (first token, last token, score), over the whole text."""

    @F.pandas_udf("evidence double, passages array<struct<first: int, last: int, score: double>>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        cache: dict[bytes, float] = {}
        strengths, spans = [], []
        for value in texts:
            words = words_of(value)
            found = passages(model, words, cache)
            strengths.append(evidence(model, [s for _, _, s in found], len(words)))
            spans.append([{"first": a, "last": b, "score": s} for a, b, s in found])
        return pd.DataFrame({"evidence": strengths, "passages": spans})

    return scan(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """One row per input row: ``row``, ``score`` from 0 to 1, ``predicted``, ``evidence``, ``passages``.

    Only the text is read.  Null or empty text: no passage, the score of a clean text.  Repeated rows get the same
    score.  Empty table: no rows.
    """
    found = docs.select(whole_row(docs), toxic_passages(model, text_of(text_col)).alias("found"))
    score = 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * F.col("found.evidence"))))
    return found.select("row", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "found.evidence", "found.passages")
