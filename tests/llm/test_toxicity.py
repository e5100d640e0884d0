"""Segments against all cuts, the score against held-out labels."""

import random
import time

import pytest
from pyspark.sql import functions as F

from navloom.llm import toxicity
from navloom.llm.common import table
from navloom.llm.queries import in_fold


def test_segments_are_the_best_ones():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 30)
        scores = [rng.choice([0, 0, 0, 1.0, 2.5]) for _ in range(n)]
        found = toxicity.segments([(k, s) for k, s in enumerate(scores) if s], 0.7)
        worth = [s or -0.7 for s in scores]
        best = max(sum(worth[a:b]) for a in range(n) for b in range(a + 1, n + 1))
        assert max((s for *_, s in found), default=0) == pytest.approx(max(best, 0))
        for a, b, s in found:
            assert s == pytest.approx(sum(worth[a : b + 1]))
            # maximal: every proper prefix and suffix is worth something
            assert all(sum(worth[a:k]) > -1e-9 and sum(worth[k : b + 1]) > -1e-9 for k in range(a + 1, b + 1))
        assert all(x[1] < y[0] for x, y in zip(found, found[1:]))
        covered = {k for a, b, _ in found for k in range(a, b + 1)}
        assert all(k in covered for k, s in enumerate(scores) if s)


@pytest.mark.parametrize("gap", [30, 3, 1])
def test_segments_take_time_in_proportion(gap):
    """Separated, merging and adjoining toxic words: twice as many take about twice as long."""
    spent = []
    for n in (20_000, 40_000, 80_000):
        scores = [(gap * k, 1.0) for k in range(n)]
        spent.append(min(_seconds(scores) for _ in range(3)))
    assert spent[2] < 8 * spent[0] + 0.05 and spent[2] < 2


def _seconds(scores):
    started = time.perf_counter()
    toxicity.segments(scores, 0.2)
    return time.perf_counter() - started


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.learn(docs, labels.where(~in_fold("doc_id", 5, 0)))
    found = toxicity.score_toxicity(docs, model).select("row.doc_id", "score", "predicted").join(labels, "doc_id").where(in_fold("doc_id", 5, 0))
    right = found.groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("right"), F.min("score").alias("least"), F.max("score").alias("most")).collect()
    share = {r.toxic: r.right for r in right}
    assert share[0] > 0.98 and share[1] > 0.75
    assert all(0 <= r.least <= r.most <= 1 for r in right)


def test_odd_rows(spark, documents):
    rows = [(k, f"fine words here all day {k} " * 4 + ("awfulword" if k % 4 == 0 else ""), None) for k in range(200)]
    docs = documents(*rows, (900, None), (901, ""), (902, "fine " * 50_000 + "awfulword awfulword"), (None, "awfulword"), (903, "awfulword"), (903, "awfulword"), extra=", score long, found long, id long, toxic long")
    labels = spark.createDataFrame([(k, int(k % 4 == 0), 3) for k in range(200)] + [(0, None, 1), (None, 1, 1), (0, 1, 1), (5, None, 2)], "doc_id long, toxic int, quality int")
    model = toxicity.learn(docs, labels)
    found = toxicity.score_toxicity(docs, model)
    assert found.count() == 206
    got = {(r.row.doc_id): r for r in found.collect()}
    assert got[0].predicted == got[903].predicted == got[None].predicted == 1
    assert got[1].predicted == got[900].predicted == got[901].predicted == 0 and got[900].score == got[901].score
    assert [(s["first"], s["last"]) for s in got[902].passages] == [(50_000, 50_001)]
    nothing = toxicity.learn(docs, labels.where("doc_id < 0"))
    assert toxicity.score_toxicity(docs, nothing).where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(documents(), model).count() == 0


def test_a_sample_predicts_like_all_labels(spark, documents):
    """Clean rows with a toxic word now and then: the curve has the classes' true shares however many rows are sampled."""
    rng = random.Random(5)
    line = lambda toxic: " ".join("awfulword" if toxic else f"w{rng.randrange(400)}" for toxic in [toxic, *[False] * 24])
    toxic = {k: k % 20 == 0 for k in range(4000)}
    docs = documents(*[(k, line(toxic[k] and rng.random() < 0.9 or rng.random() < 0.02)) for k in range(4000)])
    labels = spark.createDataFrame([(k, int(t)) for k, t in toxic.items()], "doc_id long, toxic int")
    rates = []
    for per_class in (200, 10**9):
        found = toxicity.score_toxicity(docs, toxicity.learn(docs, labels, per_class=per_class))
        rates.append(found.agg(F.avg("score").alias("score")).first().score)
    assert rates[1] == pytest.approx(0.05, abs=0.01)
    assert rates[0] == pytest.approx(rates[1], abs=0.02)
