"""Base scores by brute force; the model is a distribution and beats the unigram on held-out rows."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from navloom.llm import maxent
from navloom.llm.common import table
from navloom.llm.queries import in_fold


def by_brute_force(rows):
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, out(i), len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens]


@pytest.mark.parametrize("vocabulary", [131_072, 50, 1])
def test_base_scores(spark, documents, sf_dir, vocabulary):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' WHERE doc_id % 3 = 0").fetchall()
    rows += [(10_001, None), (10_002, ""), (10_003, "É é A a b"), (None, "no id"), (10_004, "same"), (10_004, "same"), (10_005, "long " * 30_000)]
    found = maxent.maxent_scores(documents(*rows, extra=", id long, rare long, n long"), in_fold("doc_id", 7, 2), vocabulary).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    for got, want in zip(sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key), sorted(by_brute_force(rows), key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9)


def test_held_out_rows_are_likelier(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.1"), "documents")
    found = maxent.maxent_scores(docs, in_fold("doc_id", 7, 2)).where("held_out").toPandas()
    assert found["score"].sum() / found["n_tokens"].sum() > found["base_score"].sum() / found["n_tokens"].sum() + 0.1


def test_probabilities_sum_to_one(spark, documents):
    docs = documents(*[(k, f"a b{k % 9} c a b{k % 5} d{k}") for k in range(120)])
    counts = maxent.count_words(docs.select("text")).cache()
    model = maxent.train(docs.select("text"), maxent.start_model(counts, 6))
    words = {bytes(r.word): r.n for r in counts.collect()}
    histories = ["", "a", "a b1", "never seen"]
    for history in histories:
        total, shared = 0.0, np.zeros(maxent.SHARED)
        for word, n in words.items():
            text = f"{history} {word.decode()}"
            batch = maxent.encode(model, pd.Series([text]))
            at = len(history.split())
            like = math.exp(maxent.log_likelihood(model, batch)[at])
            slot = int(batch.slot[at]) % maxent.PLACES * maxent.CLASSES + int(batch.slot[at]) // maxent.PLACES
            total += like * ((n + 1) / 10 ** model.shared_logs[slot - maxent.OWN] if slot >= maxent.OWN else 1)
            if slot >= maxent.OWN:
                shared[slot - maxent.OWN] = like
        # what is left belongs to places without a word and to unseen words
        assert 0 < total <= 1 + 1e-6


def test_no_rows(documents):
    assert maxent.maxent_scores(documents(), in_fold("doc_id", 7, 2)).count() == 0
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2]
    found = maxent.maxent_scores(documents((held[0], "a b")), in_fold("doc_id", 7, 2)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found] == [(3, 0, 0, 0.0)]
