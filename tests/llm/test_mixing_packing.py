"""Poisson copies and length buckets."""

import hashlib
import itertools
import math
from collections import Counter

import numpy as np
import pytest

from navloom.llm import packing
from navloom.llm.mixing import mix_sources, source_rates
from navloom.llm.packing import best_bounds, pack


def poisson(seed, key, rate):
    draws = max(1, math.ceil(rate / 8))
    mean, n = rate / draws, 0
    for draw in range(1, draws + 1):
        u = int(hashlib.md5(f"{seed}:{key}:{draw}".encode()).hexdigest()[:13], 16) / 2**52
        p = below = math.exp(-mean)
        k = 0
        while below <= u and k < 64:
            k += 1
            p *= mean / k
            below += p
        n += k
    return n


def test_copies_by_brute_force(documents):
    rows = [(k, "x" * (k % 50), ["a", "b", None, "c"][min(k % 7, 3)]) for k in range(400)] + [(1000, "y" * 9, "tiny"), (1001, None, "empty"), (1001, None, "empty"), (None, "z", "a")]
    docs = documents(*rows, extra=", n long, key long, rate long")
    rates = {r.source: r.rate for r in source_rates(docs).collect()}
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t or "")
    shares = {s: math.sqrt(v) for s, v in sizes.items()}
    for s, v in sizes.items():
        assert rates[s] == pytest.approx(shares[s] / sum(shares.values()) * sum(sizes.values()) / v if v else 0.0)
    assert rates["tiny"] > 8
    want = Counter()
    for i, _, s in rows:
        want[i] += poisson(17, "null" if i is None else i, rates[s])
    found = mix_sources(docs).collect()
    assert Counter(r.row.doc_id for r in found) == +want
    assert all(sorted(r.copy_no for r in g) for _, g in itertools.groupby(found, key=lambda r: r.row.doc_id))


def test_given_weights_and_total(documents):
    docs = documents(*[(k, "x" * 10, "a" if k < 800 else "b") for k in range(1000)])
    found = Counter(r.row.source for r in mix_sources(docs, weights={"a": 1, "b": 3}, total=20_000).select("row").collect())
    assert abs(found["a"] - 500) < 100 and abs(found["b"] - 1500) < 160
    assert mix_sources(docs, weights={"a": 1}).where("row.source = 'b'").count() == 0
    assert mix_sources(documents()).count() == 0


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


def test_bounds_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = sorted(rng.choice(40, size=rng.integers(1, 9), replace=False).tolist())
        counts = rng.integers(1, 20, size=len(lengths)).tolist()
        for buckets in (1, 2, 3, 4):
            bounds = best_bounds(np.array(lengths), np.array(counts), buckets)
            assert bounds[-1] == lengths[-1] and len(bounds) <= buckets
            best = min(padding(lengths, counts, [*c, lengths[-1]]) for c in itertools.combinations(lengths[:-1], min(buckets, len(lengths)) - 1))
            assert padding(lengths, counts, bounds) == best
    assert best_bounds(np.array([]), np.array([]), 4) == []


@pytest.mark.parametrize("shard_rows", [10_000, 7])
def test_batches(documents, monkeypatch, shard_rows):
    monkeypatch.setattr(packing, "SHARD_ROWS", shard_rows)
    rows = [(k, "w " * (k * k % 37)) for k in range(300)] + [(1, "w"), (1, "w"), (None, None), (900, "v " * 5000), (901, " \n")]
    found = pack(documents(*rows, extra=", bucket long, shard long"), buckets=4, token_budget=100).collect()
    assert len(found) == len(rows)
    batches = {}
    for r in found:
        assert r.n_tokens == len((r.row.text or "").split()) and 0 <= r.padding == r.bucket_length - r.n_tokens
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, _), members in batches.items():
        room = max(1, 100 // max(members[0].bucket_length, 1))
        assert sorted(r.place for r in members) == list(range(len(members))) and len(members) <= room
    for bucket in {b for b, _ in batches}:
        own = {k: len(v) for (b, k), v in batches.items() if b == bucket}
        assert sorted(own) == list(range(len(own))) and len({own[k] for k in own if k < len(own) - 1}) <= 1
    assert pack(documents()).count() == 0
