"""Recall against brute force, ties, copies and odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from navloom.llm.common import table
from navloom.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, key int, rank int"


def brute_force(ids, vectors, query, k=20):
    score = vectors @ vectors[ids == query][0]
    order = [j for j in np.lexsort((ids, -score)) if ids[j] != query][:k]
    return [(int(ids[j]), score[j]) for j in order]


def test_recall(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    rows = table(spark, folder, "embeddings")
    frame = rows.toPandas().sort_values("vec_id")
    ids, vectors = frame["vec_id"].to_numpy(), np.stack(frame["embedding"]).astype(np.float64)
    found = nearest(rows, F.col("vec_id") % 20 == 0, shard_rows=900).toPandas()
    hits = total = 0
    for query, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        want = brute_force(ids, vectors, query)
        assert part["rank"].tolist() == list(range(1, len(want) + 1)) and query not in set(part["vec_id"])
        exact = [float((vectors[ids == v][0] * vectors[ids == query][0]).sum()) for v in part["vec_id"]]
        assert np.allclose(part["score"], exact, rtol=1e-12) and sorted(part["score"], reverse=True) == part["score"].tolist()
        hits += len({v for v, _ in want} & set(part["vec_id"]))
        total += len(want)
    assert len(found["query_id"].unique()) == (ids % 20 == 0).sum() and hits / total >= 0.9


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [1.0, 0.0, 0.0], 0, 1, 2) for k in range(0, 700)]
    rows += [(k, [float(x) for x in rng.normal(size=3)], 0, 1, 2) for k in range(1000, 1100)]
    rows += [(2000, None, 0, 1, 2), (2020, [0.0, 0.0, 0.0], 0, 1, 2), (2040, [1.0, None, 0.0], 0, 1, 2), (2060, [float("nan"), 1.0, 0.0], 0, 1, 2), (2080, [float("inf"), 1.0, 0.0], 0, 1, 2), (None, [1.0, 1.0, 1.0], 0, 1, 2), (2100, [], 0, 1, 2)]
    rows += [(3000, [1.0, 2.0], 0, 1, 2), (3001, [2.0, 1.0], 0, 1, 2)]
    found = {}
    for r in nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, shard_rows=64).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = [(r[0], np.array(r[1], dtype=np.float32).astype(np.float64)) for r in rows if r[0] is not None and r[0] < 2000]
    ids, vectors = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    assert set(found) == {*(int(i) for i in ids if i % 20 == 0), 3000}
    for query in ids[ids % 20 == 0]:
        got = sorted(found[query])
        assert [v for _, v, _ in got] == [v for v, _ in brute_force(ids, vectors, query)]
    assert found[3000] == [(1, 3001, 4.0)]
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
