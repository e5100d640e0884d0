"""Approximate nearest neighbours by inner product: a robust-pruned directed graph in every shard, searched with a beam."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.common import quoted
from navloom.session import cut_lineage

#: Distinct vectors of one shard, whose graph one task builds and holds.
SHARD_ROWS = 32_768
#: Queries that are searched together in one shard.
QUERY_BLOCK = 2_048
#: Shards up to this size are compared as a whole.
SMALL_SHARD = 512


def _order(distances: np.ndarray) -> np.ndarray:
    return np.argsort(distances, axis=1, kind="stable")


def beam_search(points: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries in step: ids and squared distances (less the query's norm) of the ``beam`` nearest found.

    Each step opens the ``width`` nearest unopened points of every beam; a query ends when its whole beam is open.
    """
    n = len(queries)
    ids = np.full((n, beam), -1, dtype=np.int32)
    far = np.full((n, beam), np.inf, dtype=np.float32)
    opened = np.ones((n, beam), dtype=bool)
    ids[:, 0], far[:, 0], opened[:, 0] = entry, norms[entry] - 2 * (queries @ points[entry]), False
    live = np.arange(n)
    while len(live):
        shut = ~opened[live]
        live = live[shut.any(axis=1)]
        if not len(live):
            break
        closed = ~opened[live]
        rank = np.cumsum(closed, axis=1)
        pick = closed & (rank <= width)
        opened[live] |= pick
        order = np.argsort(~pick, axis=1, kind="stable")[:, :width]
        chosen = np.take_along_axis(np.where(pick, ids[live], -1), order, axis=1)
        near = np.where((chosen >= 0)[:, :, None], graph[chosen], -1).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        known = (near[:, :, None] == ids[live][:, None, :]).any(axis=2)
        near[known] = -1
        distance = norms[near] - 2 * np.einsum("ard,ad->ar", points[near], queries[live], optimize=True)
        distance[near < 0] = np.inf
        all_ids = np.concatenate((ids[live], near), axis=1)
        all_far = np.concatenate((far[live], distance), axis=1)
        all_open = np.concatenate((opened[live], near < 0), axis=1)
        best = _order(all_far)[:, :beam]
        ids[live], far[live], opened[live] = (np.take_along_axis(x, best, axis=1) for x in (all_ids, all_far, all_open))
    ids[~np.isfinite(far)] = -1
    return ids, far


def robust_prune(points: np.ndarray, norms: np.ndarray, centres: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Diverse neighbours of every centre out of its candidates (-1: none): the nearest one stays and removes what is
    ``relax`` times nearer to it than to the centre, again and again."""
    candidates = np.where(candidates == centres[:, None], -1, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    vectors = points[candidates]
    far = norms[candidates] + norms[centres][:, None] - 2 * np.einsum("acd,ad->ac", vectors, points[centres], optimize=True)
    far[candidates < 0] = np.inf
    order = _order(far)
    candidates, far = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(far, order, axis=1)
    vectors = points[candidates]
    between = norms[candidates][:, :, None] + norms[candidates][:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    alive = np.isfinite(far)
    kept = np.full((len(centres), degree), -1, dtype=np.int32)
    rows = np.arange(len(centres))
    for slot in range(degree):
        at = alive.argmax(axis=1)
        some = alive[rows, at]
        if not some.any():
            break
        kept[some, slot] = candidates[rows, at][some]
        drop = relax * relax * between[rows, at] <= far
        drop[rows, at] = True
        alive &= ~(drop & some[:, None])
    return kept


def build_graph(points: np.ndarray, degree: int, beam: int, relax: float, seed: int = 17) -> tuple[np.ndarray, int]:
    """Out-neighbours of every point (-1: none) and the entry point; points enter in batches that grow with the graph."""
    n = len(points)
    norms = np.einsum("ij,ij->i", points, points)
    graph = np.full((n, degree), -1, dtype=np.int32)
    centre = points.mean(axis=0)
    entry = int(np.argmin(norms - 2 * points @ centre))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([entry], order[order != entry])).astype(np.int32)
    done = 1
    while done < n:
        batch = order[done : done + min(max(done // 4, 1), 512)]
        found, _ = beam_search(points, norms, graph, entry, points[batch], beam)
        graph[batch] = robust_prune(points, norms, batch, found, degree, relax)
        sources = np.repeat(batch, degree)
        targets = graph[batch].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        by = np.argsort(targets, kind="stable")
        sources, targets = sources[by], targets[by]
        nodes, start, count = np.unique(targets, return_index=True, return_counts=True)
        for size in np.unique(np.minimum(np.ceil(np.log2(count)), 16)):  # nodes with about as many new edges together
            some = np.minimum(np.ceil(np.log2(count)), 16) == size
            most = int(count[some].max())
            offset = np.arange(most)[None, :]
            inside = offset < count[some][:, None]
            new = np.where(inside, sources[np.minimum(start[some][:, None] + offset, len(sources) - 1)], -1)
            own, merged = nodes[some], np.concatenate((graph[nodes[some]], new), axis=1)
            for cut in range(0, len(own), 512):
                part, several = own[cut : cut + 512], merged[cut : cut + 512]
                full = (several >= 0).sum(axis=1) > degree
                roomy = np.argsort(several < 0, axis=1, kind="stable")[:, :degree]
                graph[part[~full]] = np.take_along_axis(several, roomy, axis=1)[~full]
                if full.any():
                    graph[part[full]] = robust_prune(points, norms, part[full], several[full], degree, relax)
        done += len(batch)
    return graph, entry


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers and one of them not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(frame: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in frame])


def nearest(vectors: DataFrame, queries: Column, k: int = 20, degree: int = 32, beam: int = 64, search_beam: int = 96, relax: float = 1.2, shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` rows with the largest inner product found for each row that
    ``queries`` marks, the row itself left out; ties to the smaller id.

    Vectors are dealt to shards by a hash; one more component, ``sqrt(largest norm^2 - norm^2)``, turns the inner product
    into a distance.  Every shard's graph is built once and meets the queries in blocks, the stated query set against
    all rows.  Equal vectors are one point of a graph, with the ``k + 1`` smallest ids, as no other copy can be
    among the ``k`` best.  Scores are recomputed in double precision from the vectors as given.

    Null, zero, or not finite vectors and rows without an id take no part.  Vectors of different lengths never meet.
    Rows that repeat an id count once per different vector.  Empty table: no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    name, vector = F.col(quoted(id_col)).cast("long"), F.col(quoted(vector_col)).cast("array<double>")
    rows = vectors.select(name.alias("id"), vector.alias("vector"), queries.alias("asked")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("key", F.md5(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string")))))
    salted = rows.select("key", "id", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).distinct()
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("key", "salt").orderBy("id"))).where(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("r") <= k + 1)
    owners = few.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = cut_lineage(rows.groupBy("key").agg(F.first("vector").alias("vector")).join(owners, "key"))
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x)).alias("top")).first()
    shards = max(1, -(-size.n // shard_rows))
    top = float(size.top or 0.0)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        exact = _matrix(frame["vector"])
        extra = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", exact, exact), 0.0))
        flat = np.ascontiguousarray(np.column_stack((exact, extra)), dtype=np.float32)
        graph, entry = build_graph(flat, degree, beam, relax) if len(flat) > SMALL_SHARD else (np.zeros((0, degree), dtype=np.int32), 0)
        least = np.array([ids[0] for ids in frame["ids"]], dtype=np.int64)
        keys = "".join(frame["key"]).encode()
        return pd.DataFrame({"dim": [exact.shape[1]], "shard": [int(frame["shard"].iloc[0])], "entry": [entry], "exact": [exact.tobytes()], "flat": [flat.tobytes()], "graph": [graph.tobytes()], "least": [least.tobytes()], "keys": [keys]})

    dealt = points.select("*", F.size("vector").alias("dim"), F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"))
    graphs = dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, entry int, exact binary, flat binary, graph binary, least binary, keys binary")
    graphs = cut_lineage(graphs)

    asked = rows.where("asked").select("key", F.col("id").alias("query_id")).distinct()
    asked = cut_lineage(asked)
    wanted = points.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vector", F.size("vector").alias("dim"))
    blocks = max(1, -(-asked.select("key").distinct().count() // QUERY_BLOCK))
    wanted = wanted.select("*", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    served = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query": pd.Series(dtype="str"), "key": pd.Series(dtype="str"), "score": pd.Series(dtype="float64")})
        if left.empty or right.empty:
            return out
        g = left.iloc[0]
        dim = int(g["dim"])
        exact = np.frombuffer(g["exact"], dtype=np.float64).reshape(-1, dim)
        flat = np.frombuffer(g["flat"], dtype=np.float32).reshape(-1, dim + 1)
        graph = np.frombuffer(g["graph"], dtype=np.int32).reshape(-1, degree)
        least = np.frombuffer(g["least"], dtype=np.int64)
        keys = np.frombuffer(g["keys"], dtype="S32")
        norms = np.einsum("ij,ij->i", flat, flat)
        parts = [out]
        for cut in range(0, len(right), 256):
            some = right.iloc[cut : cut + 256]
            q = _matrix(some["vector"])
            if len(graph):
                flat_q = np.column_stack((q, np.zeros(len(q)))).astype(np.float32)
                ids, _ = beam_search(flat, norms, graph, int(g["entry"]), flat_q, max(search_beam, k + 1))
            else:
                ids = np.tile(np.arange(len(exact), dtype=np.int32), (len(q), 1))
            score = (exact[ids] * q[:, None, :]).sum(axis=2)
            score[ids < 0] = -np.inf
            order = np.lexsort((least[ids], -score), axis=1)[:, : k + 1]
            ids, score = np.take_along_axis(ids, order, axis=1), np.take_along_axis(score, order, axis=1)
            fine = ids >= 0
            parts.append(pd.DataFrame({"query": np.repeat(some["key"].to_numpy(), fine.sum(axis=1)), "key": keys[ids[fine]].astype(str), "score": score[fine]}))
        return pd.concat(parts)

    found = served.groupBy("dim", "shard", "block").cogroup(wanted.groupBy("dim", "shard", "block")).applyInPandas(search, "query string, key string, score double")
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1))
    best = found.join(points.select("key", "ids"), "key").withColumn("r", F.row_number().over(by_query)).where(F.col("r") <= k + 1)
    each = best.select(F.col("query").alias("key"), "score", F.explode("ids").alias("vec_id"))
    few = each.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    pairs = asked.join(few.drop("r"), "key").where("vec_id <> query_id").drop("key")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
