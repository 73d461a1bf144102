"""Exact top-k inner products by pivot-table elimination.

Every vector stores its distances to the same pivots. For a query q and a vector x, max over pivots |d(q, p) - d(x, p)| is a lower
bound of d(q, x), and <q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2, so the table gives an upper bound of every score without touching
the vector. Candidates are evaluated in the order of their bounds until the k-th best score beats the next bound.

Vectors are dealt to blocks by the hash of their id, and queries to groups. Each (group, block) is one task, which keeps its k best
of each query; the k best of all blocks follow from those. Work is queries times vectors, as it must be without an index, but
a task holds one block and one group only. Queries are copied to every block; vectors are copied once for every group of queries.

Scores are exact integers: components are floor(scale * x). Products are summed in doubles where that is exact (sums below 2**53),
and else as Python integers; a score beyond 64 bits is an error.

Defined results: vectors that are null, or hold null or non-finite components, take no part, and neither do rows without an id;
vectors of another length than the query have no score with it; equal scores go by the smaller id; fewer than k candidates give
fewer rows; a repeated id is a candidate in each of its rows, but never of a query with the same id, and the distinct vectors
of a repeated id are one query, whose best scores are taken together; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

PIVOTS = 32
#: Vectors in a block and queries in a group, on average.
BLOCK, GROUP = 4096, 512
#: Candidates evaluated before the first look at the bounds; each further step doubles.
FIRST = 32


def integer_vectors(rows: DataFrame, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): floor(scale * x) of complete and finite vectors."""
    whole = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x")).where(F.forall("x", whole)).select(
        "id", F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e).cast("double")).alias("v"))


def choose_pivots(vectors: DataFrame, number: int) -> np.ndarray:
    """`number` vectors that are far apart, of a few hundred with the smallest hashes; any choice gives exact results."""
    some = [np.array(r["v"]) for r in vectors.orderBy(F.xxhash64("id"), "id").limit(16 * number).collect()]
    width = max((len(v) for v in some), default=0)
    some = [v for v in some if len(v) == width]
    if not some:
        return np.zeros((0, 0))
    every, chosen = np.stack(some), [0]
    far = np.linalg.norm(every - every[0], axis=1)
    while len(chosen) < min(number, len(every)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(every - every[chosen[-1]], axis=1))
    return every[chosen]


def distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(v - p, axis=1) for p in pivots], axis=1) if len(pivots) else np.zeros((len(v), 0))


def _matrices(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for every length of vectors in a group of rows, ids ascending."""
    table = table.sort_by("id").combine_chunks()
    ids, lists = table["id"].to_numpy(), table["v"].combine_chunks() if table.num_rows else None
    if lists is None:
        return []
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    return [(ids[chosen], flat[starts[chosen][:, None] + np.arange(n)]) for n in np.unique(sizes)
            for chosen in [np.flatnonzero(sizes == n)]]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of x with q."""
    if len(q) * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2**53:
        return x @ q
    whole = [int(c) for c in q]
    return np.array([sum(a * int(b) for a, b in zip(whole, row)) for row in x.tolist()], object)


def best(qid, q, q_table, ids, x, x_table, x_norms, k):
    """The k best (score, id) of one query in one block, ids ascending: candidates by bound, until no bound can beat the k-th."""
    low = np.abs(x_table - q_table).max(axis=1) if x_table.shape[1] else np.zeros(len(x))
    # The slack covers rounding of distances and norms, so a bound is never below the true score.
    bound = (q @ q + x_norms - np.maximum(0, low * (1 - 1e-9) - 1e-6) ** 2) / 2
    bound += 1 + 1e-9 * (q @ q + x_norms)
    bound[ids == qid] = -np.inf
    order = np.argsort(-bound, kind="stable")
    order = order[: len(order) - int((ids == qid).sum())]
    found: list[tuple] = []
    at, step = 0, max(FIRST, k)
    while at < len(order):
        if len(found) == k and found[-1][0] > bound[order[at]]:
            break
        now = order[at : at + step]
        scores = products(q, x[now])
        if len(found) == k and scores.dtype != object:
            now, scores = now[scores >= found[-1][0]], scores[scores >= found[-1][0]]
        merged = found + [(int(s), int(i)) for s, i in zip(scores, ids[now])]
        found = sorted(merged, key=lambda c: (-c[0], c[1]))[:k]
        at, step = at + step, 2 * step
    return found


def top_k(queries: DataFrame, vectors: DataFrame, k: int, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, id, score): the k best inner products of each query; both inputs have id and v."""
    n_queries, n_vectors = queries.count(), vectors.count()
    n_groups, n_blocks = max(1, math.ceil(n_queries / GROUP)), max(1, math.ceil(n_vectors / BLOCK))
    pivot = choose_pivots(vectors, pivots)
    asked = queries.distinct().withColumn("g", F.pmod(F.xxhash64("id"), F.lit(n_groups)).cast("int")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    held = vectors.withColumn("b", F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(n_blocks)).cast("int")).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        blocks = {x.shape[1]: (ids, x) for ids, x in _matrices(right)}
        for qids, qs in _matrices(left):
            ids, x = blocks.get(qs.shape[1], (None, None))
            if ids is None:
                continue
            own = pivot if len(pivot) and pivot.shape[1] == qs.shape[1] else np.zeros((0, qs.shape[1]))
            q_table, x_table, norms = distances(qs, own), distances(x, own), (x * x).sum(axis=1)
            for qid, q, row in zip(qids.tolist(), qs, q_table):
                out += [(qid, i, s) for s, i in best(qid, q, row, ids, x, x_table, norms, k)]
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "id": pa.array([r[1] for r in out], pa.int64()),
                         "score": pa.array([r[2] for r in out], pa.int64())})

    near = asked.groupBy("g", "b").cogroup(held.groupBy("g", "b")).applyInArrow(
        search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
