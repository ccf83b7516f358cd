"""Exact top-k by inner product with sequential reads only (no-random-access aggregation).

Candidates are dealt into blocks by hash.  Inside a block every dimension is a sorted list, read from
the top for a positive query component and from the bottom for a negative one.  After each round of
sequential reads a candidate's score is bounded: components read are known, the others lie between the
end of their list and the last value read.  A query stops when no outsider's upper bound reaches the
k-th best lower bound; final scores of the remaining contenders are then resolved.  Queries of a block
advance together, so bounds of all queries and candidates are matrix products.  The block winners are
merged by a ranked window whose partial ranks are taken before the shuffle.

Nothing is broadcast: query blocks and candidate blocks meet on a (block, block) key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common


def nra(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, rounds: int = 4) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of the k best candidates of every query; ties go to the smaller id.

    Rows of ``vectors`` must be ordered by id.  A query's own row is no candidate.
    """
    m, width = vectors.shape
    reach = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * width
    exact = np.float64 if reach < 1 << 53 else np.int64
    x, q = vectors.astype(exact), queries.astype(exact)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    order = np.argsort(x, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(m)[:, None].repeat(width, 1), 0)  # 0: lowest in its list
    lists = np.take_along_axis(x, order, 0)
    low, high = lists[0], lists[-1]
    left = np.arange(len(q))
    own = ids[None, :] == query_ids[:, None]
    depth = max(4 * k, m >> rounds)
    while len(left):
        depth = min(depth, m)
        from_top, from_bottom = place >= m - depth, place < depth
        # Upper and lower bounds of a component, read from the top (positive) or from the bottom (negative).
        hi_p, lo_p = np.where(from_top, x, lists[m - depth]), np.where(from_top, x, low)
        hi_n, lo_n = np.where(from_bottom, x, lists[depth - 1]), np.where(from_bottom, x, high)
        upper = up[left] @ hi_p.T + down[left] @ hi_n.T
        lower = up[left] @ lo_p.T + down[left] @ lo_n.T
        skip = own[left]
        least = np.iinfo(np.int64).min if exact is np.int64 else -np.inf
        lower[skip] = least
        kth = np.partition(lower, m - min(k, m), axis=1)[:, m - min(k, m)] if m else np.zeros(len(left))
        contender = (upper >= kth[:, None]) & ~skip
        few = contender.sum(1) <= max(8 * k, m // 16)
        stop = few | (depth >= m)
        for i in np.flatnonzero(stop):
            at = np.flatnonzero(contender[i])
            score = x[at] @ q[left[i]]
            for j in np.lexsort((at, -score))[:k]:
                yield int(query_ids[left[i]]), int(ids[at[j]]), int(score[j])
        left = left[~stop]
        depth *= 2


def integer_vectors(frame: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; rows with a null or non-finite component go."""
    x = F.col(f"`{vector_col}`")
    bad: Column = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return frame.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"), bad.alias("bad")).where(F.col("v").isNotNull() & ~F.col("bad") & F.col("vec_id").isNotNull()).drop("bad")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, block: int = 1024, query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score for both inputs as (vec_id, v array<long>).

    A query is compared with candidates of its own length.  Repeated rows of an id take part as they are.
    """
    queries, candidates = common.cut(queries, "queries"), common.cut(candidates, "vectors")
    nq, nc = queries.count(), candidates.count()
    qb, cb = max(1, math.ceil(nq / query_block)), max(1, math.ceil(nc / block))
    dim = F.size("v").alias("dim")
    q = queries.select("vec_id", "v", dim, F.pmod(F.xxhash64("vec_id"), F.lit(qb)).alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cb - 1).cast("long"))).alias("cb"))
    c = candidates.select("vec_id", "v", dim, F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(cb)).alias("cb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qb - 1).cast("long"))).alias("qb"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            found = nra(np.stack(left["v"].to_numpy()), left["vec_id"].to_numpy(), np.stack(right["v"].to_numpy()), right["vec_id"].to_numpy(), k)
            rows = list(found)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    keys = ("dim", "qb", "cb")
    best = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
