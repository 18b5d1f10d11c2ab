"""Exact top-k search by MaxScore over sharded postings.

Vectors are dealt into shards, each of which holds one posting list per term (dimension): the
rows with a non-zero weight. A query sorts its terms by their score bound, the most that a term
can add to any row of the shard. While the best k scores found so far exceed the summed bounds of
the weakest terms, those are non-essential: rows that occur only in their lists can't compete.
Essential lists are traversed to collect rows; the others are probed, strongest bound first, only
for rows whose score plus the bounds still open can reach the k-th best. Shard results are merged.
Weights may be negative; a bound is never below zero, as a row may lack the term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Rows of a shard and queries of a block, so one task holds a bounded part of either.
SHARD_ROWS = 1 << 13
BLOCK_QUERIES = 1 << 12
#: Rows whose postings are built and searched together; the threshold rises from one to the next.
SPAN_ROWS = 1 << 11


class Postings:
    """Posting lists of integer row vectors (rows x terms)."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.weights = ids, weights
        self.rows = [np.flatnonzero(weights[:, t]) for t in range(weights.shape[1])]
        self.values = [weights[r, t] for t, r in enumerate(self.rows)]
        self.high = weights.max(axis=0, initial=0)
        self.low = weights.min(axis=0, initial=0)

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """``best`` ((-score, id) in order, k at most) with this span's rows merged in."""
        bound = np.maximum(0, np.maximum(query * self.high, query * self.low))
        order = np.argsort(-bound, kind="stable")
        order = order[query[order] != 0]
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])
        least = -best[k - 1][0] if len(best) >= k else None
        # terms from ``cut`` on can't lift a row to the least score by themselves
        cut = len(order) if least is None else int(np.searchsorted(-rest, -least, side="right"))
        cut = min(cut, len(order))
        score = np.zeros(len(self.ids), dtype=np.int64)
        if least is None or least <= 0:
            cut, rows = len(order), np.arange(len(self.ids))
            for t in order:
                score[self.rows[t]] += query[t] * self.values[t]
        else:
            touched = np.zeros(len(self.ids), dtype=bool)
            for t in order[:cut]:
                score[self.rows[t]] += query[t] * self.values[t]
                touched[self.rows[t]] = True
            rows = np.flatnonzero(touched)
        at = cut
        while True:
            if least is not None:
                rows = rows[score[rows] + rest[at] >= least]
            if at == len(order) or not len(rows):
                break
            some = order[at : at + 4]
            score[rows] += self.weights[np.ix_(rows, some)] @ query[some]
            at += len(some)
        rows = rows[self.ids[rows] != own]
        if not len(rows):
            return best
        if len(rows) > 4 * k:
            floor = np.partition(score[rows], len(rows) - k)[len(rows) - k]
            rows = rows[score[rows] >= floor]
        return sorted(best + [(-int(s), int(i)) for s, i in zip(score[rows], self.ids[rows])])[:k]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, weights: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of one shard for each query of a block."""
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]
    for a in range(0, len(ids), SPAN_ROWS):
        span = Postings(ids[a : a + SPAN_ROWS], weights[a : a + SPAN_ROWS])
        for i, q in enumerate(queries):
            best[i] = span.search(q, int(query_ids[i]), k, best[i])
    out = [(int(q), v, -s) for q, found in zip(query_ids, best) for s, v in found]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and weights floor(256 * x) of every usable vector.

    Rows with a null id, a null vector or a null or non-finite component take no part. Rows that
    repeat an id are rows of their own. Other columns are ignored.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False)
    )
    return embeddings.where(fine).select("vec_id", F.transform(x, lambda v: F.floor(v * 256).cast("long")).alias("weights"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query.

    ``vectors`` and ``queries`` have vec_id and weights (array<long>); shorter arrays count as
    padded with zeros. Rows with the query's id are no candidates, others that share an id all are;
    queries that share an id have one result, the best of all; ties go to the smaller vec_id; with
    fewer candidates all are returned. Shards and query blocks meet in a grid of bounded cells.
    """
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    left = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(False).alias("asks"), "vec_id", "weights",
    )
    right = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asks"), "vec_id", "weights",
    )

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["asks", "vec_id"])
        width = max(map(len, rows["weights"]), default=0)
        weights = np.array([np.pad(np.asarray(w, dtype=np.int64), (0, width - len(w))) for w in rows["weights"]], dtype=np.int64).reshape(len(rows), width)
        asks, ids = rows["asks"].to_numpy(dtype=bool), rows["vec_id"].to_numpy(dtype=np.int64)
        return search_block(ids[asks], weights[asks], ids[~asks], weights[~asks], k)

    found = left.unionByName(right).groupBy("shard", "block").applyInPandas(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_embeddings(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The stated query set (ids divisible by ``every``) against all rows."""
    vectors = materialize(integer_vectors(embeddings), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
