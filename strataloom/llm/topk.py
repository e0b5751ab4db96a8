"""Exact top-k search by inner product with block-at-a-time pruning."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Documents of a block (one bound per query) and of a pack (one side of a cell); queries of a pack.
BLOCK, PACK, QUERIES = 128, 16_384, 2_048


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; NULL unless all components are finite numbers below 2 ** 62."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(2.0 ** 62)), F.lit(False)))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


class _Blocks:
    """Forward index of a pack: its vectors in blocks of alike documents, and the largest and
    least value of each term in a block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        # document order: by the term of largest weight, its sign, then id, so that ranges are alike
        lead = np.abs(vectors).argmax(axis=1) if vectors.shape[1] else np.zeros(len(ids), dtype=np.int64)
        sign = np.sign(vectors[np.arange(len(ids)), lead]) if vectors.shape[1] else lead
        order = np.lexsort((ids, sign, lead))
        self.ids, self.rows, self.vectors = ids[order], rows[order], vectors[order]
        self.edges = np.append(np.arange(0, len(ids), BLOCK), len(ids))
        self.high = np.maximum.reduceat(self.vectors, self.edges[:-1])
        self.low = np.minimum.reduceat(self.vectors, self.edges[:-1])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Summed term maxima: no document of the block can score more."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.high.T + down @ self.low.T


def search_blocks(own: np.ndarray, queries: np.ndarray, index: _Blocks, k: int) -> tuple[np.ndarray, ...]:
    """(query position, id, score) of each query's ``k`` best, ties to the smaller id; its ``own`` row left out.

    Each query takes the blocks in the order of their bounds and stops at the first one below its
    k-th score. Queries whose next block is the same are scored together. Sums are of integers
    below 2 ** 53, so the float products are exact.
    """
    bounds = index.bounds(queries)
    turn = np.argsort(-bounds, axis=1, kind="stable")
    n = len(queries)
    best_score = np.full((n, k), -np.inf)
    best_id = np.full((n, k), np.iinfo(np.int64).max)
    active = np.arange(n)
    for step in range(turn.shape[1]):
        block = turn[active, step]
        # a block that can only equal the k-th score may still hold a smaller id
        open_ = bounds[active, block] >= best_score[active, -1]
        active, block = active[open_], block[open_]
        if not len(active):
            break
        for b in np.unique(block):
            who = active[block == b]
            a, e = index.edges[b], index.edges[b + 1]
            score = queries[who] @ index.vectors[a:e].T
            score[own[who][:, None] == index.rows[a:e][None, :]] = -np.inf
            scores = np.concatenate([best_score[who], score], axis=1)
            ids = np.concatenate([best_id[who], np.broadcast_to(index.ids[a:e], score.shape)], axis=1)
            rank = np.lexsort((ids, -scores), axis=1)[:, :k]
            best_score[who], best_id[who] = np.take_along_axis(scores, rank, 1), np.take_along_axis(ids, rank, 1)
    at, place = np.nonzero(np.isfinite(best_score))
    return at, best_id[at, place], best_score[at, place].astype(np.int64)


def search_exact(own: np.ndarray, queries: list, ids: np.ndarray, rows: np.ndarray, vectors: list, k: int) -> tuple[np.ndarray, ...]:
    """As ``search_blocks``, in whole numbers of any size; scores beyond a long become its largest or least value."""
    most = 2 ** 63 - 1
    found = []
    for at, q in enumerate(queries):
        q = [int(x) for x in q]
        scored = ((max(-most - 1, min(most, sum(x * int(y) for x, y in zip(q, v)))), int(i)) for i, r, v in zip(ids, rows, vectors) if r != own[at])
        found += [(at, i, s) for s, i in heapq.nsmallest(k, scored, key=lambda p: (-p[0], p[1]))]
    return tuple(np.array([f[c] for f in found], dtype=np.int64) for c in range(3))


def top_k(vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "vector", k: int = 5) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` largest inner products of each query row with all rows but its own.

    ``vector`` is an array of longs. Rows with a NULL id or vector take no part; a query meets the
    vectors of its own length. Rows that share an id are rows of their own, and a row repeated as a whole
    is met as often as it is there, by its own copies too; a repeated query has its answer as many times.
    Queries and documents are dealt into packs of bounded size by a hash; each pack of queries meets each
    pack of documents in one cell, which returns ``k`` rows a query. Fewer candidates than ``k`` give
    fewer rows; no rows, none.
    """
    one = lambda df: df.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).groupBy(F.col(id).alias("id"), F.col(vector).alias("v")).agg(F.count("*").alias("n"))
    # no answer holds more than k copies of a row beside its own
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k + 1)).cast("int")))
    docs = stored(one(vectors.select(id, vector)).select("id", "v", copies.alias("copy")).withColumn("row", F.monotonically_increasing_id()))
    asked = stored(one(queries.select(id, vector)).join(docs.where("copy = 1").select("id", "v", "row"), ["id", "v"], "left").select(
        "id", "v", "n", F.coalesce("row", F.lit(-1)).alias("row")).withColumn("query", F.monotonically_increasing_id()))
    n_docs, n_asked = 1 + docs.count() // PACK, 1 + asked.count() // QUERIES
    part = lambda n: F.pmod(F.xxhash64("id", "row"), F.lit(n)).cast("int")
    cells = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("query", "v", "row", F.size("v").alias("size"), part(n_asked).alias("q"), cells(n_docs).alias("d"))
    right = docs.select("id", "v", "row", F.size("v").alias("size"), part(n_docs).alias("d"), cells(n_asked).alias("q"))

    def search(some: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
        columns = {"query": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)}
        if not len(some) or not len(all_):
            return pd.DataFrame(columns)
        own, ids, rows = some["row"].to_numpy(), all_["id"].to_numpy(), all_["row"].to_numpy()
        mine, theirs = (np.array(df["v"].tolist(), dtype=np.float64).reshape(len(df), -1) for df in (some, all_))
        if mine.shape[1] * np.abs(mine).max(initial=0) * np.abs(theirs).max(initial=0) < 2.0 ** 53:
            at, found, score = search_blocks(own, mine, _Blocks(ids, rows, theirs), k)
        else:
            at, found, score = search_exact(own, some["v"].tolist(), ids, rows, all_["v"].tolist(), k)
        return pd.DataFrame({"query": some["query"].to_numpy()[at], "id": found, "score": score})

    hits = left.groupBy("q", "d", "size").cogroup(right.groupBy("q", "d", "size")).applyInPandas(search, "query bigint, id bigint, score bigint")
    # k rows for each pack of documents: a sorted list per query
    ranked = hits.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("i")))), 1, k).alias("best"))
    answered = ranked.join(asked.select("query", F.col("id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))), "query")
    return answered.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("b.i").alias(id), (-F.col("b.s")).alias("score"))
