"""Exact inner-product search by block-at-a-time pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import saved

_EXACT = 2**53


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Best:
    """The ``k`` best (score, smaller id first) of each query so far; an id occurs once."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.score = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)

    def bound(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of candidates ``ids`` for the queries ``rows``."""
        scores = np.where(self.queries[rows][:, None] == ids[None, :], -np.inf, scores)
        every = np.concatenate([self.score[rows], scores], axis=1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((names, -every), axis=1)
        every, names = np.take_along_axis(every, order, 1), np.take_along_axis(names, order, 1)
        if (names[:, 1:] == names[:, :-1]).any():
            # repeated rows: the second of equal ids moves to the end
            sorted_names = np.argsort(names, axis=1, kind="stable")
            by_name = np.take_along_axis(names, sorted_names, 1)
            again = np.zeros(names.shape, bool)
            np.put_along_axis(again, sorted_names[:, 1:], by_name[:, 1:] == by_name[:, :-1], 1)
            every = np.where(again, -np.inf, every)
            order = np.lexsort((names, -every), axis=1)
            every, names = np.take_along_axis(every, order, 1), np.take_along_axis(names, order, 1)
        self.score[rows], self.ids[rows] = every[:, : self.k], names[:, : self.k]


def _ranges(matrix: np.ndarray, block: int) -> list[np.ndarray]:
    """Document ranges: rows in the order of their nearest of a few fixed pivots, cut every ``block`` rows."""
    pivots = matrix[:: max(1, len(matrix) // 32)][:32]
    order = np.argsort((matrix @ pivots.T).argmax(axis=1), kind="stable")
    return [order[i : i + block] for i in range(0, len(order), block)]


def search_blocks(best: Best, queries: np.ndarray, ids: np.ndarray, matrix: np.ndarray, block: int) -> int:
    """Offer all candidates that can matter; returns the number of (query, block) pairs scored.

    A block's bound for a query is the sum over the terms of the largest product that any of its rows can
    give (the term's maximum for a positive weight, its minimum for a negative one). A query takes the blocks
    from the highest bound down and stops when the next bound is below its k-th score; an equal bound is
    still scored, since a smaller id may win the tie.
    """
    ranges = _ranges(matrix, block)
    high = np.array([matrix[r].max(axis=0) for r in ranges])
    low = np.array([matrix[r].min(axis=0) for r in ranges])
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    active, scored = np.arange(len(queries)), 0
    for step in range(len(ranges)):
        now = order[active, step]
        alive = bounds[active, now] >= best.bound()[active]
        active, now = active[alive], now[alive]
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(now):
            rows = active[now == b]
            best.offer(rows, queries[rows] @ matrix[ranges[b]].T, ids[ranges[b]])
    return scored


def _distinct(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without rows that repeat both id and vector."""
    if len(np.unique(ids)) == len(ids):
        return ids, matrix
    _, first = np.unique(np.column_stack([ids, matrix.view(np.int64)]), axis=0, return_index=True)
    return ids[first], matrix[first]


def _search(shared, width: int, k: int, block: int, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best = Best(query_ids, k)
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column(1).to_pylist(), width)
            ids, matrix = _distinct(batch.column(0).to_numpy(zero_copy_only=False), matrix)
            if np.abs(matrix).max(initial=0) * most * max(1, width) >= _EXACT:
                raise ValueError("inner products of these vectors do not fit 53 bits")
            search_blocks(best, queries, ids, matrix, block)
        rows, places = np.nonzero(np.isfinite(best.score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[rows]), pa.array(best.ids[rows, places]), pa.array(best.score[rows, places].astype(np.int64))],
            ["query_id", "vec_id", "score"],
        )

    return run


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, x`` with ``floor(scale * component)`` as doubles; rows without a usable vector are left out."""
    odd = F.exists(vector_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(~odd).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double")).alias("x"),
    )


def top_k(
    df: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    k: int = 5,
    block: int = 64,
    wave_bytes: int = 16 << 20,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest integer inner product per query.

    Components become ``floor(scale * x)``. Queries are the rows where ``is_query`` (on ``vec_id``) holds, candidates
    all rows but those with the query's own id; ties go to the smaller id; fewer candidates give fewer rows.
    Queries are taken in waves of at most about ``wave_bytes`` of vectors. A wave goes to all tasks, each of which
    reads its part of the table once, batch by batch, and keeps the best ``k`` per query; a batch is cut into
    ranges of ``block`` rows that are pruned by their bounds. No vector is shuffled, only the tasks' best rows.

    Vectors that are NULL or hold a NULL, NaN or infinite component, and rows with NULL id, take no part. Vectors of
    different length are compared as if the shorter ended in zeros. Rows repeating an id and vector count
    once; of different vectors with one id the best counts as candidate, and as query each is one. Products
    beyond 53 bits raise an error. Other columns are not read. An empty table gives an empty result.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, id_col, vector_col, scale)
    queries = vectors.where(is_query).distinct()
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    schema = "query_id long, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(width, vectors.agg(F.max(F.size("x"))).first()[0])
    waves = math.ceil(n * max(1, width) * 8 / wave_bytes)
    parts = None
    for wave in range(waves):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave).orderBy("vec_id", "x").collect()
        if not rows:
            continue
        matrix = _matrix([r.x for r in rows], width)
        shared = spark.sparkContext.broadcast((np.array([r.vec_id for r in rows], np.int64), matrix))
        part = saved(vectors.mapInArrow(_search(shared, width, k, block, float(np.abs(matrix).max(initial=0))), schema), "wave")
        parts = part if parts is None else parts.unionByName(part)
    once = parts.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
