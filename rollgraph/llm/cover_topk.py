"""Exact top-k search by inner product with dual cover trees (operator 8).

Vectors become whole numbers, ``floor(scale * x)``.  ``cells`` cuts queries and data into
blocks along the upper levels of one cover tree and ships only pairs of blocks whose
bound reaches the worst k-th score of the query block.  In a task both blocks are
indexed by a cover tree, and node pairs are walked best bound first.  A pair is left
out if <cq, cd> + rq * |cd| + rd * |cq| + rq * rd, which no inner product inside exceeds,
is below the worst k-th score of the query node.  The best k of all blocks are merged.

Cases: vectors that are null or hold null or non-finite components take no part, nor
do rows without an id; rows that share an id are rows of their own, both as queries
and as candidates, but no candidate of a query with that id; only vectors of equal
length are compared; ties go to the smaller id; fewer candidates give fewer rows; an
empty table gives none; other columns are ignored.  Vectors of any length are rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import cells

QUERY_LEAF = 32
DATA_LEAF = 256


def top_k(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores) of the k best rows for each query, by dual-tree search, and the
    inner products computed.  Rows below a query's ``floor`` may be missing; where there
    are fewer than k the score is ``cells.LEAST``."""
    best = np.full((len(queries), k), cells.LEAST, np.int64)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    worst = np.full(len(queries), cells.LEAST) if floor is None else floor.copy()
    computed = 0
    if not len(queries) or not len(data):
        return best_ids, best, computed

    def bound(q: cells.Node, d: cells.Node) -> float:
        value = float(q.centre @ d.centre)
        slack = q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        return value + slack + 1e-9 * (abs(value) + slack) + 0.5

    roots = cells.grow(queries, QUERY_LEAF), cells.grow(data, DATA_LEAF)
    stack = [(bound(*roots), *roots)]
    while stack:
        most, q, d = stack.pop()
        if most < worst[q.rows].min():
            continue
        if q.children or d.children:
            pairs = [(bound(x, y), x, y) for x in (q.children or [q]) for y in (d.children or [d])]
            stack += sorted(pairs, key=lambda p: p[0])  # the best one is popped first
            continue
        scores = cells.products(queries[q.rows], data[d.rows])
        computed += scores.size
        scores = np.where(ids[d.rows] == query_ids[q.rows][:, None], cells.LEAST, scores)
        hit = (scores >= worst[q.rows][:, None]).any(axis=1)
        some, scores = q.rows[hit], scores[hit]
        if not len(some):
            continue
        merged = np.concatenate([best[some], scores], axis=1)
        merged_ids = np.concatenate([best_ids[some], np.broadcast_to(ids[d.rows], scores.shape)], axis=1)
        order = np.lexsort((merged_ids, -merged), axis=-1)[:, :k]
        best[some] = np.take_along_axis(merged, order, axis=1)
        best_ids[some] = np.take_along_axis(merged_ids, order, axis=1)
        worst[some] = np.maximum(worst[some], best[some, -1])
    return best_ids, best, computed


def search(vectors: DataFrame, asked: Column | str, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for each row of
    ``vectors`` (vec_id, embedding) for which ``asked`` holds."""
    rows = cells.whole_vectors(vectors, scale, cells.asked(asked))
    index = cells.Cells(rows)

    def walk(left: pa.Table, right: pa.Table, floors: list):
        ids = np.asarray(right.column("id"))
        found, scores, _ = top_k(
            np.asarray(left.column("id")), cells.grid(left.column("v")), ids, cells.grid(right.column("v")), k,
            np.array([f[0] for f in floors], np.int64),
        )
        for i, (own, score) in enumerate(zip(found, scores)):
            full = score > cells.LEAST
            yield i, 0, own[full], score[full]

    open_window = {"low": F.array(F.lit(cells.LEAST)), "high": F.array(F.lit(cells.MOST))}
    queries = index.rows.where("asked").withColumns(open_window)
    found = index.search(queries, k, walk)
    named = index.rows.where("asked").select("tag", F.col("id").alias("query_id"))
    return found.join(named, "tag").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
