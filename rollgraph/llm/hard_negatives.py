"""Hard negatives within score windows, over a cover tree (operator 12).

An anchor's positives are its best rows of the same label by inner product.  For each
positive the best rows of other labels are wanted whose score lies between two shares
of the positive's.  Vectors become whole numbers, ``floor(scale * x)``.

Candidates of a block are augmented by sqrt(M^2 - |x|^2), M the greatest norm, so that
all have one norm and the inner product falls with the distance:  2 <q, x> = |q|^2 +
M^2 - |q' - x'|^2.  A cover tree over them gives, level by level, a centre and a
covering radius, hence a least and a most inner product with each anchor.  Nodes are
opened best first; one that lies outside all windows of an anchor, or below the worst
row that its windows hold, is skipped.  Leaves are verified by exact products.

``cells`` cuts anchors and candidates into blocks and leaves out the pairs of blocks that
cannot reach a window.  Positives are found by the same search, with an open window.

Cases: rows with a null id, label or vector, or with a component that is null or not
finite, take no part; rows that share an id are rows of their own, but no positive of
an anchor with that id; ties go to the smaller id; an anchor without positives and a
window without rows give no rows, so does an empty table; a positive of a negative score
has an empty window; other columns are ignored; only vectors of equal length meet.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollgraph.llm import cells
from rollgraph.llm.store import materialise

LEAF = 128


def window_top(
    anchors: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, floor: np.ndarray,
    ids: np.ndarray, points: np.ndarray, allowed, k: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores) of the k best rows of each window, and the products computed.

    Window ``i`` belongs to anchor ``owner[i]`` and holds scores from ``low`` to ``high``;
    rows below its ``floor`` may be missing.  ``allowed(anchors, rows)`` is the matrix of
    pairs that count.  Where there are fewer than k the score is ``cells.LEAST``.
    """
    best = np.full((len(owner), k), cells.LEAST, np.int64)
    best_ids = np.full((len(owner), k), np.iinfo(np.int64).max)
    worst = np.maximum(low, floor)
    computed = 0
    if not len(owner) or not len(points):
        return best_ids, best, computed
    squares = (points**2).sum(axis=1)
    top = float(squares.max())
    tree = cells.grow(np.column_stack([points, np.sqrt(top - squares)]), LEAF)
    lengths = (anchors**2).sum(axis=1)

    def bounds(nodes: list[cells.Node], some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most inner product of each window's anchor with each node."""
        centres = np.array([n.centre for n in nodes])
        radius = np.array([n.radius for n in nodes])
        own, at = np.unique(owner[some], return_inverse=True)
        away = lengths[own][:, None] + (centres**2).sum(axis=1) - 2 * anchors[own] @ centres[:, :-1].T
        away = np.sqrt(np.maximum(away, 0))
        total = lengths[own][:, None] + top
        slack = 1e-7 * (total + radius**2) + 0.5
        least = (total - (away + radius) ** 2) / 2 - slack
        most = (total - np.maximum(away - radius, 0) ** 2) / 2 + slack
        return least[at], most[at]

    everything = np.flatnonzero(low <= high)
    if not len(everything):
        return best_ids, best, computed
    heap = [(0.0, 0, tree, everything, None)]
    count = 0
    while heap:
        _, _, node, some, most = heapq.heappop(heap)
        if most is not None:  # windows may have filled since the node was seen
            some = some[most >= worst[some]]
            if not len(some):
                continue
        if node.children:
            least, most = bounds(node.children, some)
            for j, child in enumerate(node.children):
                need = (most[:, j] >= worst[some]) & (least[:, j] <= high[some])
                if need.any():
                    count += 1
                    heapq.heappush(heap, (-float(most[need, j].max()), count, child, some[need], most[need, j]))
            continue
        own, at = np.unique(owner[some], return_inverse=True)
        scores = cells.products(anchors[own], points[node.rows])
        computed += scores.size
        scores = np.where(allowed(own, node.rows), scores, cells.LEAST)[at]
        scores = np.where((scores >= worst[some][:, None]) & (scores <= high[some][:, None]), scores, cells.LEAST)
        hit = (scores > cells.LEAST).any(axis=1)
        some, scores = some[hit], scores[hit]
        merged = np.concatenate([best[some], scores], axis=1)
        merged_ids = np.concatenate([best_ids[some], np.broadcast_to(ids[node.rows], scores.shape)], axis=1)
        order = np.lexsort((merged_ids, -merged), axis=-1)[:, :k]
        best[some] = np.take_along_axis(merged, order, axis=1)
        best_ids[some] = np.take_along_axis(merged_ids, order, axis=1)
        worst[some] = np.maximum(worst[some], best[some, -1])
    return best_ids, best, computed


def _walk(k: int, same: bool):
    """The search of a pair of blocks, among rows of the anchor's label or of others."""

    def walk(left: pa.Table, right: pa.Table, floors: list):
        ids, names = np.asarray(right.column("id")), np.asarray(left.column("id"))
        labels, own = np.asarray(right.column("label")), np.asarray(left.column("label"))
        low, high = left.column("low").to_pylist(), left.column("high").to_pylist()
        owner = np.repeat(np.arange(len(low)), [len(x) for x in low])
        window = np.concatenate([np.arange(len(x)) for x in low])
        flat = lambda lists: np.array([x for one in lists for x in one], np.int64)

        def allowed(some: np.ndarray, rows: np.ndarray) -> np.ndarray:
            alike = own[some][:, None] == labels[rows]
            return alike & (names[some][:, None] != ids[rows]) if same else ~alike

        found, scores, _ = window_top(
            cells.grid(left.column("v")), owner, flat(low), flat(high), flat(floors), ids, cells.grid(right.column("v")), allowed, k
        )
        for i, (vecs, score) in enumerate(zip(found, scores)):
            full = score > cells.LEAST
            yield owner[i], window[i], vecs[full], score[full]

    return walk


def mine(
    vectors: DataFrame, asked: Column | str, label: Column | str = "label", positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each row for which ``asked`` holds and each of its ``positives``, the best
    ``negatives`` of other labels with low% <= negative / positive score <= high%."""
    label = F.col(label) if isinstance(label, str) else label
    columns = [label.cast("long").alias("label"), cells.asked(asked)]
    index = cells.Cells(cells.whole_vectors(vectors, scale, *columns).where("label IS NOT NULL"))
    anchors = index.rows.where("asked")
    open_window = {"low": F.array(F.lit(cells.LEAST)), "high": F.array(F.lit(cells.MOST))}
    near = index.search(anchors.withColumns(open_window), positives, _walk(positives, True))
    order = Window.partitionBy("tag").orderBy(F.desc("score"), "vec_id")  # at most ``positives`` rows
    near = near.select("tag", "vec_id", "score", (F.row_number().over(order) - 1).alias("w"))
    near = materialise(near, "positives")

    up, down = F.col("score") * high, -F.col("score") * low
    whole = lambda x: ((x - F.pmod(x, F.lit(100))) / 100).cast("long")
    windows = near.select("tag", F.struct("w", (-whole(down)).alias("low"), whole(up).alias("high")).alias("x"))
    windows = windows.groupBy("tag").agg(F.sort_array(F.collect_list("x")).alias("x"))  # at most ``positives``
    wanted = anchors.join(windows, "tag").withColumns({"low": F.col("x.low"), "high": F.col("x.high")}).drop("x")
    far = index.search(wanted, negatives, _walk(negatives, False))
    pairs = anchors.select("tag", F.col("id").alias("anchor_id")).join(
        near.select("tag", "w", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "tag"
    )
    return far.join(pairs, ["tag", "w"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
