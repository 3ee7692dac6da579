"""Exact searches over vectors, block by block: what both vector operators share.

The upper levels of one cover tree are grown over a bounded sample of the vectors
(``SAMPLE`` rows of least hash, at most ``CELLS`` leaves).  Every row goes to the cell of
its nearest leaf centre; the covering radius of a cell is exact, over all its rows.
Neighbouring cells, in the tree's depth-first order, make blocks of about ``DATA_ROWS``
rows or ``QUERY_ROWS`` queries, and a larger cell is dealt over several blocks by a hash.

A search runs in two steps.  First each query block meets the data block of its nearest
cell, which gives a k-th score for its queries.  Then a pair of blocks is shipped only
if the bound of a pair of its cells, |<q, d> - <cq, cd>| <= rq |cd| + rd |cq| + rq rd,
reaches the worst k-th score of the query block and meets its window.  What is left out
cannot hold a result.  The driver holds figures of cells: at most ``CELLS`` of a length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollgraph.llm.store import materialise

SAMPLE = 4096
CELLS = 512
DATA_ROWS = 8192
QUERY_ROWS = 1024
FANOUT = 8
LEAST, MOST = -(1 << 62), 1 << 62  # scores of an open window
_KEYS = ["dim", "qrun", "qsalt", "drun", "dsalt"]


class Node:
    """A cover-tree node: its rows lie within ``radius`` of ``centre``."""

    __slots__ = ("rows", "centre", "norm", "radius", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray):
        self.rows = rows
        self.centre = points[rows].mean(axis=0)
        self.norm = float(np.linalg.norm(self.centre))
        away = np.linalg.norm(points[rows] - self.centre, axis=1)
        self.radius = float(away.max()) * (1 + 1e-12)
        self.children: list[Node] = []


def grow(points: np.ndarray, leaf: int) -> Node:
    """A tree over all ``points``.  The children of a node are the balls around points
    picked farthest first, so that covering radii fall from level to level."""
    root = Node(points, np.arange(len(points)))
    open_nodes = [root]
    while open_nodes:
        node = open_nodes.pop()
        if len(node.rows) <= leaf or node.radius == 0:
            continue
        own = points[node.rows]
        away = np.linalg.norm(own - node.centre, axis=1)
        near, place = np.full(len(own), np.inf), np.zeros(len(own), np.int64)
        pick = int(away.argmax())
        for k in range(FANOUT):
            step = np.linalg.norm(own - own[pick], axis=1)
            closer = step < near
            near[closer], place[closer] = step[closer], k
            pick = int(near.argmax())
            if near[pick] == 0:
                break
        node.children = [Node(points, node.rows[place == k]) for k in range(place.max() + 1) if (place == k).any()]
        open_nodes += node.children
    return root


def leaves(node: Node) -> list[Node]:
    """Nodes without children, depth first."""
    out, stack = [], [node]
    while stack:
        node = stack.pop()
        stack += reversed(node.children)
        if not node.children:
            out.append(node)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    most = max(a.max(initial=0), -a.min(initial=0)) * max(b.max(initial=0), -b.min(initial=0))
    if most * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return whole(a) @ whole(b).T


def grid(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def asked(condition: Column | str) -> Column:
    """Whether a row is a query; a condition that is null does not hold."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(condition, F.lit(False)).alias("asked")


def whole_vectors(vectors: DataFrame, scale: int, *columns) -> DataFrame:
    """(id, v, dim, *columns): vectors as whole numbers ``floor(scale * x)``, without rows
    that have no id, no vector or a component that is null or not finite."""
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"), *columns
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("v", finite) & (F.size("v") > 0))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    return rows.withColumn("dim", F.size("v"))


class Cells:
    """All rows with their cells, and the plan of blocks over them.

    ``rows`` has id, v, dim, ``asked`` (whether the row is a query) and what else the
    search needs; ``tag`` names a row, also one that repeats.
    """

    def __init__(self, rows: DataFrame):
        picked = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
        found = [np.asarray(v, float) for v in picked.column(0).to_pylist()]
        self.centres: dict[int, np.ndarray] = {}
        for dim in sorted({len(v) for v in found}):
            points = np.array([v for v in found if len(v) == dim])
            tree = leaves(grow(points, max(1, -(-len(points) * 4 // CELLS))))
            self.centres[dim] = np.array([leaf.centre for leaf in tree[:CELLS]])
        centres, kept = self.centres, rows.columns

        def assign(batches):
            for batch in batches:
                dims = np.asarray(batch.column(kept.index("dim")))
                vectors = batch.column(kept.index("v"))
                cell, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    points = grid(vectors.take(pa.array(at)))
                    own = centres.get(int(dim), np.zeros((1, dim)))  # a length that the sample lacks
                    square = (own**2).sum(axis=1) - 2 * points @ own.T
                    cell[at] = square.argmin(axis=1)
                    away[at] = np.linalg.norm(points - own[cell[at]], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], names=[*kept, "cell", "away"])

        schema = T.StructType(list(rows.schema.fields)).add("cell", "integer").add("away", "double")
        placed = rows.mapInArrow(assign, schema).withColumn("tag", F.monotonically_increasing_id())
        self.rows = materialise(placed, "cells")
        asked = F.when(F.col("asked"), F.col("away"))
        figures = self.rows.groupBy("dim", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("away").alias("r"), F.count(asked).alias("qn"), F.max(asked).alias("qr")
        ).orderBy("dim", "cell").collect()
        self.figures = [f.asDict() for f in figures]
        self._deal("d", "n", DATA_ROWS)
        self._deal("q", "qn", QUERY_ROWS)
        plan = [(f["dim"], f["cell"], f["drun"], f["dsalts"], f["qrun"], f["qsalts"]) for f in self.figures]
        spark = rows.sparkSession
        self.plan = spark.createDataFrame(plan, "dim int, cell int, drun int, dsalts int, qrun int, qsalts int")
        self.bounds = self._bounds()

    def _deal(self, side: str, number: str, size: int) -> None:
        """Neighbouring cells share a run of ``size`` rows; a larger cell fills its own,
        in several salts."""
        dim, run, filled = None, 0, 0
        for f in self.figures:  # depth-first order within a length
            n = f[number]
            if f["dim"] != dim:
                dim, run, filled = f["dim"], 0, 0
            elif filled and filled + n > size:
                run, filled = run + 1, 0
            filled += n
            f[f"{side}run"], f[f"{side}salts"] = run, max(1, -(-n // size))

    def _bounds(self) -> dict[tuple[int, int, int], tuple[float, float, float]]:
        """(least, most, nearest) inner product of each pair of runs of a length."""
        out: dict = {}
        for dim in {f["dim"] for f in self.figures}:
            own = [f for f in self.figures if f["dim"] == dim]
            asked = [f for f in own if f["qn"]]
            if not asked:
                continue
            centres = self.centres.get(dim, np.zeros((1, dim)))
            q, d = centres[[f["cell"] for f in asked]], centres[[f["cell"] for f in own]]
            rq, rd = np.array([f["qr"] for f in asked]), np.array([f["r"] for f in own])
            middle = q @ d.T
            slack = np.outer(rq, np.linalg.norm(d, axis=1)) + np.outer(np.linalg.norm(q, axis=1), rd) + np.outer(rq, rd)
            slack += 1e-9 * (np.abs(middle) + slack) + 0.5
            qruns, druns = np.array([f["qrun"] for f in asked]), np.array([f["drun"] for f in own])
            for a in np.unique(qruns):
                rows = qruns == a
                for b in np.unique(druns):
                    at = np.ix_(rows, druns == b)
                    low, high = (middle - slack)[at].min(), (middle + slack)[at].max()
                    out[dim, int(a), int(b)] = (float(low), float(high), float(middle[at].max()))
        return out

    def _ship(self, queries: DataFrame, data: DataFrame, pairs: list[tuple], walk, schema: str) -> DataFrame:
        """``walk`` over each pair of blocks: (dim, qrun, drun, whether salt 0 only or not)."""
        spark = queries.sparkSession
        wanted = F.broadcast(spark.createDataFrame(pairs, "dim int, qrun int, drun int, first boolean"))  # runs squared at most
        salts = lambda side: F.broadcast(
            self.plan.groupBy("dim", f"{side}run").agg(F.max(f"{side}salts").alias(f"{side}n"))
        )
        every = lambda side: F.explode(F.sequence(F.lit(0), F.col(f"{side}n") - 1)).alias(f"{side}salt")
        own = lambda side: F.pmod(F.xxhash64("tag"), F.col(f"{side}salts")).cast("int").alias(f"{side}salt")
        places = F.broadcast(self.plan)

        def keyed(rows: DataFrame, side: str, other: str) -> DataFrame:
            at = rows.join(places, ["dim", "cell"]).select(*rows.columns, f"{side}run", own(side))
            at = at.join(wanted, ["dim", f"{side}run"]).join(salts(other), ["dim", f"{other}run"])
            at = at.select(*rows.columns, f"{side}run", f"{side}salt", f"{other}run", "first", every(other))
            return at.where(F.col("first").isNull() | (F.col("first") == (F.col("dsalt") == 0))).drop("first")

        left, right = keyed(queries, "q", "d"), keyed(data, "d", "q")
        left = left.select(*[F.col(c).alias(c) for c in left.columns])  # both come from one table
        return left.groupBy(*_KEYS).cogroup(right.groupBy(*_KEYS)).applyInArrow(walk, schema)

    def search(self, queries: DataFrame, k: int, walk: Callable) -> DataFrame:
        """(tag, w, vec_id, score): the ``k`` best of each window of each query.

        ``queries`` are asked rows with ``low`` and ``high``, the bounds of each window.
        ``walk(queries, data, floor)`` gets two Arrow tables and for each window a score
        that k rows elsewhere reach, and gives (query row, window, ids, scores) pieces.
        """
        schema = "tag long, w int, vec_id long, score long"

        def task(left: pa.Table, right: pa.Table) -> pa.Table:
            pieces = walk(left, right, left.column("floor").to_pylist()) if len(left) and len(right) else []
            tags = np.asarray(left.column("tag")) if len(left) else np.zeros(0, np.int64)
            parts = [[], [], [], []]
            for row, window, ids, scores in pieces:
                for part, x in zip(parts, (np.full(len(ids), tags[row]), np.full(len(ids), window), ids, scores)):
                    part.append(np.asarray(x, np.int64))
            joined = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
            return pa.table([pa.array(joined[0]), pa.array(joined[1], pa.int32()), pa.array(joined[2]), pa.array(joined[3])],
                            names=["tag", "w", "vec_id", "score"])

        def best(found: DataFrame) -> DataFrame:
            order = Window.partitionBy("tag", "w").orderBy(F.desc("score"), "vec_id")
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

        nearest: dict = {}
        for (dim, q, d), (_, _, middle) in self.bounds.items():
            if (dim, q) not in nearest or middle > nearest[dim, q][0]:
                nearest[dim, q] = (middle, d)
        seeds = [(dim, q, d, True) for (dim, q), (_, d) in nearest.items()]
        bare = queries.withColumn("floor", F.col("low"))
        first = materialise(best(self._ship(bare, self.rows, seeds, task, schema)), "cells-first")
        # The k-th score so far, by window; the worst of a run decides on its pairs.
        worst = first.where(F.col("rank") == k).select("tag", F.struct("w", "score").alias("x"))
        worst = worst.groupBy("tag").agg(F.map_from_entries(F.collect_list("x")).alias("kth"))  # a window each
        floors = queries.join(worst, "tag", "left").withColumn(
            "floor", F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("kth", i), x)))
        )
        floors = materialise(floors.drop("kth"), "cells-floors")
        reach = floors.join(F.broadcast(self.plan), ["dim", "cell"]).groupBy("dim", "qrun").agg(
            F.min(F.array_min("floor")).alias("low"), F.max(F.array_max("high")).alias("high")
        )
        pairs = []
        for r in reach.collect():  # a row for each run
            for (dim, q, d), (low, high, _) in self.bounds.items():
                if (dim, q) == (r["dim"], r["qrun"]) and high >= r["low"] and low <= r["high"]:
                    pairs.append((dim, q, d, False if (dim, q, d, True) in seeds else None))
        self.shipped = (len(seeds), len(pairs), len(self.bounds))
        # Nothing is left of a seed pair whose data have one salt.
        several = {(f["dim"], f["drun"]) for f in self.figures if f["dsalts"] > 1}
        pairs = [p for p in pairs if p[3] is None or (p[0], p[2]) in several]
        if not pairs:
            return first
        more = self._ship(floors, self.rows, pairs, task, schema)
        return best(first.drop("rank").unionByName(more))
