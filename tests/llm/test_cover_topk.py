"""Dual-tree search against all inner products, and what it leaves out."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rollgraph.llm import cells, cover_topk

SCHEMA = "vec_id long, embedding array<double>, score string, tag string, cell string"
ASKED = "vec_id % 100 = 0"


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def expected(rows, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if i is not None and usable(v)]
    out = []
    for q, a in whole:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in whole if i != q and len(v) == len(a))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def clustered(n, seed=5, groups=6, width=8, spread=0.1):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, width))
    return np.round(centres[random.integers(0, groups, n)] + spread * random.normal(size=(n, width)), 3)


def small_blocks(monkeypatch, data=60, queries=3, leaves=24):
    monkeypatch.setattr(cells, "DATA_ROWS", data)
    monkeypatch.setattr(cells, "QUERY_ROWS", queries)
    monkeypatch.setattr(cells, "CELLS", leaves)


@pytest.mark.parametrize("k,blocks", [(10, False), (3, True)])
def test_equals_brute_force(frame, monkeypatch, k, blocks):
    if blocks:
        small_blocks(monkeypatch)
    grid = clustered(700)
    grid[50:120] = grid[50]  # ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(grid)]
    rows += [(1000, None), (1001, []), (1100, [None] + [0.5] * 7), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8)]
    rows += [(None, [0.5] * 8), (7, [9.0] * 8), (7, [9.0] * 8), (300, [3.0] * 8)]  # ids that repeat
    rows += [(1400, [1.0, 2.0]), (1401, [2.0, 1.0]), (1402, [0.0, 5.0])]  # vectors of another length
    vectors = frame([(*r, "", "", "") for r in rows], SCHEMA)
    got = cover_topk.search(vectors, ASKED, k)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, k)


def test_few_and_no_rows(frame):
    two = frame([(0, [1.0, 2.0], "", "", ""), (1, [1.0, -2.0], "", "", "")], SCHEMA)
    got = cover_topk.search(two, ASKED)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 1024 * 1024 * -3)]
    assert cover_topk.search(frame([], SCHEMA), ASKED).count() == 0
    assert cover_topk.search(two, "vec_id = 5").count() == 0


def test_node_pairs_are_left_out():
    points = np.floor(1024 * clustered(4000, groups=40, width=16, spread=0.05))
    found, scores, computed = cover_topk.top_k(np.arange(2000), points[:2000], np.arange(4000), points, 10)
    assert computed < 0.3 * 2000 * 4000
    plain = cells.products(points[:2000], points)
    plain[np.arange(2000), np.arange(2000)] = cells.LEAST
    order = np.lexsort((np.broadcast_to(np.arange(4000), plain.shape), -plain), axis=-1)[:, :10]
    assert np.array_equal(found, order) and np.array_equal(scores, np.take_along_axis(plain, order, axis=1))


def test_block_pairs_are_left_out(frame, monkeypatch):
    """Twice the rows ship less than four times the pairs of blocks."""
    small_blocks(monkeypatch, 100, 2, 64)
    shipped = []
    walks = cells.Cells.search

    def watched(self, *given):
        found = walks(self, *given)
        shipped.append(self.shipped)
        return found

    monkeypatch.setattr(cells.Cells, "search", watched)
    for n in (2000, 4000):
        grid = clustered(n, groups=n // 100, width=16, spread=0.02)
        rows = [(i, [float(x) for x in v], "", "", "") for i, v in enumerate(grid)]
        got = cover_topk.search(frame(rows, SCHEMA), ASKED, 5)
        assert sorted(tuple(r) for r in got.collect()) == expected(rows, 5)
    (_, small, all_small), (_, large, all_large) = shipped
    assert small < 0.6 * all_small and large < 0.6 * all_large
    assert large < 3 * small
