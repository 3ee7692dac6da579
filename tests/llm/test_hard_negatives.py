"""Hard negatives against all inner products, and the products that are left out."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rollgraph.llm import cells, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, w string, tag string"
ASKED = "vec_id % 20 = 0"


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def expected(rows, positives=5, negatives=5):
    whole = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and usable(v)]
    out = []
    for a, v, y in whole:
        if a % 20:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, x)), i, z == y) for i, x, z in whole if len(x) == len(v) and (i != a or z != y))
        near = [(i, -s) for s, i, same in scored if same][:positives]
        for i, s in near:
            window = [(j, -t) for t, j, same in scored if not same and 80 * s <= -100 * t <= 100 * s][:negatives]
            out += [(a, i, rank, j, s, t) for rank, (j, t) in enumerate(window, 1)]
    return sorted(out)


def points(n, seed=3, groups=6, width=8, spread=0.3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, width))
    return np.round(centres[random.integers(0, groups, n)] + spread * random.normal(size=(n, width)), 3), random


def mined(frame, rows, **given):
    got = hard_negatives.mine(frame([(*r, "x", "y") for r in rows], SCHEMA), ASKED, **given)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("blocks", [False, True])
def test_equals_brute_force(frame, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(cells, "DATA_ROWS", 50)
        monkeypatch.setattr(cells, "QUERY_ROWS", 4)
        monkeypatch.setattr(cells, "CELLS", 16)
        monkeypatch.setattr(hard_negatives, "LEAF", 8)
    grid, random = points(500)
    grid[60:110] = grid[60]  # ties over several labels
    labels = random.integers(0, 4, len(grid)).tolist()
    rows = [(i, [float(x) for x in v], y) for i, (v, y) in enumerate(zip(grid, labels))]
    rows[7] = (7, rows[7][1], None)
    rows[40] = (40, rows[40][1], 99)  # an anchor without positives
    rows += [(600, None, 1), (601, [], 1), (602, [None] + [0.5] * 7, 1), (620, [float("nan")] * 8, 1), (640, [float("inf")] * 8, 2)]
    rows += [(None, [0.5] * 8, 1), (9, rows[9][1], rows[9][2]), (660, [1.0, 2.0], 0), (661, [1.0, 1.0], 0), (662, [1.0, 1.8], 1)]
    got = mined(frame, rows)
    assert got == expected(rows) and len(got) > 100


def test_few_and_no_rows(frame):
    assert mined(frame, []) == []
    assert mined(frame, [(0, [1.0, 0.0], 1)]) == []
    # A positive of a negative score has an empty window; one of zero allows zero only.
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.9, 0.0], 2), (20, [0.0, 1.0], 3), (21, [1.0, 0.0], 3), (22, [2.0, 0.0], 4)]
    assert mined(frame, rows) == expected(rows)
    assert (20, 21, 1, 0, 0, 0) in expected(rows)


def test_other_shares_and_counts(frame):
    grid, random = points(200, seed=8)
    rows = [(i, [float(x) for x in v], int(y)) for i, (v, y) in enumerate(zip(grid, random.integers(0, 3, 200)))]
    assert mined(frame, rows, positives=2, negatives=3) == expected(rows, 2, 3)


def test_nodes_outside_all_windows_are_skipped():
    grid, _ = points(6000, groups=60, width=16, spread=0.05)
    whole = np.floor(256 * grid)
    scores = cells.products(whole[:50], whole)
    high = np.sort(scores, axis=1)[:, -20]
    low = -(-high * 80 // 100)
    every = lambda a, rows: np.ones((len(a), len(rows)), bool)
    found, best, computed = hard_negatives.window_top(
        whole[:50], np.arange(50), low, high, low, np.arange(6000), whole, every, 5
    )
    assert computed < 0.3 * scores.size
    inside = np.where((scores >= low[:, None]) & (scores <= high[:, None]), scores, cells.LEAST)
    order = np.lexsort((np.broadcast_to(np.arange(6000), scores.shape), -inside), axis=-1)[:, :5]
    assert np.array_equal(best, np.take_along_axis(inside, order, axis=1)) and np.array_equal(found[best > cells.LEAST], order[best > cells.LEAST])
