"""Merging nodes and edges, components."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rollgraph.operators import merge as mrg
from rollgraph.operators.components import assign_clusters, cluster_pairs

NODES = [("n1", "A", "x"), ("n2", "A", "y"), ("n3", "B", "z"), ("n4", None, "u"), ("n5", None, "v")]
EDGES = [("n1", "n2", "t"), ("n2", "n3", "t"), ("n4", "n5", "t"), ("n2", "n3", "s")]


@pytest.fixture
def nodes(frame):
    return frame(NODES, "id string, name string, p string")


@pytest.fixture
def edges(frame):
    return frame(EDGES, "src string, dst string, type string")


def test_merge_by_name(nodes, edges):
    got = mrg.merge_nodes(nodes, edges, "name")
    assert rows(got.nodes, "id", "p") == [("n1", "x"), ("n3", "z"), ("n4", "u"), ("n5", "v")]
    assert rows(got.edges) == [
        ("n1", "n1", "t"), ("n1", "n3", "s"), ("n1", "n3", "t"), ("n4", "n5", "t"),
    ]
    again = mrg.merge_nodes(got.nodes, got.edges, "name")
    assert rows(again.nodes) == rows(got.nodes) and rows(again.edges) == rows(got.edges)


def test_merge_nulls_last_and_loops(nodes, edges):
    got = mrg.merge_nodes(nodes, edges, "name", props="last", merge_nulls=True, drop_loops=True)
    assert rows(got.nodes, "id", "p") == [("n1", "y"), ("n3", "z"), ("n4", "v")]
    assert rows(got.edges) == [("n1", "n3", "s"), ("n1", "n3", "t")]


def test_every_value_of_a_merged_group(nodes):
    values = mrg.combined_values(nodes, mrg.duplicate_groups(nodes, "name"), ["p"])
    assert rows(values) == [("n1", "p", "x", 1), ("n1", "p", "y", 1)]


def test_merge_all_and_some(nodes, edges):
    got = mrg.merge_all(nodes, edges)
    assert rows(got.nodes, "id") == [("n1",)]
    assert set(rows(got.edges, "src", "dst")) == {("n1", "n1")} and got.edges.count() == 4
    some = mrg.merge_all(nodes, edges, F.col("name") == "A")
    assert rows(some.nodes, "id") == [("n1",), ("n3",), ("n4",), ("n5",)]


def test_parallel_edges(frame, edges):
    got = mrg.merge_parallel_edges(edges)
    assert rows(got, "src", "dst", "type", "n", "types") == [
        ("n1", "n2", "t", 1, "t"), ("n2", "n3", "s", 2, "s,t"), ("n4", "n5", "t", 1, "t"),
    ]
    assert mrg.merge_parallel_edges(edges, ["s"]).count() == 0  # one edge: the gate stays shut
    assert mrg.merge_parallel_edges(edges, ["t"]).count() == 3


def closure(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return sorted((x, find(x)) for x in root)


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_the_closure(frame, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)]  # a long chain
    pairs += [(2000, 2001 + i) for i in range(60)]  # a hub
    got = cluster_pairs(frame(pairs, "id_l int, id_r int"))
    assert rows(got) == sorted(closure(pairs), key=repr)


def test_components_with_hubs(frame):
    pairs = [(2000, i) for i in range(80)] + [(5000 + i, 5001 + i) for i in range(10)]
    got = cluster_pairs(frame(pairs, "id_l int, id_r int"))
    assert rows(got) == sorted(closure(pairs), key=repr)


def test_records_without_a_pair_stand_alone(frame):
    records = frame([(i,) for i in range(5)], "id int")
    pairs = frame([(3, 1), (2, 2)], "id_l int, id_r int")
    got = assign_clusters(records, pairs, "id")
    assert rows(got, "id", "cluster") == [(0, 0), (1, 1), (2, 2), (3, 1), (4, 4)]


def test_no_pairs_at_all(frame):
    assert cluster_pairs(frame([], "id_l int, id_r int")).count() == 0
