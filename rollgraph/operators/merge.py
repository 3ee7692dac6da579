"""Merging duplicate nodes and parallel edges (A4, M1-M4)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.operators.select import gate_on_total
from rollgraph.operators.skew import ROW_TAG, heavy_from_counts, heavy_keys, row_tag, salted_join


class Graph(NamedTuple):
    nodes: DataFrame
    edges: DataFrame


def duplicate_groups(
    nodes: DataFrame,
    key: str,
    where: Column | None = None,
    min_size: int = 2,
    merge_nulls: bool = False,
) -> DataFrame:
    """Members of every group with at least ``min_size`` nodes.

    One row per member (``key``, ``id``, ``survivor``, ``size``) instead of one
    array per group: a group may hold a large share of all nodes.
    """
    picked = nodes if where is None else nodes.where(where)
    picked = picked.select(key, "id")
    if not merge_nulls:
        picked = picked.where(F.col(key).isNotNull())
    groups = (
        picked.groupBy(key)
        .agg(F.min("id").alias("survivor"), F.count(F.lit(1)).alias("size"))
        .where(F.col("size") >= min_size)
    )
    heavy = heavy_from_counts(groups, [key], "size")
    return salted_join(picked, groups, [key], heavy, ["id"], null_safe=merge_nulls)


def repoint_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace both ends by their survivor; ``mapping`` is (id, survivor)."""
    tagged = row_tag(edges)
    src = mapping.select(F.col("id").alias("src"), F.col("survivor").alias("_src"))
    dst = mapping.select(F.col("id").alias("dst"), F.col("survivor").alias("_dst"))
    first = salted_join(tagged, src, ["src"], heavy_keys(edges, ["src"]), [ROW_TAG], "left")
    both = salted_join(first, dst, ["dst"], heavy_keys(edges, ["dst"]), [ROW_TAG], "left")
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return both.select(
        F.coalesce("_src", "src").alias("src"), F.coalesce("_dst", "dst").alias("dst"), *rest
    )


def merge_nodes(
    nodes: DataFrame,
    edges: DataFrame,
    key: str,
    where: Column | None = None,
    min_size: int = 2,
    props: str = "first",
    merge_nulls: bool = False,
    drop_loops: bool = False,
) -> Graph:
    """Merge nodes with equal ``key`` into the one with the smallest id.

    ``props``: ``first`` keeps the survivor's properties, ``last`` takes those
    of the node with the greatest id; for all values see ``combined_values``.
    Loops stay unless ``drop_loops``.
    """
    if props not in ("first", "last"):
        raise ValueError("props is 'first' or 'last'; see combined_values for all values")
    members = duplicate_groups(nodes, key, where, min_size, merge_nulls)
    mapping = members.select("id", "survivor")
    lost = mapping.where("id <> survivor").select("id")
    kept = nodes.join(lost, "id", "left_anti")
    if props == "last":
        last = members.groupBy("survivor").agg(F.max("id").alias("_last"))
        others = [c for c in nodes.columns if c != "id"]
        donors = nodes.select(F.col("id").alias("_last"), F.struct(*others).alias("_props"))
        given = last.join(donors, "_last").select(F.col("survivor").alias("id"), "_props")
        kept = kept.join(given, "id", "left").select(
            "id",
            *[
                F.when(F.col("_props").isNotNull(), F.col(f"_props.{c}")).otherwise(F.col(c)).alias(c)
                for c in others
            ],
        )
    moved = repoint_edges(edges, mapping)
    if drop_loops:
        moved = moved.where("src <> dst")
    return Graph(kept.select(*nodes.columns), moved)


def combined_values(
    nodes: DataFrame, members: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Every distinct property value of every merged group, one row each.

    The long form of combining properties: (survivor, property, value, n).
    """
    narrow = nodes.select(
        "id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("property"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("p"),
    ).where(F.col("p.value").isNotNull())
    return (
        members.select("id", "survivor")
        .join(narrow, "id")
        .groupBy("survivor", F.col("p.property").alias("property"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_all(nodes: DataFrame, edges: DataFrame, where: Column | None = None) -> Graph:
    """Merge all nodes (that pass ``where``) into the one with the smallest id."""
    picked = nodes if where is None else nodes.where(where)
    ids = picked.select("id")
    survivor = ids.agg(F.min("id")).scalar()
    mapping = ids.withColumn("survivor", survivor)
    lost = mapping.where("id <> survivor").select("id")
    return Graph(nodes.join(lost, "id", "left_anti"), repoint_edges(edges, mapping))


def merge_by_address(nodes: DataFrame, edges: DataFrame) -> Graph:
    """Merge address nodes that share a canonical address."""
    return merge_nodes(nodes, edges, "pa")


def merge_parallel_edges(edges: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """One edge per (src, dst), whatever the kinds; nothing if there is but one edge.

    ``types`` limits the merge to some kinds.  The smallest kind names the
    merged edge, ``n`` counts the edges and ``types`` lists their kinds (the
    graph has four).
    """
    picked = edges if types is None else edges.where(F.col("type").isin(*types))
    return (
        gate_on_total(picked.select("src", "dst", "type"), 1)
        .groupBy("src", "dst", "type")
        .agg(F.count(F.lit(1)).alias("m"))
        .groupBy("src", "dst")
        .agg(
            F.min("type").alias("type"),
            F.sum("m").alias("n"),
            F.concat_ws(",", F.array_sort(F.collect_set("type"))).alias("types"),
        )
    )
