"""Connected components of a pair list (M6).

Alternates the large-star and small-star steps of Kiveris et al. (2014), which
need O(log^2 n) rounds.  Each step is one aggregation with map-side combine
and one join to a row per node, whose hubs adaptive execution splits; every round
is checkpointed reliably.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.session import cut_lineage


def _star(neighbours: DataFrame) -> DataFrame:
    """Attach to each (u, v) the least node ``m`` among u and its neighbours."""
    least = neighbours.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return neighbours.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _star(both).where("v > u")
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _star(down)
    links = starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = starred.select("u", F.col("m").alias("v"))
    return links.unionByName(own).where("u <> v").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def cluster_pairs(pairs: DataFrame, src: str = "id_l", dst: str = "id_r") -> DataFrame:
    """(id, cluster): the least id reachable, for every id that is in a pair."""
    named = pairs.select(F.col(src).alias("u"), F.col(dst).alias("v"))
    # Cut here: the input may be a long plan, and loops and edges both read it.
    named = cut_lineage(named.where("u IS NOT NULL AND v IS NOT NULL"))
    loops = named.where("u = v").select("u").distinct()
    edges = cut_lineage(
        named.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _fingerprint(edges)
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("cluster"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("cluster")).distinct()
    known = members.unionByName(roots)
    alone = loops.join(known, loops["u"] == known["id"], "left_anti")
    return known.unionByName(alone.select(F.col("u").alias("id"), F.col("u").alias("cluster")))


def assign_clusters(records: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """All records with their cluster; a record in no pair is its own cluster."""
    found = cluster_pairs(pairs)
    return (
        records.join(found.withColumnRenamed("id", id_col), id_col, "left")
        .withColumn("cluster", F.coalesce("cluster", id_col))
    )
