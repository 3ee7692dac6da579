"""Name index and business nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.functions.columns import as_text, stable_id


def name_index(master: DataFrame, order: str = "filing_num") -> DataFrame:
    """One filing per distinct name, null included; the highest ``order`` wins."""
    last = F.max_by("filing_num", F.struct(order, "filing_num"))
    if order == "filing_num":
        last = F.max("filing_num")
    return master.groupBy("name").agg(last.alias("filing_num"))


def business_nodes(index: DataFrame) -> DataFrame:
    """One node per index entry: filings that lost the name race have none."""
    return index.select(stable_id("Business", F.col("name")).alias("id"), "filing_num", "name")


def name_to_nodes(index: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node ids a name leads to: through the filing, so maybe several."""
    return index.select("name", "filing_num").join(
        nodes.select("filing_num", F.col("id").alias("node")), "filing_num"
    ).select("name", "node")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def find_business(nodes: DataFrame, name: str) -> DataFrame:
    """The name once per node that carries it."""
    return nodes.where(F.col("name") == F.lit(name)).select("name")


def update_property(
    nodes: DataFrame, values: DataFrame, key: str, column: str, order: str
) -> DataFrame:
    """Set ``column`` (as text) on every node with the key; the last value wins.

    Keys without a node are ignored, nodes without a value keep what they had.
    """
    last = values.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(as_text(F.col(column)).alias("v")), order).alias("_new")
    )
    old = F.col(column) if column in nodes.columns else F.lit(None).cast("string")
    kept = [c for c in nodes.columns if c != column]
    return nodes.join(last, key, "left").select(
        *kept, F.when(F.col("_new").isNotNull(), F.col("_new.v")).otherwise(old).alias(column)
    )
