"""Intermediate tables below the folder that all executors share."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.session import scratch_path

_PLACE = (1 << 33) - 1  # monotonically_increasing_id: partition above, place below


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends at files that survive a lost
    executor, and several readers do not run the plan again."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, order: list, rank: str) -> DataFrame:
    """``rows`` with their place from 1 in ``order``: no task or window holds them all."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialise(placed.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", 33)
    sizes = {r[0]: r[1] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = dict(zip(sorted(sizes), accumulate((sizes[p] for p in sorted(sizes)), initial=0)))
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "_part long, _before long")
    placed = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row per partition
    place = F.col("_before") + F.col("_place").bitwiseAND(F.lit(_PLACE)) + 1
    return placed.select(*rows.columns, place.alias(rank))
