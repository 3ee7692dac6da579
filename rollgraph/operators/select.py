"""Projection, filters and small views."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.session import cut_lineage

TOP = 10_000  # rows that one task may sort out
RANGE_BITS = 33  # monotonically_increasing_id: the partition lies above these bits


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns by name, never by position."""
    return df.select(*columns)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def non_empty(column: Column) -> Column:
    """True for text that is present and not ``''``; null stays unknown."""
    return column != F.lit("")


def match_props(nodes: DataFrame, **equal) -> DataFrame:
    """Nodes whose properties equal all given values."""
    tests = [F.col(name) == F.lit(value) for name, value in equal.items()]
    return nodes.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """A test load of the first ``n`` rows in a stated order.

    A long sample is cut in place: rows are sorted in ranges of the order, the ranges
    are counted, and the place of the last row wanted becomes a filter.  No task holds
    more than its range.
    """
    if n <= TOP:
        return df.orderBy(*order).limit(n)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = cut_lineage(ranges.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", RANGE_BITS).alias("part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row a range
    end, left = 0, n
    for row in counts:
        if left <= 0:
            break
        end = (row["part"] << RANGE_BITS) + min(left, row["n"])
        left -= row["n"]
    return placed.where(F.col("_place") < end).drop("_place")


def top_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of a view."""
    return df.orderBy(*order).limit(n)


def gate_on_total(df: DataFrame, above: int = 1) -> DataFrame:
    """All rows if there are more than ``above`` of them in total, else none.

    Counting stops at ``above + 1`` rows, so the gate costs a glance at the
    table and not a pass over it.
    """
    seen = df.select(F.lit(1).alias("one")).limit(above + 1).agg(F.count("one")).scalar()
    return df.where(seen > above)
