"""Joins that stay balanced when one key holds a large share of the rows.

``heavy_keys`` names the keys worth splitting and ``salted_join`` spreads each of
them over several tasks.  All keys with more than ``ROWS_PER_SALT`` rows are split,
however many there are.  Their list is broadcast: it has at most one entry for every
million rows, some megabytes at 10^11 rows.
Which keys are salted changes only the placement of rows, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SALTS = 1000
ROWS_PER_SALT = 1_000_000
PAIRS_PER_TASK = 8_000_000  # of pairs that are written out one by one
RUN_L, RUN_R = 32, 256  # rows of either side that meet before the next ones do


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Keys with more than ``rows_per_salt`` rows and the salts each one gets."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return heavy_from_counts(counts, keys, "_n", rows_per_salt)


def heavy_from_counts(
    counts: DataFrame, keys: Sequence[str], n: str, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """``heavy_keys`` for a table that already carries one count per key."""
    salts = F.ceil(F.col(n) / rows_per_salt).cast("int").alias("_salts")
    return counts.where(F.col(n) > rows_per_salt).select(*keys, salts)


def _same(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def _with_salts(df: DataFrame, keys: Sequence[str], heavy: DataFrame, null_safe: bool) -> DataFrame:
    marked = heavy.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_salts")
    on = [_same(df[k], marked[f"_h_{k}"], null_safe) for k in keys]
    return df.join(F.broadcast(marked), on, "left").drop(*[f"_h_{k}" for k in keys])


def salted_join(
    big: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    heavy: DataFrame | None,
    spread: Sequence[str] = (),
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join ``big`` to ``dim`` on equally named ``keys``, splitting heavy keys.

    ``spread`` are columns of ``big`` that differ between the rows of one key;
    their hash picks the salt, so a retried task places its rows as before.
    ``how`` is ``inner`` or ``left``.  The result has the columns of ``big``
    followed by the non-key columns of ``dim``.  Without ``heavy`` the join is
    a plain one, and splitting skewed partitions is left to adaptive execution:
    for inputs that are themselves long plans, where counting keys beforehand
    would run the plan twice.
    """
    if heavy is None:
        other = dim.select(
            *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in dim.columns if c not in keys]
        )
        on = [_same(big[k], other[f"_r_{k}"], null_safe) for k in keys]
        return big.join(other, on, how).drop(*[f"_r_{k}" for k in keys])
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    if how == "left" and not null_safe:
        # Rows without a key meet nothing; deal them out instead of piling them up.
        salts = F.when(reduce(or_, [F.col(k).isNull() for k in keys]), NULL_SALTS).otherwise(salts)
    left = _with_salts(big, keys, heavy, null_safe).withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")
    )
    right = (
        _with_salts(dim, keys, heavy, null_safe)
        .withColumn(
            "_salt_r", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
        )
        .drop("_salts")
    )
    right = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        "_salt_r",
        *[c for c in dim.columns if c not in keys],
    )
    on = [_same(left[k], right[f"_r_{k}"], null_safe) for k in keys]
    joined = left.join(right, on + [left["_salt"] == right["_salt_r"]], how)
    return joined.select(*big.columns, *[c for c in dim.columns if c not in keys])


ROW_TAG = "_row"


def row_tag(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` (default all) with ``_row``, a number to spread rows by.

    A tag that came with the table (``read_table(..., tagged=True)``) is kept.
    Else it is the hash of the row: the same whenever a lost task is run again,
    whatever order its input arrives in.  Only full copies of one row share a
    hash, and adaptive execution splits a partition that piles them up.
    """
    kept = [c for c in (columns or df.columns) if c != ROW_TAG]
    tag = F.col(ROW_TAG) if ROW_TAG in df.columns else F.xxhash64(*kept)
    return df.select(*kept, tag.alias(ROW_TAG))


def pairs_within(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    payload: Sequence[str],
    rows_per_cell: int = 5_000,
) -> DataFrame:
    """Unordered pairs of rows sharing ``keys``, in bounded units of work.

    A group of ``n`` rows is cut into ``c = ceil(n / rows_per_cell)`` chunks by
    the hash of the id.  Rows of chunk i meet rows of chunk j >= i in cell
    (i, j) only, so every pair is met once and no task sees a whole group.
    Meant for candidate keys that an exact filter has already made selective.
    Columns: ``keys``, then ``<c>_l`` and ``<c>_r`` for the id and the payload.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    heavy = heavy_from_counts(sizes, keys, "_n")
    cols = [id_col, *payload]
    chunked = (
        salted_join(df.select(*keys, *cols), sizes, keys, heavy, [id_col])
        .withColumn("_c", F.ceil(F.col("_n") / rows_per_cell).cast("int"))
        .withColumn("_h", F.pmod(F.xxhash64(id_col), F.col("_c")).cast("int"))
    )
    left = chunked.withColumn("_j", F.explode(F.sequence("_h", F.col("_c") - 1))).select(
        *keys, F.col("_h").alias("_i"), "_j", *[F.col(c).alias(f"{c}_l") for c in cols]
    )
    right = chunked.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_h")))).select(
        *keys, "_i", F.col("_h").alias("_j"), *[F.col(c).alias(f"{c}_r") for c in cols]
    )
    met = left.join(right, [*keys, "_i", "_j"]).where(
        (F.col("_i") < F.col("_j")) | (F.col(f"{id_col}_l") < F.col(f"{id_col}_r"))
    )
    return met.drop("_i", "_j")


def pairs_in_runs(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    payload: Sequence[str],
    shared: Sequence[str],
    expected: int,
    rows_per_cell: int = 5_000,
) -> DataFrame:
    """``pairs_within`` for pairs that are all written out: smaller id first, in runs.

    The rows of a chunk travel as arrays in the order of their ids, and short pieces
    of two chunks meet: one id beside the same run of others, again and again.  A
    columnar file keeps such runs in a fraction of a byte per pair, and a task of
    ``PAIRS_PER_TASK`` has few enough ids for its dictionary.  An array has the rows
    of a chunk at most.  ``expected`` pairs tell the number of tasks; the result does
    not depend on it.  ``shared`` are columns with one value per key.
    Columns: ``keys``, ``shared``, then ``<c>_l`` and ``<c>_r`` for the id and the
    payload, ``<id>_l`` < ``<id>_r``; rows without an id are in no pair.
    """
    cols = [id_col, *payload]
    rows = df.where(F.col(id_col).isNotNull())
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    heavy = heavy_from_counts(sizes, keys, "_n")

    def by_id(a: Column, b: Column) -> Column:
        return F.when(a[id_col] < b[id_col], -1).when(a[id_col] > b[id_col], 1).otherwise(0)

    chunks = (
        salted_join(rows.select(*keys, *shared, *cols), sizes, keys, heavy, [id_col])
        .withColumn("_c", F.ceil(F.col("_n") / rows_per_cell).cast("int"))
        .withColumn("_h", F.pmod(F.xxhash64(id_col), F.col("_c")).cast("int"))
        .groupBy(*keys, "_c", "_h")
        .agg(*[F.first(c).alias(c) for c in shared], F.collect_list(F.struct(*cols)).alias("_rows"))
        .withColumn("_rows", F.array_sort("_rows", by_id))
    )

    def pieces(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("_rows"), F.lit(n))
        return F.explode(F.transform(starts, lambda at: F.slice("_rows", at, n)))

    left = chunks.select(*keys, *shared, "_c", F.col("_h").alias("_i"), pieces(RUN_L).alias("_a"))
    left = left.withColumn("_j", F.explode(F.sequence("_i", F.col("_c") - 1))).drop("_c")
    right = chunks.select(*keys, F.col("_h").alias("_j"), pieces(RUN_R).alias("_b"))
    right = right.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_j"))))
    cell = [*keys, "_i", "_j"]
    if expected > PAIRS_PER_TASK:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(parts, -(-expected // PAIRS_PER_TASK))
        left, right = left.repartition(parts, *cell), right.repartition(parts, *cell)
    # Merged, never broadcast: the pairs of one left piece are all that is held at a time.
    apart = F.col("_i") < F.col("_j")
    met = left.hint("merge").join(right, cell)
    met = met.where(apart | (F.get("_a", F.lit(0))[id_col] < F.element_at("_b", -1)[id_col]))
    met = met.withColumn("_x", F.explode("_a")).withColumn("_y", F.explode("_b"))
    ordered = F.col(f"_x.{id_col}") < F.col(f"_y.{id_col}")
    met = met.where(apart | ordered).select(
        *keys,
        *shared,
        F.when(ordered, F.col("_x")).otherwise(F.col("_y")).alias("_x"),
        F.when(ordered, F.col("_y")).otherwise(F.col("_x")).alias("_y"),
    )
    return met.select(
        *keys, *shared, *[F.col(f"{at}.{c}").alias(f"{c}_{s}") for at, s in (("_x", "l"), ("_y", "r")) for c in cols]
    )


def pairs_between(
    df: DataFrame,
    keys: Sequence[str],
    side: str,
    id_col: str,
    payload: Sequence[str],
    rows_per_cell: int = 5_000,
) -> DataFrame:
    """Pairs of a row with a true ``side`` and one with a false ``side`` sharing ``keys``.

    Cells as in ``pairs_within``, with chunks of either side.
    Columns: ``keys``, then ``<c>_l`` (true) and ``<c>_r`` for the id and the payload.
    """
    sizes = (
        df.groupBy(*keys)
        .agg(F.count_if(F.col(side)).alias("_n_l"), F.count_if(~F.col(side)).alias("_n_r"))
        .where("_n_l > 0 and _n_r > 0")
        .withColumn("_n", F.col("_n_l") + F.col("_n_r"))
    )
    heavy = heavy_from_counts(sizes, keys, "_n")
    cols = [id_col, *payload]

    def chunks(n: str) -> Column:
        return F.ceil(F.col(n) / rows_per_cell).cast("int")

    chunked = salted_join(df.select(*keys, side, *cols), sizes, keys, heavy, [id_col])

    def half(is_left: bool) -> DataFrame:
        own, other, mine, met, end = ("_n_l", "_n_r", "_i", "_j", "l") if is_left else ("_n_r", "_n_l", "_j", "_i", "r")
        rows = chunked.where(F.col(side) if is_left else ~F.col(side))
        return rows.withColumn(mine, F.pmod(F.xxhash64(id_col), chunks(own)).cast("int")).select(
            *keys, mine, F.explode(F.sequence(F.lit(0), chunks(other) - 1)).alias(met),
            *[F.col(c).alias(f"{c}_{end}") for c in cols],
        )

    return half(True).join(half(False), [*keys, "_i", "_j"]).drop("_i", "_j")
