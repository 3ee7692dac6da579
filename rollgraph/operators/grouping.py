"""Groups of near-identical strings (G1).

Strings are compared by the cosine of their character 3-gram TF-IDF vectors
and grouped by the closure of all pairs at or above the threshold.

Equal strings are one vector.  Unequal ones are found by prefix filtering: put
the grams of a unit vector in one global order, rarest first; the grams after
which less than ``threshold`` of its length is left cannot reach the threshold
alone, so two similar strings share a gram before that point.  This is exact,
and common grams hardly ever come that early, so none has to be cut.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rollgraph.operators.components import cluster_pairs
from rollgraph.operators.skew import heavy_from_counts, heavy_keys, pairs_within, salted_join
from rollgraph.session import cut_lineage

GRAM = 3
STRIPPED = r"[,\-./]|\s"
ROUNDING = 1e-9


def _grams(text: Column) -> Column:
    """3-grams as integers: three code points of 21 bits each."""

    def packed(points: Column) -> Column:
        def gram(at: Column) -> Column:
            first, second, third = (F.get(points, at + i) for i in range(GRAM))
            return F.shiftleft(first, 42) + F.shiftleft(second, 21) + third

        starts = F.sequence(F.lit(0), F.size(points) - GRAM)
        return F.when(F.size(points) >= GRAM, F.transform(starts, gram))

    points = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("bigint"))
    return F.get(F.transform(F.array(points), packed), F.lit(0))


def _vectors(strings: DataFrame) -> DataFrame:
    """(s, grams, weights): unit TF-IDF vectors, rarest gram first.

    ``strings`` is (s, copies); the document frequency counts every copy.
    """
    stripped = F.regexp_replace(F.upper(F.col("s")), STRIPPED, "")
    total = strings.agg(F.sum("copies")).scalar()
    counted = (
        strings.select("s", "copies", F.explode(_grams(stripped)).alias("gram"))
        .groupBy("s", "gram")
        .agg(F.count(F.lit(1)).alias("tf"), F.first("copies").alias("copies"))
    )
    df = counted.groupBy("gram").agg(
        F.sum("copies").alias("df"), F.count(F.lit(1)).alias("_n")
    )
    heavy = heavy_from_counts(df, ["gram"], "_n")
    weighed = salted_join(counted, df.select("gram", "df"), ["gram"], heavy, ["s"]).select(
        "s",
        "gram",
        "df",
        (F.col("tf") * (F.log((total + 1) / (F.col("df") + 1)) + 1)).alias("w"),
    )
    # One list per string, as long as the string itself.
    listed = weighed.groupBy("s").agg(
        F.sort_array(F.collect_list(F.struct("df", "gram", "w"))).alias("v")
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    return listed.withColumn("norm", norm).select(
        "s",
        F.col("v.gram").alias("grams"),
        F.transform("v", lambda x: x["w"] / F.col("norm")).alias("weights"),
    )


def _prefix_length(weights: Column, threshold: float) -> Column:
    """How many leading grams until less than ``threshold`` of the length is left."""
    start = F.struct(F.lit(0.0).alias("seen"), F.lit(0).alias("n"))
    spent = 1.0 - threshold * threshold + ROUNDING
    return F.aggregate(
        weights,
        start,
        lambda acc, w: F.struct(
            (acc["seen"] + w * w).alias("seen"),
            (acc["n"] + (acc["seen"] <= spent).cast("int")).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def _entries(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of a list column, without touching single rows."""
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return rows, lists.flatten().to_numpy(zero_copy_only=False)


def _lengths_left(weights: Column, n: Column) -> Column:
    """For each of the first ``n`` grams, the length of the vector from there on."""

    def left(at: Column) -> Column:
        before = F.aggregate(
            F.slice(weights, F.lit(1), at), F.lit(0.0), lambda acc, w: acc + w * w
        )
        return F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - before))

    return F.transform(F.sequence(F.lit(0), n - 1), left)


@F.arrow_udf(DoubleType())
def _cosine(
    grams_l: pa.Array, weights_l: pa.Array, grams_r: pa.Array, weights_r: pa.Array
) -> pa.Array:
    """Dot products of sparse vectors, a batch at a time."""
    row_l, gram_l = _entries(grams_l)
    row_r, gram_r = _entries(grams_r)
    w_l, w_r = _entries(weights_l)[1], _entries(weights_r)[1]
    codes, known = pd.factorize(np.concatenate([gram_l, gram_r]))
    width = max(len(known), 1)
    key_l = row_l * width + codes[: len(gram_l)]
    key_r = row_r * width + codes[len(gram_l) :]
    shared, at_l, at_r = np.intersect1d(key_l, key_r, assume_unique=True, return_indices=True)
    dots = np.bincount(shared // width, weights=w_l[at_l] * w_r[at_r], minlength=len(grams_l))
    return pa.array(dots, type=pa.float64())


def similar_strings(strings: DataFrame, threshold: float) -> DataFrame:
    """Pairs of unequal strings (a < b) with cosine at or above ``threshold``.

    ``strings`` is (s, copies), one row per distinct string.
    """
    vectors = cut_lineage(_vectors(strings))
    headed = vectors.withColumn(
        "head", F.slice("grams", F.lit(1), _prefix_length(F.col("weights"), threshold))
    ).withColumn("left", _lengths_left(F.col("weights"), F.size("head")))
    keyed = headed.select(
        "s", "head", F.explode(F.arrays_zip(F.col("head").alias("gram"), "left")).alias("at")
    ).select("s", "head", "at.gram", "at.left")
    met = pairs_within(keyed, ["gram"], "s", ["head", "left"])
    # A pair counts where it meets first; no earlier gram is shared, so the
    # lengths left from there on bound the cosine.
    first = F.get(F.array_intersect("head_l", "head_r"), F.lit(0)) == F.col("gram")
    reach = F.col("left_l") * F.col("left_r") >= threshold - ROUNDING
    candidates = met.where(reach & first).select(
        F.least("s_l", "s_r").alias("a"), F.greatest("s_l", "s_r").alias("b")
    )
    left = vectors.select(
        F.col("s").alias("a"), F.col("grams").alias("g_a"), F.col("weights").alias("w_a")
    )
    right = vectors.select(
        F.col("s").alias("b"), F.col("grams").alias("g_b"), F.col("weights").alias("w_b")
    )
    return (
        candidates.join(left, "a")
        .join(right, "b")
        .select("a", "b", _cosine("g_a", "w_a", "g_b", "w_b").alias("similarity"))
        .where(F.col("similarity") >= threshold - ROUNDING)
    )


def group_similar(
    df: DataFrame, column: str, id_column: str, min_similarity: float = 0.8
) -> DataFrame:
    """Add ``gp``: the least id in the group of the row's string.

    Rows without a string, or whose string is like no other, stand alone (with
    their copies).
    """
    strings = cut_lineage(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("s"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(id_column).alias("first_id"))
    )
    pairs = similar_strings(strings.select("s", "copies"), min_similarity)
    groups = cluster_pairs(pairs, "a", "b").select(
        F.col("id").alias("s"), F.col("cluster").alias("root")
    )
    rooted = strings.join(groups, "s", "left").withColumn("root", F.coalesce("root", "s"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("gp"))
    named = rooted.join(least, "root").select(F.col("s").alias(column), "gp")
    heavy = heavy_keys(df, [column])
    return salted_join(df, named, [column], heavy, [id_column], "left").withColumn(
        "gp", F.coalesce("gp", id_column)
    )
