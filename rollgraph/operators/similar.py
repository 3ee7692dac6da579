"""Similar values without comparing all of them (L3, L4).

A pair with Jaro-Winkler similarity t has a Jaro similarity of at least
J = (t - 0.4) / 0.6, and Jaro <= (m/|a| + m/|b| + 1) / 3 for m matched
characters.  So m >= c |a||b| / (|a|+|b|) with c = 3J - 1.  Take the
characters of a value as a set (the second E is another element than the
first) and sort them by any fixed order, rare ones first: two values with that
many elements in common share one among their first
|a| - ceil((c - 1)|a|) + 1.  Only values that meet on such an element are
looked at, and what is left is checked exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.functions.similarity import jaro_winkler
from rollgraph.operators.skew import pairs_within
from rollgraph.session import cut_lineage

# Letters from frequent to rare; only the speed depends on it.
COMMON_FIRST = " EATOINSRHLDCUMFPGWYBVKXJQZ"


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not at every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _elements(text: Column) -> Column:
    """Characters numbered by occurrence as sorted integers, rare ones first.

    High bits for the occurrence (later ones are rarer), seven for the rank of
    the letter, 21 for the code point.
    """

    def numbered(chars: Column) -> Column:
        def element(char: Column, at: Column) -> Column:
            nth = at - F.array_position(chars, char) + 2
            rank = F.instr(F.lit(COMMON_FIRST), F.upper(char))
            rarity = F.when(rank == 0, 0).otherwise(F.lit(99) - rank)
            return (
                F.shiftleft((F.lit(1 << 30) - nth).cast("bigint"), 28)
                + F.shiftleft(rarity.cast("bigint"), 21)
                + F.ascii(char)
            )

        return F.transform(chars, element)

    return F.sort_array(_once(F.sort_array(F.split(text, "")), numbered))


def similar_values(
    values: DataFrame, block: Sequence[str], column: str, threshold: float
) -> DataFrame:
    """Distinct unequal values of ``column`` in one block with similarity >= threshold.

    Columns: ``block``, ``value_l`` < ``value_r`` and ``similarity``; every pair once.
    """
    need = 3 * (threshold - 0.4) / 0.6 - 1
    size = F.size("_elements")
    prefix = F.greatest(
        F.lit(1), F.least(size, size - F.ceil(F.lit(need - 1) * size - F.lit(1e-9)) + 1)
    ).cast("int")
    distinct = cut_lineage(
        values.select(*block, F.col(column).alias("_v"))
        .where(F.col("_v").isNotNull() & (F.col("_v") != ""))
        .distinct()
        .withColumn("_elements", _elements(F.col("_v")))
        .withColumn("_head", F.slice("_elements", F.lit(1), prefix))
    )
    keyed = distinct.withColumn("_element", F.explode("_head"))
    met = pairs_within(keyed, [*block, "_element"], "_v", ["_elements", "_head"])
    first_shared = F.get(F.array_intersect("_head_l", "_head_r"), F.lit(0)) == F.col("_element")
    n_l, n_r = F.size("_elements_l"), F.size("_elements_r")
    shared = F.size(F.array_intersect("_elements_l", "_elements_r"))
    enough = shared * (n_l + n_r) >= F.lit(need) * n_l * n_r - F.lit(1e-6)
    near_length = F.least(n_l, n_r) >= F.lit(need - 1) * F.greatest(n_l, n_r) - F.lit(1e-6)
    return (
        met.where(near_length)
        .where(first_shared)
        .where(enough)
        .select(
            *block,
            F.least("_v_l", "_v_r").alias("value_l"),
            F.greatest("_v_l", "_v_r").alias("value_r"),
        )
        .withColumn("similarity", jaro_winkler("value_l", "value_r"))
        .where(F.col("similarity") >= threshold)
    )
