"""The two shipped linkage runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.functions.columns import stable_id
from rollgraph.operators.agreement import Comparison, LinkSettings
from rollgraph.operators.pairs import list_pairs
from rollgraph.operators.scoring import Weights, scored_comparisons

NAMES = LinkSettings(
    comparisons=(Comparison("name", term_frequency=True),),
    rules=(("name",),),
)

ADDRESSES = LinkSettings(
    comparisons=(
        Comparison("address1", term_frequency=True),
        Comparison("city", term_frequency=True),
        Comparison("zip_code", term_frequency=True),
    ),
    rules=(("zip_code",), ("city",), ("address1",)),
)


def with_unique_id(records: DataFrame, *keys: str) -> DataFrame:
    """A 128-bit record id from the key columns, the same in every run; nulls allowed."""
    return records.withColumn("unique_id", stable_id("Record", *[F.col(k) for k in keys]))


def dedupe_names(master: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Candidate duplicates among business names."""
    return scored_comparisons(master, NAMES, weights)


def dedupe_addresses(addresses: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Candidate duplicates among addresses."""
    return scored_comparisons(addresses, ADDRESSES, weights)


def record_pairs(
    records: DataFrame, settings: LinkSettings, weights: Weights | None = None, least: float = 0.5, digits: int | None = None
) -> DataFrame:
    """All record pairs of the scored groups with a match probability of ``least`` or
    more, one row each.  The groups say beforehand how many: the sum of ``n_pairs``.
    ``digits`` rounds the scores, once per group and not once per pair."""
    chosen = scored_comparisons(records, settings, weights).where(F.col("match_probability") >= least)
    if digits is not None:
        chosen = chosen.withColumns({c: F.round(c, digits) for c in ("match_probability", "tf_match_probability")})
    return list_pairs(chosen, records, settings)


def name_pairs(
    master: DataFrame, weights: Weights | None = None, least: float = 0.5, digits: int | None = None
) -> DataFrame:
    """Pairs of filings whose names are likely one business."""
    return record_pairs(with_unique_id(master, "filing_num", "name"), NAMES, weights, least, digits)


def address_pairs(
    addresses: DataFrame, weights: Weights | None = None, least: float = 0.5, keys: tuple[str, ...] = ("filing_num", "address1", "city", "zip_code"), digits: int | None = None
) -> DataFrame:
    """Pairs of address rows that are likely one place; ``keys`` tell rows apart."""
    return record_pairs(with_unique_id(addresses, *keys), ADDRESSES, weights, least, digits)
