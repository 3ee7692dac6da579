"""Address nodes and the edges that end in them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.functions.columns import canonical_address, stable_id
from rollgraph.operators.links import AT, OWNER
from rollgraph.operators.select import non_empty
from rollgraph.operators.skew import ROW_TAG, heavy_keys, row_tag, salted_join

ATTRIBUTES = (
    "address1", "address2", "city", "state", "zip_code", "zip_extension", "country", "pa",
)


class AddressGraph(NamedTuple):
    nodes: DataFrame
    edges: DataFrame
    rejects: DataFrame


def with_canonical(addresses: DataFrame) -> DataFrame:
    """Registry addresses with ``pa``; the second line does not take part."""
    return addresses.withColumn(
        "pa",
        canonical_address(
            F.col("address1"), F.lit(None), F.col("city"), F.col("zip_code"), F.col("country")
        ),
    )


def address_nodes(rows: DataFrame, group_key: str, order: Sequence[str]) -> DataFrame:
    """One node per group; the last row's attributes win as a unit.

    ``order`` must rank the rows of a group without ties.
    """
    kept = [c for c in ATTRIBUTES if c in rows.columns]
    last = F.max_by(F.struct(*kept), F.struct(*order))
    return (
        rows.where(F.col(group_key).isNotNull())
        .groupBy(F.col(group_key).alias("gp"))
        .agg(last.alias("a"))
        .select(stable_id("Address", F.col("gp")).alias("id"), "gp", "a.*")
    )


def build_address_edges(
    addresses: DataFrame, business: DataFrame, order: Sequence[str], group_key: str = "pa"
) -> AddressGraph:
    """Addresses of known businesses: nodes, one edge per row and business, rejects.

    An address whose filing has no business makes no node.  Rows without a
    group key are returned as rejects.
    """
    tagged = row_tag(addresses)
    owners = business.select("filing_num", F.col("id").alias("src"))
    matched = salted_join(
        tagged, owners, ["filing_num"], heavy_keys(addresses, ["filing_num"]), [ROW_TAG]
    )
    grouped = matched.where(F.col(group_key).isNotNull())
    edges = grouped.select(
        "src", stable_id("Address", F.col(group_key)).alias("dst"), F.lit(AT).alias("type")
    )
    rejects = matched.where(F.col(group_key).isNull()).select(*addresses.columns)
    return AddressGraph(address_nodes(grouped, group_key, order), edges, rejects)


def build_property_owner_edges(
    roll: DataFrame, by_name: DataFrame, addresses: DataFrame
) -> DataFrame:
    """Owner business -> address edges, one per matching address node.

    ``by_name`` maps names to nodes; an owner must match a name exactly and a
    missing owner matches nothing.
    """
    pa = canonical_address(
        F.col("mail_add_2"), F.col("mail_add_3"), F.col("mail_city"), F.col("mail_zip"), F.lit("US")
    )
    owned = roll.where(F.col("prop_owner").isNotNull())
    tagged = row_tag(owned).withColumn("pa", pa).select("prop_owner", "pa", ROW_TAG)
    tagged = tagged.where(F.col("pa").isNotNull())
    owner = by_name.where(F.col("name").isNotNull()).select(
        F.col("name").alias("prop_owner"), F.col("node").alias("src")
    )
    places = addresses.where(F.col("pa").isNotNull()).select("pa", F.col("id").alias("dst"))
    first = salted_join(
        tagged, owner, ["prop_owner"], heavy_keys(tagged, ["prop_owner"]), [ROW_TAG]
    )
    both = salted_join(first, places, ["pa"], heavy_keys(tagged, ["pa"]), [ROW_TAG])
    return both.select("src", "dst", F.lit(OWNER).alias("type"))


def link_where(
    left: DataFrame, right: DataFrame, edge_type: str = AT, rows_per_cell: int = 1_000_000
) -> DataFrame:
    """One edge from every node of ``left`` to every node of ``right``.

    Both sides come already filtered; ``left`` is one named business, so the
    result is as long as ``right``.  The right side is dealt to cells by the hash
    of its id, as many as its count asks for, and the left side is repeated in
    each, which makes this an ordinary hash join.
    """
    cells = max(1, -(-right.count() // rows_per_cell))
    dealt = right.select(
        F.col("id").alias("dst"), F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int").alias("cell")
    )
    repeated = left.select(
        F.col("id").alias("src"),
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"),
    )
    return dealt.join(repeated, "cell").select("src", "dst", F.lit(edge_type).alias("type"))


def addresses_from_property(nodes: DataFrame) -> AddressGraph:
    """Every node with an ``address1`` gets an address node of its own."""
    made = nodes.where(non_empty(F.col("address1"))).select(
        F.col("id").alias("src"),
        stable_id("Address", F.lit("of"), F.col("id")).alias("dst"),
        F.col("address1").alias("address"),
        "zip_code",
    )
    return AddressGraph(
        made.select(F.col("dst").alias("id"), "address", "zip_code"),
        made.select("src", "dst", F.lit(AT).alias("type")),
        nodes.where(~F.coalesce(non_empty(F.col("address1")), F.lit(False))),
    )
