"""The whole graph build as one lazy plan per output table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.operators.addresses import (
    build_address_edges,
    build_property_owner_edges,
    with_canonical,
)
from rollgraph.operators.grouping import group_similar
from rollgraph.operators.index import (
    business_nodes,
    name_index,
    name_to_nodes,
    update_property,
)
from rollgraph.operators.links import build_agent_edges, build_officer_edges, union_edges
from rollgraph.sources.fixedwidth import PLACE, Registry


def group_addresses(
    addresses: DataFrame, id_column: str = "row_no", min_similarity: float = 0.8
) -> DataFrame:
    """Addresses with ``pa`` and with ``gp``, the group of near-identical ones.

    ``gp`` is text, for use as the group key of ``build_graph``; rows without
    an address have none.
    """
    keyed = addresses if "pa" in addresses.columns else with_canonical(addresses)
    grouped = group_similar(keyed, "pa", id_column, min_similarity)
    return grouped.withColumn(
        "gp", F.when(F.col("pa").isNotNull(), F.col("gp").cast("string"))
    )


class EntityGraph(NamedTuple):
    business: DataFrame
    address: DataFrame
    edges: DataFrame


def graph_of_registry(registry: Registry, roll: DataFrame | None = None) -> EntityGraph:
    """The graph of a bulk file that ``split_layouts`` has parted: every table is read
    from its own part, and of one address the last row of the file wins."""
    links = ("filing_num", "business_name")
    return build_graph(
        registry.table("master").select("filing_num", "name", "corp_type_id"),
        registry.table("charter_officer_business").select(*links),
        registry.table("registered_agent_business").select(*links),
        registry.placed("address"),
        roll,
        address_order=PLACE,
    )


def build_graph(
    master: DataFrame,
    officers: DataFrame,
    agents: DataFrame,
    addresses: DataFrame,
    roll: DataFrame | None = None,
    address_order: tuple[str, ...] = ("row_no",),
    group_key: str = "pa",
) -> EntityGraph:
    """Business and address nodes and all four kinds of edges."""
    index = name_index(master)
    business = business_nodes(index)
    typed = update_property(
        business, master.select("filing_num", "corp_type_id"), "filing_num", "corp_type_id",
        "corp_type_id",
    )
    keyed = addresses if "pa" in addresses.columns else with_canonical(addresses)
    places = build_address_edges(keyed, business, address_order, group_key)
    parts = [
        build_officer_edges(master, officers, index, business),
        build_agent_edges(master, agents, index, business),
        places.edges,
    ]
    if roll is not None:
        parts.append(
            build_property_owner_edges(roll, name_to_nodes(index, business), places.nodes)
        )
    return EntityGraph(typed, places.nodes, union_edges(*parts))
