"""From registry links to business edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.operators.index import name_to_nodes
from rollgraph.operators.skew import ROW_TAG, heavy_keys, row_tag, salted_join

OFFICER = "is_charter_officer_business"
AGENT = "is_registered_agent_business"
OWNER = "is_property_owner"
AT = "is_at"


def _company_links(master: DataFrame, links: DataFrame) -> DataFrame:
    tagged = row_tag(links, "filing_num", "business_name")
    heavy = heavy_keys(links, ["filing_num"])
    names = master.select("filing_num", "name")
    return salted_join(tagged, names, ["filing_num"], heavy, [ROW_TAG]).select(
        "filing_num", "name", "business_name"
    )


def officer_links(master: DataFrame, officers: DataFrame) -> DataFrame:
    """Every officer row with the name of its company; repeats are kept."""
    return _company_links(master, officers)


def agent_links(master: DataFrame, agents: DataFrame) -> DataFrame:
    """Every registered-agent row with the name of its company."""
    return _company_links(master, agents)


def resolve_names(links: DataFrame, index: DataFrame) -> DataFrame:
    """Both names to filings; a row with an unknown name falls out.

    A null name is a name like any other here.
    """
    company = index.select("name", F.col("filing_num").alias("company_filing"))
    officer = index.select(
        F.col("name").alias("business_name"), F.col("filing_num").alias("officer_filing")
    )
    first = salted_join(links, company, ["name"], None, null_safe=True)
    return salted_join(first, officer, ["business_name"], None, null_safe=True)


def match_endpoints(keyed: DataFrame, nodes: DataFrame, edge_type: str) -> DataFrame:
    """Edges officer -> company for ``company_filing``/``officer_filing`` rows.

    A filing held by several nodes gives the product of its matches; self-loops
    and parallel edges stay.
    """
    dst = nodes.select(F.col("filing_num").alias("company_filing"), F.col("id").alias("dst"))
    src = nodes.select(F.col("filing_num").alias("officer_filing"), F.col("id").alias("src"))
    first = salted_join(keyed, dst, ["company_filing"], None)
    both = salted_join(first, src, ["officer_filing"], None)
    return both.select("src", "dst", F.lit(edge_type).alias("type"))


def _link_edges(
    master: DataFrame, links: DataFrame, index: DataFrame, nodes: DataFrame, edge_type: str
) -> DataFrame:
    # Names are resolved on the master side, which is smaller than the links,
    # so the links themselves are shuffled twice only: by filing and by name.
    by_name = name_to_nodes(index, nodes)
    company = salted_join(
        master.select("filing_num", "name"),
        by_name.withColumnRenamed("node", "dst"),
        ["name"],
        heavy_keys(master, ["name"]),
        ["filing_num"],
        null_safe=True,
    )
    officer = by_name.select(F.col("name").alias("business_name"), F.col("node").alias("src"))
    tagged = row_tag(links, "filing_num", "business_name")
    first = salted_join(
        tagged, company, ["filing_num"], heavy_keys(links, ["filing_num"]), [ROW_TAG]
    )
    both = salted_join(
        first, officer, ["business_name"], heavy_keys(links, ["business_name"]), [ROW_TAG],
        null_safe=True,
    )
    return both.select(
        "src",
        "dst",
        F.lit(edge_type).alias("type"),
        F.col("business_name").alias("src_name"),
        F.col("name").alias("dst_name"),
    )


def build_officer_edges(
    master: DataFrame, officers: DataFrame, index: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Officer business -> company edges, with both names alongside."""
    return _link_edges(master, officers, index, nodes, OFFICER)


def build_agent_edges(
    master: DataFrame, agents: DataFrame, index: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Registered agent -> company edges, with both names alongside."""
    return _link_edges(master, agents, index, nodes, AGENT)


def unresolved_links(links: DataFrame, index: DataFrame) -> DataFrame:
    """Links of which at least one name is not in the index."""
    company = index.select("name", F.lit(True).alias("_company"))
    officer = index.select(F.col("name").alias("business_name"), F.lit(True).alias("_officer"))
    first = salted_join(links, company, ["name"], None, how="left", null_safe=True)
    both = salted_join(first, officer, ["business_name"], None, how="left", null_safe=True)
    return both.where(F.col("_company").isNull() | F.col("_officer").isNull()).select(*links.columns)


def union_edges(*parts: DataFrame) -> DataFrame:
    """All edge kinds in one table; parallel edges are kept."""
    first, *rest = [p.select("src", "dst", "type") for p in parts]
    for part in rest:
        first = first.unionByName(part)
    return first
