"""Graph build and merge queries over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.functions.columns import stable_id
from rollgraph.operators import addresses as adr
from rollgraph.operators import index as idx
from rollgraph.operators import links as lnk
from rollgraph.operators import merge as mrg
from rollgraph.operators import select as sel
from rollgraph.plans.fixtures import view
from rollgraph.plans.graph import build_graph, graph_of_registry
from rollgraph.plans.registry import query
from rollgraph.session import scratch_path
from rollgraph.sources import fixedwidth
from rollgraph.sources.tables import read_graph, write_graph


def _index(spark, sf):
    return idx.name_index(view(spark, sf, "fx_master"))


def _nodes(spark, sf):
    return idx.business_nodes(_index(spark, sf))


def _officer_links(spark, sf):
    return lnk.officer_links(view(spark, sf, "fx_master"), view(spark, sf, "fx_officer"))


def _addresses(spark, sf):
    return adr.with_canonical(view(spark, sf, "fx_address"))


def _address_graph(spark, sf):
    return adr.build_address_edges(_addresses(spark, sf), _nodes(spark, sf), ["row_no"])


def _row_nodes(spark, sf):
    """One address node per address row."""
    return _addresses(spark, sf).select(
        stable_id("Address", F.col("row_no")).alias("id"), "address1", "city", "zip_code", "pa"
    )


def _row_edges(spark, sf):
    keyed = _addresses(spark, sf).withColumn("row_key", F.col("row_no").cast("string"))
    return adr.build_address_edges(keyed, _nodes(spark, sf), ["row_no"], "row_key").edges


@query("SELECT name, filing_num FROM idx", "idx")
def name_index(spark, sf) -> DataFrame:
    return _index(spark, sf)


@query("SELECT id, filing_num, name FROM nodes", "nodes")
def business_nodes(spark, sf) -> DataFrame:
    return _nodes(spark, sf)


@query("SELECT count(*) AS n FROM officer_links", "officer_links")
def row_count(spark, sf) -> DataFrame:
    return idx.row_count(_officer_links(spark, sf))


@query("SELECT name FROM nodes WHERE name = 'red widget'", "nodes")
def find_business(spark, sf) -> DataFrame:
    return idx.find_business(_nodes(spark, sf), "red widget")


@query("SELECT filing_num, name, business_name FROM officer_links", "officer_links")
def officer_links(spark, sf) -> DataFrame:
    return _officer_links(spark, sf)


@query("SELECT filing_num, name, business_name FROM agent_links", "agent_links")
def agent_links(spark, sf) -> DataFrame:
    return lnk.agent_links(view(spark, sf, "fx_master"), view(spark, sf, "fx_agent"))


@query(
    "SELECT filing_num, name, business_name, company_filing, officer_filing FROM resolved",
    "resolved",
)
def resolve_names(spark, sf) -> DataFrame:
    return lnk.resolve_names(_officer_links(spark, sf), _index(spark, sf))


@query(
    "SELECT s.id AS src, d.id AS dst, 'is_charter_officer_business' AS type FROM resolved r "
    "JOIN nodes d ON d.filing_num = r.company_filing "
    "JOIN nodes s ON s.filing_num = r.officer_filing",
    "resolved",
    "nodes",
)
def match_endpoints(spark, sf) -> DataFrame:
    keyed = lnk.resolve_names(_officer_links(spark, sf), _index(spark, sf))
    return lnk.match_endpoints(keyed, _nodes(spark, sf), lnk.OFFICER)


@query("SELECT * FROM officer_edges", "officer_edges")
def officer_edges(spark, sf) -> DataFrame:
    index = _index(spark, sf)
    return lnk.build_officer_edges(
        view(spark, sf, "fx_master"), view(spark, sf, "fx_officer"), index,
        idx.business_nodes(index),
    )


@query("SELECT * FROM agent_edges", "agent_edges")
def agent_edges(spark, sf) -> DataFrame:
    index = _index(spark, sf)
    return lnk.build_agent_edges(
        view(spark, sf, "fx_master"), view(spark, sf, "fx_agent"), index,
        idx.business_nodes(index),
    )


@query(
    "SELECT filing_num, name, business_name FROM officer_links k "
    "WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.name IS NOT DISTINCT FROM k.business_name) "
    "OR NOT EXISTS (SELECT 1 FROM idx i WHERE i.name IS NOT DISTINCT FROM k.name)",
    "officer_links",
    "idx",
)
def unresolved_links(spark, sf) -> DataFrame:
    return lnk.unresolved_links(_officer_links(spark, sf), _index(spark, sf))


@query(
    "SELECT n.id, n.filing_num, n.name, max(CAST(m.corp_type_id AS VARCHAR)) AS corp_type_id "
    "FROM nodes n LEFT JOIN fx_master m ON m.filing_num = n.filing_num "
    "GROUP BY n.id, n.filing_num, n.name",
    "nodes",
)
def update_property(spark, sf) -> DataFrame:
    values = view(spark, sf, "fx_master").select("filing_num", "corp_type_id")
    return idx.update_property(
        _nodes(spark, sf), values, "filing_num", "corp_type_id", "corp_type_id"
    )


@query("SELECT id, gp, address1, city, zip_code, country, pa FROM places", "places")
def address_nodes(spark, sf) -> DataFrame:
    return _address_graph(spark, sf).nodes


@query("SELECT src, dst, type FROM at_edges", "at_edges")
def address_edges(spark, sf) -> DataFrame:
    return _address_graph(spark, sf).edges


@query(
    "SELECT row_no, filing_num, address1, city, zip_code, country FROM matched "
    "WHERE CASE WHEN zip_code <> '00005' THEN pa END IS NULL",
    "matched",
)
def address_rejects(spark, sf) -> DataFrame:
    keyed = _addresses(spark, sf).withColumn("gp", F.when(F.col("zip_code") != "00005", F.col("pa")))
    rejects = adr.build_address_edges(keyed, _nodes(spark, sf), ["row_no"], "gp").rejects
    return rejects.drop("pa", "gp")


@query("SELECT src, dst, type FROM owner_edges", "owner_edges")
def property_owner_edges(spark, sf) -> DataFrame:
    index = _index(spark, sf)
    by_name = idx.name_to_nodes(index, idx.business_nodes(index))
    return adr.build_property_owner_edges(
        view(spark, sf, "fx_roll"), by_name, _address_graph(spark, sf).nodes
    )


@query(
    "SELECT n.id AS src, a.id AS dst, 'is_at' AS type FROM nodes n, row_nodes a "
    "WHERE n.name = 'red widget' AND a.zip_code = '00007'",
    "nodes",
    "row_nodes",
)
def link_where(spark, sf) -> DataFrame:
    return adr.link_where(
        sel.match_props(_nodes(spark, sf), name="red widget"),
        sel.match_props(_row_nodes(spark, sf), zip_code="00007"),
    )


@query(
    "SELECT md5(concat_ws('|', 'Address', '=of', '=' || id)) AS id, address1 AS address, zip_code "
    "FROM row_nodes WHERE address1 <> ''",
    "row_nodes",
)
def addresses_from_property(spark, sf) -> DataFrame:
    return adr.addresses_from_property(_row_nodes(spark, sf)).nodes


@query(
    "SELECT src, dst, type FROM officer_edges UNION ALL SELECT src, dst, type FROM agent_edges "
    "UNION ALL SELECT src, dst, type FROM at_edges UNION ALL SELECT src, dst, type FROM owner_edges",
    "officer_edges",
    "agent_edges",
    "at_edges",
    "owner_edges",
)
def union_edges(spark, sf) -> DataFrame:
    return _graph(spark, sf).edges


@query(
    "SELECT src, dst, type FROM officer_edges UNION ALL SELECT src, dst, type FROM agent_edges "
    "UNION ALL SELECT src, dst, type FROM at_edges UNION ALL SELECT src, dst, type FROM owner_edges",
    "officer_edges", "agent_edges", "at_edges", "owner_edges",
)
def bulk_file_edges(spark, sf) -> DataFrame:
    """From a bulk file to the edges: written as text, parted in one scan, read back."""
    layouts = {
        "02": ("fx_master", ("filing_num", "name")),
        "03": ("fx_address", ("filing_num", "address1", "city", "zip_code", "country")),
        "05": ("fx_agent", ("filing_num", "business_name")),
        "07": ("fx_officer", ("filing_num", "business_name")),
    }
    lines = [
        fixedwidth.render_layout(view(spark, sf, source), code, {c: F.col(c) for c in columns})
        for code, (source, columns) in layouts.items()
    ]
    path = scratch_path(spark, "registry")
    fixedwidth.write_lines(reduce(DataFrame.unionByName, lines), f"{path}/file")
    registry = fixedwidth.split_layouts(spark, f"{path}/file", f"{path}/parted")
    return graph_of_registry(registry, view(spark, sf, "fx_roll")).edges.select("src", "dst", "type")


def _graph(spark, sf):
    return build_graph(
        view(spark, sf, "fx_master"),
        view(spark, sf, "fx_officer"),
        view(spark, sf, "fx_agent"),
        view(spark, sf, "fx_address"),
        view(spark, sf, "fx_roll"),
    )


@query(
    "SELECT type, count(*) AS n FROM (SELECT type FROM officer_edges "
    "UNION ALL SELECT type FROM agent_edges UNION ALL SELECT type FROM at_edges "
    "UNION ALL SELECT type FROM owner_edges) GROUP BY type "
    "UNION ALL SELECT 'business', count(*) FROM nodes "
    "UNION ALL SELECT 'address', count(*) FROM places",
    "officer_edges",
    "agent_edges",
    "at_edges",
    "owner_edges",
)
def written_graph(spark, sf) -> DataFrame:
    """Write the whole graph, read it back and count it."""
    graph = _graph(spark, sf)
    path = scratch_path(spark, "graph")
    write_graph({"business": graph.business, "address": graph.address}, graph.edges, path)
    nodes, edges = read_graph(spark, path, ["business", "address"])
    counts = edges.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    for label, df in nodes.items():
        counts = counts.unionByName(
            df.agg(F.count(F.lit(1)).alias("n")).withColumn("type", F.lit(label))
        )
    return counts


@query(
    "SELECT name, n.id, min(n.id) OVER (PARTITION BY name) AS survivor, "
    "count(*) OVER (PARTITION BY name) AS size FROM (SELECT md5(concat_ws('|', 'Business', "
    "'=' || CAST(filing_num AS VARCHAR))) AS id, name FROM fx_master) n "
    "QUALIFY count(*) OVER (PARTITION BY name) > 1",
    "fx_master",
)
def duplicate_groups(spark, sf) -> DataFrame:
    filings = view(spark, sf, "fx_master").select(
        stable_id("Business", F.col("filing_num")).alias("id"), "name"
    )
    return mrg.duplicate_groups(filings, "name")


@query(
    "SELECT src, dst, type FROM at_edges WHERE (SELECT count(*) FROM at_edges) > 1", "at_edges"
)
def gate_on_total(spark, sf) -> DataFrame:
    return sel.gate_on_total(_address_graph(spark, sf).edges, 1)


_MOVED = (
    ", mapping AS ({mapping}) SELECT coalesce(s.survivor, e.src) AS src, "
    "coalesce(d.survivor, e.dst) AS dst, e.type FROM {edges} e "
    "LEFT JOIN mapping s ON s.id = e.src LEFT JOIN mapping d ON d.id = e.dst"
)

# Filings as nodes, linked filing by filing: what a merge by name starts from.
_FILINGS = (
    "SELECT md5(concat_ws('|', 'Business', '=' || CAST(filing_num AS VARCHAR))) AS id, "
    "filing_num, name FROM fx_master"
)


def _filing_nodes(spark, sf):
    return view(spark, sf, "fx_master").select(
        stable_id("Business", F.col("filing_num")).alias("id"), "filing_num", "name"
    )


def _filing_edges(spark, sf):
    links = view(spark, sf, "fx_agent").select(
        F.col("filing_num").alias("company_filing"), "business_name"
    )
    officer = _index(spark, sf).select(
        F.col("name").alias("business_name"), F.col("filing_num").alias("officer_filing")
    )
    return lnk.match_endpoints(
        links.join(officer, "business_name"), _filing_nodes(spark, sf), lnk.AGENT
    )


@query(
    ", filings AS (" + _FILINGS + ") SELECT id, filing_num, name FROM filings f "
    "WHERE id = (SELECT min(id) FROM filings g WHERE g.name = f.name)",
    "fx_master",
)
def merge_nodes(spark, sf) -> DataFrame:
    return mrg.merge_nodes(_filing_nodes(spark, sf), _filing_edges(spark, sf), "name").nodes


@query(
    ", filings AS (" + _FILINGS + "), mapping AS (SELECT id, min(id) OVER (PARTITION BY name) "
    "AS survivor FROM filings) SELECT s.survivor AS src, d.survivor AS dst, "
    "'is_registered_agent_business' AS type FROM fx_agent a "
    "JOIN idx i ON i.name = a.business_name JOIN filings fs ON fs.filing_num = i.filing_num "
    "JOIN filings fd ON fd.filing_num = a.filing_num "
    "JOIN mapping s ON s.id = fs.id JOIN mapping d ON d.id = fd.id",
    "fx_master",
    "fx_agent",
    "idx",
)
def merge_nodes_edges(spark, sf) -> DataFrame:
    return mrg.merge_nodes(_filing_nodes(spark, sf), _filing_edges(spark, sf), "name").edges


@query(
    ", filings AS (" + _FILINGS + ") SELECT min(id) AS id, arg_max(filing_num, id) AS filing_num, "
    "arg_max(name, id) AS name FROM filings GROUP BY name",
    "fx_master",
)
def merge_nodes_last(spark, sf) -> DataFrame:
    merged = mrg.merge_nodes(
        _filing_nodes(spark, sf), _filing_edges(spark, sf), "name", props="last"
    )
    return merged.nodes


@query(
    ", members AS (SELECT id, min(id) OVER (PARTITION BY pa) AS survivor, city, zip_code "
    "FROM row_nodes QUALIFY count(*) OVER (PARTITION BY pa) > 1) "
    "SELECT survivor, 'city' AS property, city AS value, count(*) AS n FROM members GROUP BY 1, 3 "
    "UNION ALL SELECT survivor, 'zip_code', zip_code, count(*) FROM members GROUP BY 1, 3",
    "row_nodes",
)
def combined_values(spark, sf) -> DataFrame:
    nodes = _row_nodes(spark, sf)
    return mrg.combined_values(nodes, mrg.duplicate_groups(nodes, "pa"), ["city", "zip_code"])


@query(
    _MOVED.format(
        mapping="SELECT id, (SELECT min(id) FROM row_nodes) AS survivor FROM row_nodes",
        edges="row_edges",
    ),
    "row_nodes",
    "row_edges",
)
def merge_all_edges(spark, sf) -> DataFrame:
    return mrg.merge_all(_row_nodes(spark, sf), _row_edges(spark, sf)).edges


@query(
    "SELECT * FROM row_nodes WHERE zip_code <> '00003' OR id = "
    "(SELECT min(id) FROM row_nodes WHERE zip_code = '00003')",
    "row_nodes",
)
def merge_zip_nodes(spark, sf) -> DataFrame:
    return mrg.merge_all(
        _row_nodes(spark, sf), _row_edges(spark, sf), F.col("zip_code") == "00003"
    ).nodes


@query(
    _MOVED.format(
        mapping="SELECT id, (SELECT min(id) FROM row_nodes WHERE zip_code = '00003') AS survivor "
        "FROM row_nodes WHERE zip_code = '00003'",
        edges="row_edges",
    ),
    "row_nodes",
    "row_edges",
)
def merge_zip_edges(spark, sf) -> DataFrame:
    return mrg.merge_all(
        _row_nodes(spark, sf), _row_edges(spark, sf), F.col("zip_code") == "00003"
    ).edges


@query(
    "SELECT * FROM row_nodes r WHERE id = (SELECT min(id) FROM row_nodes s WHERE s.pa = r.pa)",
    "row_nodes",
)
def merge_by_address_nodes(spark, sf) -> DataFrame:
    return mrg.merge_by_address(_row_nodes(spark, sf), _row_edges(spark, sf)).nodes


@query(
    _MOVED.format(
        mapping="SELECT id, min(id) OVER (PARTITION BY pa) AS survivor FROM row_nodes",
        edges="row_edges",
    ),
    "row_nodes",
    "row_edges",
)
def merge_by_address_edges(spark, sf) -> DataFrame:
    return mrg.merge_by_address(_row_nodes(spark, sf), _row_edges(spark, sf)).edges


@query(
    ", every AS (SELECT src, dst, type FROM officer_edges "
    "UNION ALL SELECT src, dst, type FROM agent_edges) "
    "SELECT src, dst, min(type) AS type, count(*) AS n, "
    "string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM every "
    "WHERE (SELECT count(*) FROM every) > 1 GROUP BY src, dst",
    "officer_edges",
    "agent_edges",
)
def merge_parallel_edges(spark, sf) -> DataFrame:
    return mrg.merge_parallel_edges(
        lnk.union_edges(officer_edges(spark, sf), agent_edges(spark, sf))
    )


@query(
    "SELECT src, dst, min(type) AS type, count(*) AS n, 'is_at' AS types FROM at_edges "
    "WHERE (SELECT count(*) FROM at_edges) > 1 GROUP BY src, dst",
    "at_edges",
)
def merge_parallel_address_edges(spark, sf) -> DataFrame:
    edges = lnk.union_edges(_address_graph(spark, sf).edges, agent_edges(spark, sf))
    return mrg.merge_parallel_edges(edges, types=[lnk.AT])


@query(
    "SELECT n.name, a.id, a.pa FROM nodes n, row_nodes a WHERE n.name = 'red widget' "
    "AND a.zip_code = '00007' ORDER BY n.name, a.id LIMIT 300",
    "nodes",
    "row_nodes",
)
def top_rows(spark, sf) -> DataFrame:
    places = _row_nodes(spark, sf)
    shown = (
        link_where(spark, sf)
        .join(places.select(F.col("id").alias("dst"), "pa"), "dst")
        .join(_nodes(spark, sf).select(F.col("id").alias("src"), "name"), "src")
        .select("name", F.col("dst").alias("id"), "pa")
    )
    return sel.top_rows(shown, ["name", "id"], 300)
