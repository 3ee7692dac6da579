"""Queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollgraph.plans.fixtures import view_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# Common table expressions the checks share, with the ones they build on.
SHARED = {
    "idx": (
        ("fx_master",),
        "SELECT name, max(filing_num) AS filing_num FROM fx_master GROUP BY name",
    ),
    "nodes": (
        ("idx",),
        "SELECT md5(concat_ws('|', 'Business', coalesce('=' || name, '-'))) AS id, "
        "filing_num, name FROM idx",
    ),
    "officer_links": (
        ("fx_master", "fx_officer"),
        "SELECT m.filing_num, m.name, o.business_name FROM fx_master m "
        "JOIN fx_officer o ON m.filing_num = o.filing_num",
    ),
    "agent_links": (
        ("fx_master", "fx_agent"),
        "SELECT m.filing_num, m.name, o.business_name FROM fx_master m "
        "JOIN fx_agent o ON m.filing_num = o.filing_num",
    ),
    "resolved": (
        ("officer_links", "idx"),
        "SELECT k.*, a.filing_num AS company_filing, b.filing_num AS officer_filing "
        "FROM officer_links k JOIN idx a ON a.name IS NOT DISTINCT FROM k.name "
        "JOIN idx b ON b.name IS NOT DISTINCT FROM k.business_name",
    ),
    "officer_edges": (
        ("officer_links", "idx", "nodes"),
        "SELECT s.id AS src, d.id AS dst, 'is_charter_officer_business' AS type, "
        "k.business_name AS src_name, k.name AS dst_name "
        "FROM officer_links k JOIN idx a ON a.name IS NOT DISTINCT FROM k.name "
        "JOIN idx b ON b.name IS NOT DISTINCT FROM k.business_name "
        "JOIN nodes d ON d.filing_num = a.filing_num "
        "JOIN nodes s ON s.filing_num = b.filing_num",
    ),
    "agent_edges": (
        ("agent_links", "idx", "nodes"),
        "SELECT s.id AS src, d.id AS dst, 'is_registered_agent_business' AS type, "
        "k.business_name AS src_name, k.name AS dst_name "
        "FROM agent_links k JOIN idx a ON a.name IS NOT DISTINCT FROM k.name "
        "JOIN idx b ON b.name IS NOT DISTINCT FROM k.business_name "
        "JOIN nodes d ON d.filing_num = a.filing_num "
        "JOIN nodes s ON s.filing_num = b.filing_num",
    ),
    "address_pa": (
        ("fx_address",),
        "SELECT *, concat_ws(chr(10), upper(trim(address1)), upper(trim(city)), "
        "upper(trim(zip_code)), country) AS pa FROM fx_address",
    ),
    "matched": (
        ("address_pa", "nodes"),
        "SELECT a.*, n.id AS src FROM address_pa a JOIN nodes n ON n.filing_num = a.filing_num",
    ),
    "places": (
        ("matched",),
        "SELECT md5(concat_ws('|', 'Address', '=' || pa)) AS id, pa AS gp, "
        "arg_max(address1, row_no) AS address1, arg_max(city, row_no) AS city, "
        "arg_max(zip_code, row_no) AS zip_code, arg_max(country, row_no) AS country, "
        "arg_max(pa, row_no) AS pa FROM matched GROUP BY pa",
    ),
    "at_edges": (
        ("matched",),
        "SELECT src, md5(concat_ws('|', 'Address', '=' || pa)) AS dst, 'is_at' AS type "
        "FROM matched",
    ),
    "owner_edges": (
        ("fx_roll", "idx", "nodes", "places"),
        "SELECT n.id AS src, p.id AS dst, 'is_property_owner' AS type FROM fx_roll r "
        "JOIN idx i ON i.name = r.prop_owner JOIN nodes n ON n.filing_num = i.filing_num "
        "JOIN places p ON p.pa = concat_ws(chr(10), upper(trim(r.mail_add_2)), "
        "upper(trim(r.mail_add_3)), upper(trim(r.mail_city)), upper(trim(r.mail_zip)), 'US')",
    ),
    # One node per address row: what the address merges start from.
    "row_nodes": (
        ("address_pa",),
        "SELECT md5(concat_ws('|', 'Address', '=' || CAST(row_no AS VARCHAR))) AS id, "
        "address1, city, zip_code, pa FROM address_pa",
    ),
    "row_edges": (
        ("address_pa", "nodes"),
        "SELECT n.id AS src, md5(concat_ws('|', 'Address', '=' || CAST(a.row_no AS VARCHAR))) "
        "AS dst, 'is_at' AS type FROM address_pa a JOIN nodes n ON n.filing_num = a.filing_num",
    ),
}


def with_parts(sql: str, *parts: str) -> str:
    """``sql`` with the named common table expressions and all they need."""
    bodies: dict[str, str] = {}

    def need(name: str) -> None:
        if name in bodies:
            return
        if name in SHARED:
            needs, body = SHARED[name]
            for other in needs:
                need(other)
            bodies[name] = body
        else:
            bodies[name] = view_sql(name)

    for part in parts:
        need(part)
    if not bodies:
        return sql
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in bodies.items())
    keyword = "WITH RECURSIVE" if "/*recursive*/" in sql else "WITH"
    if sql.lstrip().startswith(","):
        return f"{keyword} {ctes}{sql}"
    return f"{keyword} {ctes}\n{sql}"


def query(sql: str, *parts: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that checks it."""

    def keep(run: Query) -> Query:
        QUERIES[run.__name__] = run
        CHECKS[run.__name__] = with_parts(sql, *parts)
        return run

    return keep
