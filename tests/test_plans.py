"""What the plans must and must not contain."""

import pytest

from rollgraph.plans import graph_queries, link_queries, source_queries  # noqa: F401
from rollgraph.plans.registry import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize(
    "name",
    [
        "officer_edges", "property_owner_edges", "link_where", "merge_by_address_edges",
        "block_pairs_any_rule", "dedupe_names", "dedupe_addresses", "county_flags",
    ],
)
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["find_business"](spark, SF))
    assert "EqualTo(p_name,red widget)" in text
    scan = plan(QUERIES["registry_scan"](spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in scan


def test_names_are_aggregated_before_the_shuffle(spark):
    text = plan(QUERIES["name_index"](spark, SF))
    assert "partial_max" in text and text.count("Exchange") == 1
