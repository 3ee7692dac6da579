"""Index, links, addresses and properties on the awkward rows."""

from pyspark.sql import functions as F

from conftest import rows
from rollgraph.operators import addresses as adr
from rollgraph.operators import index as idx
from rollgraph.operators import links as lnk
from rollgraph.operators import select as sel
from rollgraph.plans.graph import build_graph

MASTER = [
    ("ACME", 1, "10"),
    ("ACME", 2, "11"),  # loses nothing: the greater filing wins the name
    ("BOLT", 3, None),
    (None, 4, "12"),
    (None, 5, "13"),
    ("CARGO", 6, "14"),
    ("DELTA", 6, "15"),  # two names, one filing
]


def master(frame):
    return frame(MASTER, "name string, filing_num bigint, corp_type_id string")


def graph(frame):
    index = idx.name_index(master(frame))
    return index, idx.business_nodes(index)


def test_name_index_keeps_the_last_filing_and_the_null_name(frame):
    index, nodes = graph(frame)
    assert rows(index) == [("ACME", 2), ("BOLT", 3), ("CARGO", 6), ("DELTA", 6), (None, 5)]
    assert nodes.select("id").distinct().count() == 5


def test_name_index_by_another_order(frame):
    scan = frame([("A", 5, 1), ("A", 2, 9)], "name string, filing_num bigint, seen int")
    assert rows(idx.name_index(scan, "seen")) == [("A", 2)]


def officers(frame):
    return frame(
        [
            (1, "BOLT"),  # filing 1 leads to the node of filing 2
            (3, "BOLT"),  # its own officer
            (3, "BOLT"),  # again
            (4, "ACME"),  # company without a name
            (3, None),  # officer without a name
            (3, "NOBODY"),  # unknown officer
            (99, "ACME"),  # unknown company
            (3, "CARGO"),  # a filing with two nodes
        ],
        "filing_num bigint, business_name string",
    )


def test_edges_step_by_step_and_at_once_agree(frame):
    index, nodes = graph(frame)
    links = lnk.officer_links(master(frame), officers(frame))
    stepwise = lnk.match_endpoints(lnk.resolve_names(links, index), nodes, lnk.OFFICER)
    at_once = lnk.build_officer_edges(master(frame), officers(frame), index, nodes)
    assert rows(stepwise) == rows(at_once, "src", "dst", "type")
    ids = {r["name"]: r["id"] for r in nodes.collect()}
    got = [(s, d) for s, d, _ in rows(stepwise)]
    assert got.count((ids["BOLT"], ids["ACME"])) == 1
    assert got.count((ids["BOLT"], ids["BOLT"])) == 2
    assert got.count((ids["ACME"], ids[None])) == 1
    assert got.count((ids[None], ids["BOLT"])) == 1
    assert got.count((ids["CARGO"], ids["BOLT"])) == 1
    assert got.count((ids["DELTA"], ids["BOLT"])) == 1
    assert len(got) == 7


def test_unresolved_links_are_the_rows_that_make_no_edge(frame):
    index, _ = graph(frame)
    links = lnk.officer_links(master(frame), officers(frame))
    missed = lnk.unresolved_links(links, index)
    assert rows(missed, "business_name") == [("NOBODY",)]
    resolved = lnk.resolve_names(links, index)
    assert resolved.count() + missed.count() == links.count()


def test_heavy_keys_change_nothing_but_the_placement(frame, monkeypatch):
    index, nodes = graph(frame)
    many = officers(frame).crossJoin(frame([(i,) for i in range(50)], "n int")).drop("n")
    plain = rows(lnk.build_officer_edges(master(frame), many, index, nodes))
    from rollgraph.operators import skew

    monkeypatch.setattr(skew.heavy_from_counts, "__defaults__", (7,))
    monkeypatch.setattr(skew.heavy_keys, "__defaults__", (7,))
    assert skew.heavy_keys(many, ["business_name"]).count() > 3
    assert rows(lnk.build_officer_edges(master(frame), many, index, nodes)) == plain


def test_update_property_keeps_sets_and_clears(frame):
    nodes = frame([("a", 1, "old"), ("b", 2, "old"), ("c", 2, "x")], "id string, filing_num bigint, t string")
    values = frame(
        [(1, None, 1), (2, 7, 1), (2, 8, 2), (3, 9, 1), (None, 5, 1)],
        "filing_num bigint, t int, seq int",
    )
    got = idx.update_property(nodes, values, "filing_num", "t", "seq")
    assert rows(got) == [("a", 1, None), ("b", 2, "8"), ("c", 2, "8")]
    untouched = idx.update_property(nodes, values.limit(0), "filing_num", "t", "seq")
    assert rows(untouched) == rows(nodes)


def addresses(frame):
    return frame(
        [
            (1, 2, "1 MAIN ST", "WACO", "76701-0000", "G1"),
            (2, 3, "1  main st ", "Waco", "76701", "G1"),
            (3, 3, "9 OAK", "WACO", None, None),
            (4, 1, "5 ELM", "WACO", "76701", "G2"),  # filing 1 lost its name
            (5, 6, "5 ELM", "WACO", "76701", "G3"),  # two nodes at filing 6
        ],
        "row_no int, filing_num bigint, address1 string, city string, zip_code string, gp string",
    ).withColumn("country", F.lit("US"))


def test_address_graph(frame):
    _, nodes = graph(frame)
    keyed = adr.with_canonical(addresses(frame))
    made = adr.build_address_edges(keyed, nodes, ["row_no"], "gp")
    assert rows(made.nodes, "gp", "address1") == [("G1", "1  main st "), ("G3", "5 ELM")]
    assert made.edges.count() == 4
    assert rows(made.rejects, "row_no") == [(3,)]
    by_pa = adr.build_address_edges(keyed, nodes, ["row_no"])
    # The whole postal code counts: 76701-0000 and 76701 are two addresses.
    assert by_pa.nodes.count() == 4 and by_pa.rejects.count() == 0
    ends = by_pa.edges.join(by_pa.nodes, by_pa.edges["dst"] == by_pa.nodes["id"], "left_anti")
    assert ends.count() == 0


def test_last_address_wins_as_a_unit_nulls_included(frame):
    got = adr.address_nodes(
        frame(
            [("G", 1, "A", "X"), ("G", 2, "B", None)],
            "gp string, row_no int, address1 string, city string",
        ),
        "gp",
        ["row_no"],
    )
    assert rows(got, "address1", "city") == [("B", None)]


def test_property_owner_edges(frame):
    index, nodes = graph(frame)
    places = adr.build_address_edges(
        adr.with_canonical(addresses(frame)), nodes, ["row_no"]
    ).nodes
    roll = frame(
        [
            ("BOLT", "1 Main St", None, "WACO", "76701"),
            ("BOLT", "1 Main St", "UNIT 2", "WACO", "76701"),  # second line: no match
            ("CARGO", "9 OAK", "", "WACO", ""),
            (None, "1 Main St", None, "WACO", "76701"),
            ("NOBODY", "1 Main St", None, "WACO", "76701"),
        ],
        "prop_owner string, mail_add_2 string, mail_add_3 string, mail_city string, mail_zip string",
    )
    edges = adr.build_property_owner_edges(roll, idx.name_to_nodes(index, nodes), places)
    assert edges.count() == 3  # BOLT once; filing 6 has two nodes


def test_link_where_is_the_product(frame):
    left = frame([("b",), ("c",)], "id string")
    right = frame([(f"a{i}",) for i in range(7)], "id string")
    got = adr.link_where(left, right, rows_per_cell=1)
    assert rows(got, "src", "dst") == sorted(
        (s, f"a{i}") for s in "bc" for i in range(7)
    )
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_addresses_from_property_are_not_shared(frame):
    nodes = frame(
        [("a", "1 MAIN", "1"), ("b", "1 MAIN", "1"), ("c", "", "1"), ("d", None, "1")],
        "id string, address1 string, zip_code string",
    )
    made = adr.addresses_from_property(nodes)
    assert made.nodes.select("id").distinct().count() == 2
    assert rows(made.edges, "src") == [("a",), ("b",)]
    assert rows(made.rejects, "id") == [("c",), ("d",)]


def test_small_views(frame, monkeypatch):
    df = frame([(i, "x" if i % 2 else None) for i in range(6)], "k int, v string")
    assert rows(sel.top_rows(df, [F.desc("k")], 2), "k") == [(4,), (5,)]
    assert rows(sel.sample_rows(df, 2, ["k"]), "k") == [(0,), (1,)]
    monkeypatch.setattr(sel, "TOP", 1)
    long = sel.sample_rows(df, 3, [F.desc("k")])
    assert "TakeOrdered" not in long._jdf.queryExecution().toString()
    last = sorted(r[0] for r in df.select("k").collect())
    for n in (2, 3, 100):
        assert [k for (k,) in rows(sel.sample_rows(df, n, [F.desc("k")]), "k")] == last[-n:]
    assert sel.sample_rows(df.where("k < 0"), 3, ["k"]).count() == 0
    assert sel.match_props(df, k=1, v="x").count() == 1
    assert sel.gate_on_total(df, 5).count() == 6 and sel.gate_on_total(df, 6).count() == 0
    assert idx.find_business(frame([("A",), ("A",), ("B",)], "name string"), "A").count() == 2


def test_whole_graph_has_both_ends_of_every_edge(frame):
    agents = frame([(3, "ACME"), (2, "BOLT")], "filing_num bigint, business_name string")
    made = build_graph(master(frame), officers(frame), agents, addresses(frame).drop("gp"))
    ids = made.business.select("id").unionByName(made.address.select("id"))
    for end in ("src", "dst"):
        ends = made.edges.select(F.col(end).alias("id"))
        assert ends.join(ids, "id", "left_anti").count() == 0
    types = {r["name"]: r["corp_type_id"] for r in made.business.collect()}
    assert types == {"ACME": "11", "BOLT": None, None: "13", "CARGO": "15", "DELTA": "15"}


def test_copies_of_one_row_are_spread_by_their_place(spark, frame, tmp_path, monkeypatch):
    from rollgraph.operators import skew
    from rollgraph.sources.tables import read_table

    monkeypatch.setattr(skew.heavy_keys, "__defaults__", (7,))
    index, nodes = graph(frame)
    copies = officers(frame).limit(1).crossJoin(frame([(i,) for i in range(40)], "n int")).drop("n")
    copies.write.parquet(str(tmp_path / "officer"))
    tagged = read_table(spark, str(tmp_path), "officer", ["filing_num", "business_name"], tagged=True)
    assert tagged.select("_row").distinct().count() == 40
    edges = lnk.build_officer_edges(master(frame), tagged, index, nodes)
    assert edges.count() == 40
    assert edges.columns == ["src", "dst", "type", "src_name", "dst_name"]
