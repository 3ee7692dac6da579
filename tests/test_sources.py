"""Fixed-width files, layouts and code tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rollgraph.operators import lookups as lkp
from rollgraph.plans import graph_queries, source_queries
from rollgraph.plans.registry import QUERIES
from rollgraph.sources import codes, fixedwidth
from rollgraph.sources.layouts import (
    PROPERTY_ROLL,
    RECORD_LENGTH,
    RECORD_TYPES,
    Field,
    layout_fields,
)
from rollgraph.sources.tables import read_graph, read_registry, write_graph


def test_every_layout_fills_the_record():
    for code, (_, layout) in RECORD_TYPES.items():
        fields = layout_fields(layout)
        assert (fields[-1].end if fields else 0) == (0 if code == "04" else RECORD_LENGTH)
        assert len({f.name for f in fields}) == len(fields)
    assert len(PROPERTY_ROLL) == 31


def line(code, **values):
    out = ""
    for f in layout_fields(RECORD_TYPES[code][1]):
        width = f.end - f.start
        value = code if f.name == "layout_code" else values.get(f.name, "")
        out += value.rjust(width, "0") if f.kind in "ND" and f.name != "filler" else value.ljust(width)
    return out


def test_one_file_many_layouts(spark, tmp_path):
    lines = [
        line("02", filing_num="17", name="PEÑA & CO", formation_date="20010203", status_id="1"),
        line("03", filing_num="17", address1="1 MAIN", zip_code="00701"),
        line("02", filing_num="18", name="123", creation_date="19990101"),
        line("02", filing_num="19")[:-1],  # one character short
        "77" + " " * 558,  # no such layout
        line("99", all_9s="9" * 10, date_of_run="20200101", count_02="2", count_13="1"),
    ]
    path = tmp_path / "bulk.txt"
    path.write_bytes("\n".join(lines).encode("iso-8859-1") + b"\n")
    registry = fixedwidth.read_multi_layout(spark, str(path), date_fields=("creation_date",))
    master = registry.table("master")
    assert rows(master, "filing_num", "name", "formation_date", "creation_date", "dba_name") == [
        (17, "PEÑA & CO", datetime.date(2001, 2, 3), None, None),
        (18, "123", None, datetime.date(1999, 1, 1), None),
    ]
    assert rows(registry.table("address"), "address1", "zip_code") == [("1 MAIN", "00701")]
    assert registry.rejects.count() == 2
    assert set(registry.names) == {n for n, fields in RECORD_TYPES.values() if fields}
    counts = lkp.reconcile_totals(
        fixedwidth.layout_counts(fixedwidth.read_lines(spark, str(path))),
        registry.table("totals_log"),
    )
    got = {r["layout_code"]: (r["found"], r["announced"], r["agrees"]) for r in counts.collect()}
    assert got[2] == (2, 2, True) and got[3] == (1, 0, False) and got[99] == (1, 1, True)
    assert got[77] == (1, None, False) and got[5] == (0, 0, True)
    fixedwidth.write_tables(registry, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "master")).count() == 2
    parted = fixedwidth.split_layouts(spark, str(path), str(tmp_path / "parted"), date_fields=("creation_date",))
    for name in registry.names:
        assert rows(parted.table(name)) == rows(registry.table(name))
    assert rows(parted.rejects) == rows(registry.rejects)
    placed = parted.placed("master").orderBy(*fixedwidth.PLACE)
    assert [r["filing_num"] for r in placed.collect()] == [17, 18]
    plan = parted.table("master")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layout" in plan and "FileScan text" not in plan


def test_padding_again_gives_the_line_back(spark):
    text = line("02", filing_num="17", name="ACME", formation_date="20010203", status_id="3")
    lines = spark.createDataFrame([(text,)], "value string")
    parsed = fixedwidth.parse_layout(lines, "02", keep_filler=True)
    fields = layout_fields(RECORD_TYPES["02"][1])
    again = fixedwidth.render_layout(
        parsed, "02", {f.name: F.col(f.name) for f in fields if f.name != "filler"}
    )
    assert again.first()["value"] == text


def test_property_roll(spark, tmp_path):
    cells = {f.name: (f.start, f.end) for f in PROPERTY_ROLL}

    def record(**values):
        out = [" "] * 4480
        for name, value in values.items():
            start = cells[name][0]
            out[start : start + len(value)] = value
        return "".join(out)

    path = tmp_path / "PROP.TXT"
    lines = [
        record(prop_id="000000000012", prop_owner="peña llc", mail_zip="07001", unit_num="12"),
        record(prop_id="000000000013", prop_owner="nan"),
        "short",
    ]
    path.write_bytes("\n".join(lines).encode("iso-8859-1"))
    roll = fixedwidth.read_property_roll(spark, str(path))
    assert rows(roll, "prop_id", "prop_owner", "mail_zip", "unit_num") == [
        ("000000000012", "PEÑA LLC", "07001", "12"),
        ("000000000013", None, None, None),
        ("SHORT", None, None, None),
    ]
    keep = fixedwidth.read_fixed_width(
        spark, str(path), [Field("prop_owner", *cells["prop_owner"], "C")], sentinels=()
    )
    assert ("NAN",) in rows(keep)


def test_code_tables(spark, tmp_path):
    header = ",".join(codes.HEADER)
    first = ["1", "Open", "01", "Corp", "", "", "", "", "", "", "", "", "14", "T14", "d", "41", "T41", "d"]
    first += ["265", "14", "F1", "265", "41", "F2", "1", "ANDERSON"]
    second = ["", "", "2", '"Other, foreign"'] + [""] * 22
    path = tmp_path / "codes.csv"
    path.write_text("\n".join([header, ",".join(first), ",".join(second)]) + "\n")
    tables = codes.read_code_tables(spark, str(path))
    other = tmp_path / "other.csv"
    other.write_text(header.replace("status_id", "state_id", 1) + "\n")
    with pytest.raises(ValueError):
        codes.read_code_tables(spark, str(other))
    assert rows(tables["status"]) == [("1", "Open")]
    assert rows(tables["corp_type"]) == [("01", "Corp"), ("2", "Other, foreign")]
    assert tables["capacity"].count() == 0
    assert rows(tables["tables"], "table_id", "table_name") == [("14", "T14"), ("41", "T41")]
    audit = spark.createDataFrame(
        [(1, 14, 265), (2, 41, 265), (3, 9, 265)], "k int, table_id bigint, field_id bigint"
    )
    named = lkp.decode_audit(audit, tables["tables"], tables["fields"])
    assert rows(named, "k", "table_name", "field_name") == [
        (1, "T14", "F1"), (2, "T41", "F2"), (3, None, None),
    ]
    master = spark.createDataFrame([(1, 1), (2, 7), (3, None)], "k int, corp_type_id bigint")
    assert rows(lkp.decode(master, tables["corp_type"], "corp_type_id", "corp_type"), "k", "corp_type") == [
        (1, "Corp"), (2, None), (3, None),
    ]
    flags = spark.createDataFrame([(1, "1" + "0" * 253)], "k int, flags string")
    assert rows(lkp.explode_flags(flags, "flags", tables["county"], "county")) == [(1, 1, "ANDERSON")]


def test_graph_is_overwritten_and_scans_are_pruned(spark, tmp_path, frame):
    nodes = frame([("a", "A")], "id string, name string")
    edges = frame([("a", "a", "t"), ("a", "a", "s")], "src string, dst string, type string")
    for _ in range(2):
        write_graph({"business": nodes}, edges, str(tmp_path / "g"))
    back, back_edges = read_graph(spark, str(tmp_path / "g"), ["business"])
    assert rows(back["business"]) == rows(nodes) and rows(back_edges) == rows(edges)
    frame([(1, "A", "z")], "filing_num bigint, name string, other string").write.parquet(
        str(tmp_path / "reg" / "master")
    )
    scan = read_registry(spark, str(tmp_path / "reg"), "names")
    assert "other" not in scan._jdf.queryExecution().executedPlan().toString()
    assert rows(scan) == [("A", 1)]


def small_tables(spark, folder, n=3000):
    """``n`` lines of officers of ``n / 10`` businesses, and what goes with them."""
    k = F.col("id")
    tables = {
        "part": spark.range(n // 10).select(
            k.alias("p_partkey"), F.concat(F.lit("name "), k % 40).alias("p_name"), F.lit("ty").alias("p_type"),
            (k % 50).cast("int").alias("p_size"),
        ),
        "customer": spark.range(n // 10).select(
            k.alias("c_custkey"), F.concat(F.lit("c"), k).alias("c_name"), (k % 5).alias("c_nationkey"),
            F.lit("seg").alias("c_mktsegment"),
        ),
        "supplier": spark.range(n // 100).select(k.alias("s_suppkey"), F.concat(F.lit("s"), k).alias("s_name")),
        "orders": spark.range(n // 4).select(k.alias("o_orderkey"), (k % 300).alias("o_custkey")),
        "nation": spark.range(5).select(k.alias("n_nationkey"), F.concat(F.lit("n"), k).alias("n_name")),
        "lineitem": spark.range(n).select(
            (k % 300).alias("l_partkey"), (k % 30).alias("l_suppkey"), (k % 7).cast("int").alias("l_linenumber"),
            F.when(k % 3 == 0, "R").otherwise("N").alias("l_returnflag"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["bulk_file_layouts", "bulk_file_edges"])
def test_a_bulk_file_takes_little_disk(spark, tmp_path, monkeypatch, name):
    scratch = tmp_path / "scratch"
    for module in (source_queries, graph_queries):
        monkeypatch.setattr(module, "scratch_path", lambda spark, label: str(scratch))
    monkeypatch.setattr(fixedwidth, "LINES_PER_FILE", 500)
    sf = small_tables(spark, str(tmp_path / "sf"))
    kind = "type" if name == "bulk_file_edges" else "record_type"
    assert QUERIES[name](spark, sf).select(kind).distinct().count() > 3
    raw = fixedwidth.read_lines(spark, f"{scratch}/file").agg(F.sum(F.length("value") + 1)).first()[0]
    files = list((scratch / "file").glob("part-*"))
    used = sum(f.stat().st_size for f in scratch.rglob("part-*"))
    assert raw > 2_000_000 and used < raw / 8
    assert all(spark.read.text(str(f)).count() <= 500 for f in files[:3])


def test_lines_are_parted_without_a_sort_and_the_setting_is_put_back(spark, tmp_path):
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    lines = [line(code, filing_num=str(at)) for at in range(40) for code in ("02", "03", "07")] + ["none"]
    before = spark.conf.get(writers)
    fixedwidth.write_lines(spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1), str(tmp_path / "f"))
    parted = fixedwidth.split_layouts(spark, str(tmp_path / "f"), str(tmp_path / "p"))
    assert spark.conf.get(writers) == before
    assert parted.rejects.count() == 1
    for name in ("master", "address", "charter_officer_business"):
        placed = parted.placed(name).orderBy(*fixedwidth.PLACE)
        assert [r["filing_num"] for r in placed.collect()] == list(range(40))
