"""Source, lookup and scalar queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.functions import columns as fn
from rollgraph.operators import lookups as lkp
from rollgraph.operators import select as sel
from rollgraph.operators.addresses import with_canonical
from rollgraph.plans.fixtures import table, view
from rollgraph.plans.registry import query
from rollgraph.session import scratch_path
from rollgraph.sources import codes, fixedwidth
from rollgraph.sources.layouts import PROPERTY_ROLL, Field
from rollgraph.sources.tables import read_table


@query("SELECT p_partkey, p_name FROM part")
def registry_scan(spark, sf) -> DataFrame:
    return read_table(spark, sf, "part", ["p_partkey", "p_name"], suffix=".parquet")


@query("SELECT filing_num AS id, name AS title FROM fx_master", "fx_master")
def rename_all(spark, sf) -> DataFrame:
    return sel.rename_all(
        sel.project(view(spark, sf, "fx_master"), ["filing_num", "name"]), ["id", "title"]
    )


@query("SELECT filing_num, name FROM fx_master ORDER BY filing_num LIMIT 50000", "fx_master")
def sample_rows(spark, sf) -> DataFrame:
    names = view(spark, sf, "fx_master").select("filing_num", "name")
    return sel.sample_rows(names, 50_000, ["filing_num"])


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey DESC, o_orderkey LIMIT 12000")
def sample_orders(spark, sf) -> DataFrame:
    """A sample of fewer rows than there are, too long for one task."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return sel.sample_rows(orders, 12_000, [F.desc("o_custkey"), F.asc("o_orderkey")])


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> ''")
def non_empty(spark, sf) -> DataFrame:
    priorities = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return priorities.where(sel.non_empty(F.col("o_orderpriority")))


@query(
    "SELECT row_no, address1, city FROM fx_address WHERE zip_code = '00007' AND city = 'NATION_3'",
    "fx_address",
)
def match_props(spark, sf) -> DataFrame:
    return sel.match_props(
        view(spark, sf, "fx_address"), zip_code="00007", city="NATION_3"
    ).select("row_no", "address1", "city")


# Fixed-width lines made of parts: key, name, type; one name stands for "missing".
_SLICES = [Field("key", 0, 12, "C"), Field("name", 12, 52, "C"), Field("kind", 52, 68, "C")]


@query(
    "SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS key, "
    "CASE WHEN p_name <> 'red widget' THEN upper(p_name) END AS name, p_type AS kind FROM part"
)
def fixed_width_lines(spark, sf) -> DataFrame:
    lines = table(spark, sf, "part").select(
        F.concat(
            F.lpad(F.col("p_partkey").cast("string"), 12, "0"),
            F.rpad(F.when(F.col("p_name") == "red widget", "nan").otherwise(F.col("p_name")), 40, " "),
            F.rpad("p_type", 16, " "),
        ).alias("value")
    )
    return fixedwidth.parse_fixed_width(lines, _SLICES)


def _formed(key):
    return F.when(F.col("p_size") > 9, F.date_add(F.lit("2000-01-01").cast("date"), F.col(key).cast("int")))


def _bulk_lines(spark, sf):
    """One file with masters, addresses, officers, lines of no layout and a trailer."""
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    masters = fixedwidth.render_layout(
        part.withColumn("formed", _formed("p_partkey")),
        "02",
        {
            "filing_num": F.col("p_partkey"),
            "status_id": F.col("p_size"),
            "name": F.upper("p_name"),
            "formation_date": F.col("formed"),
            "foreign_state": F.substring("p_type", 1, 2),
        },
    )
    places = fixedwidth.render_layout(
        customer,
        "03",
        {
            "filing_num": F.col("c_custkey"),
            "address1": F.col("c_name"),
            "city": F.col("c_mktsegment"),
            "zip_code": F.lpad(F.col("c_nationkey").cast("string"), 5, "0"),
        },
    )
    officers = fixedwidth.render_layout(
        table(spark, sf, "lineitem"),
        "07",
        {
            "filing_num": F.col("l_partkey"),
            "officer_id": F.col("l_linenumber"),
            "officer_title": F.col("l_returnflag"),
            "business_name": F.concat(F.lit("SUPPLIER "), F.col("l_suppkey").cast("string")),
        },
    )
    strays = table(spark, sf, "supplier").select(F.concat(F.lit("02"), "s_name").alias("value"))
    lines = masters.unionByName(places).unionByName(officers).unionByName(strays)
    # Exploded so that cutting a line does not build the line again per field.
    return lines.select(F.explode(F.array("value")).alias("value"))


@query(
    "SELECT 2 AS layout_code, p_partkey AS filing_num, CAST(p_size AS BIGINT) AS status_id, "
    "upper(p_name) AS name, 0 AS creation_date, "
    "CASE WHEN p_size > 9 THEN DATE '2000-01-01' + CAST(p_partkey AS INTEGER) END "
    "AS formation_date, substr(p_type, 1, 2) AS foreign_state, CAST(NULL AS VARCHAR) AS dba_name "
    "FROM part"
)
def multi_layout_master(spark, sf) -> DataFrame:
    master = fixedwidth.parse_multi_layout(_bulk_lines(spark, sf)).table("master")
    return master.select(
        "layout_code", "filing_num", "status_id", "name", "creation_date", "formation_date",
        "foreign_state", "dba_name",
    )


@query(
    "SELECT c_custkey AS filing_num, c_name AS address1, CAST(NULL AS VARCHAR) AS address2, "
    "c_mktsegment AS city, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code FROM customer"
)
def multi_layout_address(spark, sf) -> DataFrame:
    address = fixedwidth.parse_multi_layout(_bulk_lines(spark, sf)).table("address")
    return address.select("filing_num", "address1", "address2", "city", "zip_code")


@query(
    "SELECT l_partkey AS filing_num, CAST(l_linenumber AS BIGINT) AS officer_id, "
    "l_returnflag AS officer_title, 'SUPPLIER ' || l_suppkey AS business_name FROM lineitem"
)
def multi_layout_officer(spark, sf) -> DataFrame:
    registry = fixedwidth.parse_multi_layout(_bulk_lines(spark, sf))
    return registry.table("charter_officer_business").select(
        "filing_num", "officer_id", "officer_title", "business_name"
    )


@query("SELECT '02' || s_name AS value FROM supplier")
def multi_layout_rejects(spark, sf) -> DataFrame:
    return fixedwidth.parse_multi_layout(_bulk_lines(spark, sf)).rejects


@query(
    "SELECT CAST(code AS BIGINT) AS layout_code, CAST(found AS BIGINT) AS found, "
    "CAST(announced AS BIGINT) AS announced, found = announced AS agrees FROM ("
    "SELECT 2 AS code, (SELECT count(*) FROM part) AS found, "
    "(SELECT count(*) FROM part) AS announced "
    "UNION ALL SELECT 3, (SELECT count(*) FROM customer), (SELECT count(*) FROM customer) "
    "UNION ALL SELECT 7, (SELECT count(*) FROM lineitem), (SELECT count(*) FROM orders) "
    "UNION ALL SELECT 99, 1, 1 "
    "UNION ALL SELECT * FROM (VALUES (1, 0, 0), (4, 0, 0), (5, 0, 0), (6, 0, 0), (8, 0, 0), "
    "(9, 0, 0), (10, 0, 0), (11, 0, 0), (12, 0, 0)))"
)
def reconcile_totals(spark, sf) -> DataFrame:
    lines = _bulk_lines(spark, sf)
    counts = spark.sql(
        "SELECT (SELECT count(*) FROM {part}) AS n_02, (SELECT count(*) FROM {customer}) AS n_03, "
        "(SELECT count(*) FROM {orders}) AS n_07",
        part=table(spark, sf, "part"),
        customer=table(spark, sf, "customer"),
        orders=table(spark, sf, "orders"),
    )
    trailer = fixedwidth.render_layout(
        counts,
        "99",
        {"all_9s": F.lit("9" * 10), "count_02": F.col("n_02"), "count_03": F.col("n_03"),
         "count_07": F.col("n_07"), "count_13": F.lit(1)},
    )
    file = lines.unionByName(trailer)
    totals = fixedwidth.parse_multi_layout(file).table("totals_log")
    return lkp.reconcile_totals(fixedwidth.layout_counts(file), totals)


# Layouts that the lines above lack, with the table that fills each and its key.
_OTHERS = {
    "01": ("delete_all_log", "nation", "n_nationkey"),
    "05": ("registered_agent_business", "supplier", "s_suppkey"),
    "06": ("registered_agent_personal", "customer", "c_custkey"),
    "08": ("charter_officer_personal", "part", "p_partkey"),
    "09": ("charter_names", "orders", "o_orderkey"),
    "10": ("associated_entity", "supplier", "s_suppkey"),
    "11": ("filing_hist", "orders", "o_custkey"),
    "12": ("audit_log", "customer", "c_nationkey"),
}
_FILLED = {
    **{name: (of, key) for name, of, key in _OTHERS.values()},
    "master": ("part", "p_partkey"),
    "address": ("customer", "c_custkey"),
    "charter_officer_business": ("lineitem", "l_partkey"),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS record_type, count(*) AS n, CAST(sum({key}) AS BIGINT) AS filings FROM {of}"
        for name, (of, key) in _FILLED.items()
    )
    + " UNION ALL SELECT 'totals_log', 1, 9999999999"
    + " UNION ALL SELECT 'rejects', count(*), CAST(sum(length(s_name)) + 2 * count(*) AS BIGINT) FROM supplier"
)
def bulk_file_layouts(spark, sf) -> DataFrame:
    """All layouts of a bulk file: written as text, parted in one scan, read back."""
    path = scratch_path(spark, "bulk")
    lines = _bulk_lines(spark, sf)
    for code, (_, of, key) in _OTHERS.items():
        lines = lines.unionByName(fixedwidth.render_layout(table(spark, sf, of), code, {"filing_num": F.col(key)}))
    trailer = fixedwidth.render_layout(spark.range(1), "99", {"all_9s": F.lit("9" * 10)})
    fixedwidth.write_lines(lines.unionByName(trailer), f"{path}/file")
    registry = fixedwidth.split_layouts(spark, f"{path}/file", f"{path}/parted")
    out = registry.rejects.select(F.lit("rejects").alias("record_type"), F.length("value").cast("long").alias("filing"))
    for name in registry.names:
        key = "all_9s" if name == "totals_log" else "filing_num"
        out = out.unionByName(registry.table(name).select(F.lit(name).alias("record_type"), F.col(key).alias("filing")))
    return out.groupBy("record_type").agg(F.count(F.lit(1)).alias("n"), F.sum("filing").alias("filings"))


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS prop_id, upper(c_name) AS prop_owner, upper(c_mktsegment) AS mail_city, "
    "lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS mail_zip, CAST(NULL AS VARCHAR) AS dba FROM customer"
)
def property_roll_file(spark, sf) -> DataFrame:
    """The property roll, written as a text file of its own slices and read back."""
    values = {
        "prop_id": F.col("c_custkey").cast("string"), "prop_owner": F.col("c_name"),
        "mail_city": F.col("c_mktsegment"), "mail_zip": F.lpad(F.col("c_nationkey").cast("string"), 5, "0"),
    }
    parts, at = [], 0
    for field in sorted(PROPERTY_ROLL, key=lambda f: f.start):
        width = field.end - field.start
        parts += [F.lit(" " * (field.start - at)), F.rpad(values.get(field.name, F.lit("")), width, " ")]
        at = field.end
    path = scratch_path(spark, "roll")
    fixedwidth.write_lines(table(spark, sf, "customer").select(F.concat(*parts).alias("value")), path)
    roll = fixedwidth.read_property_roll(spark, path)
    return roll.select("prop_id", "prop_owner", "mail_city", "mail_zip", F.col("DBA").alias("dba"))


def _packed(spark, sf):
    """Code tables side by side, of different lengths, made of parts."""
    part = table(spark, sf, "part")
    made = {name: F.lit(None).cast("string") for name in codes.CSV_COLUMNS}

    def fill(name, value, when):
        made[name] = F.when(when, value.cast("string"))

    small, large = F.col("p_size") <= 25, F.col("p_size") > 25
    fill("status_id", F.col("p_partkey"), small)
    fill("status_description", F.col("p_name"), small)
    fill("corp_type_id", F.col("p_partkey"), F.lit(True))
    fill("corp_type", F.concat("p_brand", F.lit(", "), "p_type"), F.lit(True))
    fill("selected_county_array", F.col("p_partkey"), large)
    fill("county_name", F.upper("p_name"), large)
    fill("table_id_1", F.col("p_partkey"), small)
    fill("table_name_1", F.col("p_type"), small)
    fill("table_id_2", -F.col("p_partkey") - 1, large)
    fill("table_name_2", F.col("p_brand"), large)
    fill("field_id_1", F.col("p_partkey"), small)
    fill("table_id_3", F.col("p_size"), small)
    fill("field_name_1", F.col("p_name"), small)
    fill("field_id_2", F.col("p_partkey"), F.lit(True))
    fill("table_id_4", F.col("p_size") + 50, F.lit(True))
    fill("field_name_2", F.col("p_brand"), F.lit(True))
    return part.select(*[c.alias(name) for name, c in made.items()])


@query(
    "SELECT 'status' AS domain, CAST(p_partkey AS VARCHAR) AS code, p_name AS label FROM part "
    "WHERE p_size <= 25 "
    "UNION ALL SELECT 'corp_type', CAST(p_partkey AS VARCHAR), p_brand || ', ' || p_type FROM part "
    "UNION ALL SELECT 'county', CAST(p_partkey AS VARCHAR), upper(p_name) FROM part WHERE p_size > 25 "
    "UNION ALL SELECT 'tables', CAST(p_partkey AS VARCHAR), p_type FROM part WHERE p_size <= 25 "
    "UNION ALL SELECT 'tables', CAST(-p_partkey - 1 AS VARCHAR), p_brand FROM part WHERE p_size > 25 "
    "UNION ALL SELECT 'fields', p_size || '.' || p_partkey, p_name FROM part WHERE p_size <= 25 "
    "UNION ALL SELECT 'fields', (p_size + 50) || '.' || p_partkey, p_brand FROM part"
)
def code_tables(spark, sf) -> DataFrame:
    path = scratch_path(spark, "codes")
    _packed(spark, sf).write.csv(path, header=True)
    tables = codes.read_code_tables(spark, path)
    parts = [
        tables[domain].select(F.lit(domain).alias("domain"), "code", "label")
        for domain in codes.DOMAINS
    ]
    parts.append(
        tables["tables"].select(
            F.lit("tables").alias("domain"),
            F.col("table_id").alias("code"),
            F.col("table_name").alias("label"),
        )
    )
    parts.append(
        tables["fields"].select(
            F.lit("fields").alias("domain"),
            F.concat_ws(".", "table_id", "field_id").alias("code"),
            F.col("field_name").alias("label"),
        )
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "SELECT m.filing_num, m.status_id, n.n_name AS status_description FROM fx_master m "
    "LEFT JOIN nation n ON n.n_nationkey = m.status_id",
    "fx_master",
)
def decode(spark, sf) -> DataFrame:
    labels = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )
    master = view(spark, sf, "fx_master").select("filing_num", "status_id")
    return lkp.decode(master, labels, "status_id", "status_description")


@query(
    "SELECT l_orderkey, l_linenumber AS table_id, CAST(l_quantity AS BIGINT) AS field_id, "
    "t.r_name AS table_name, f.n_name AS field_name FROM lineitem "
    "LEFT JOIN region t ON t.r_regionkey = l_linenumber "
    "LEFT JOIN nation f ON f.n_regionkey = l_linenumber "
    "AND f.n_nationkey = CAST(l_quantity AS BIGINT)"
)
def decode_audit(spark, sf) -> DataFrame:
    audit = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("table_id"),
        F.col("l_quantity").cast("bigint").alias("field_id"),
    )
    tables = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("string").alias("table_id"), F.col("r_name").alias("table_name")
    )
    fields = table(spark, sf, "nation").select(
        F.col("n_regionkey").cast("string").alias("table_id"),
        F.col("n_nationkey").cast("string").alias("field_id"),
        F.col("n_name").alias("field_name"),
    )
    return lkp.decode_audit(audit, tables, fields)


@query(
    "SELECT c_custkey, CAST(n.n_nationkey + 1 AS INTEGER) AS position, n.n_name AS county "
    "FROM customer c JOIN nation n ON n.n_nationkey IN (c.c_nationkey, c.c_custkey % 25)"
)
def county_flags(spark, sf) -> DataFrame:
    at = (F.col("c_custkey") % 25).cast("int")
    nation = F.col("c_nationkey")
    flags = F.concat(
        F.expr("repeat('0', least(c_nationkey, int(c_custkey % 25)))"),
        F.lit("1"),
        F.when(
            nation != at,
            F.concat(F.expr("repeat('0', abs(c_nationkey - int(c_custkey % 25)) - 1)"), F.lit("1")),
        ).otherwise(F.lit("")),
    )
    filings = table(spark, sf, "customer").select("c_custkey", F.rpad(flags, 254, "0").alias("flags"))
    counties = table(spark, sf, "nation").select(
        (F.col("n_nationkey") + 1).cast("string").alias("code"), F.col("n_name").alias("label")
    )
    return lkp.explode_flags(filings, "flags", counties, "county")


@query(
    "SELECT row_no, concat_ws(chr(10), upper(address1), city, zip_code, country) AS pa "
    "FROM fx_address",
    "fx_address",
)
def canonical_address(spark, sf) -> DataFrame:
    return with_canonical(view(spark, sf, "fx_address")).select("row_no", "pa")


LONG_CODES = "SELECT *, zip_code || ' ' || CAST(row_no % 7 AS VARCHAR(2)) || 'ab' AS long_code FROM fx_address"


@query(
    f"SELECT upper(long_code) AS code, concat_ws(chr(10), upper(address1), city, upper(long_code), country) "
    f"AS pa, count(*) AS n FROM ({LONG_CODES}) GROUP BY 1, 2",
    "fx_address",
)
def canonical_long_codes(spark, sf) -> DataFrame:
    """Codes that differ behind the fifth character stay different addresses."""
    rows = view(spark, sf, "fx_address")
    code = F.concat("zip_code", F.lit(" "), (F.col("row_no") % 7).cast("string"), F.lit("ab"))
    shown = with_canonical(rows.withColumn("zip_code", code))
    return shown.groupBy(F.upper("zip_code").alias("code"), "pa").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, "
    "o_orderpriority || CAST(o_orderkey AS VARCHAR) AS joined_key, "
    "md5(concat_ws('|', 'Order', '=' || o_orderkey)) AS stable_id, o_orderkey AS padded_number, "
    "CAST(o_orderdate AS DATE) AS padded_date, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS sentinel_to_null, "
    "substr(o_orderpriority, 3, 2) AS cut, o_orderpriority AS blank_to_null FROM orders"
)
def scalar_functions(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        fn.as_text(F.col("o_orderkey")).alias("as_text"),
        fn.joined_key(F.col("o_orderpriority"), F.col("o_orderkey")).alias("joined_key"),
        fn.stable_id("Order", F.col("o_orderkey")).alias("stable_id"),
        fn.padded_number(F.lpad(F.col("o_orderkey").cast("string"), 14, "0")).alias("padded_number"),
        fn.padded_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("padded_date"),
        fn.sentinel_to_null(F.col("o_orderstatus"), ("P",)).alias("sentinel_to_null"),
        fn.cut(F.col("o_orderpriority"), 2, 4).alias("cut"),
        fn.blank_to_null(F.rpad("o_orderpriority", 40, " ")).alias("blank_to_null"),
    )


# The check spells the sound code out: letters to digits, H and W skipped, runs
# of one digit once, vowels dropped.
_DIGITS = (
    "translate(upper(p_name), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ ', '012301270224550126230172020')"
)
_RUNS = "substr(d, 1, 1) || replace(substr(d, 2), '7', '')"
for _digit in "123456":
    _RUNS = f"regexp_replace({_RUNS}, '{_digit}+', '{_digit}', 'g')"


@query(
    f"SELECT p_partkey, rpad(substr(upper(p_name), 1, 1) || replace(substr({_RUNS}, 2), '0', ''), "
    f"4, '0') AS phonetic FROM (SELECT p_partkey, p_name, {_DIGITS} AS d FROM part)"
)
def phonetic_key(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", fn.phonetic_key(F.col("p_name")).alias("phonetic")
    )
