"""Registry-shaped views over the test tables.

The bodies run unchanged in Spark and in the checking database; ``{part}`` and
the like stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_master": """
        SELECT p_partkey AS filing_num, p_name AS name, p_type AS corp_type_id,
               p_size AS status_id
        FROM {part}""",
    "fx_officer": """
        SELECT l.l_partkey AS filing_num,
               CASE WHEN l.l_linenumber = 1 THEN concat(p.p_name, ' llc')
                    ELSE p.p_name END AS business_name
        FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_suppkey""",
    "fx_agent": """
        SELECT l.l_partkey AS filing_num, p.p_name AS business_name
        FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_suppkey
        WHERE l.l_returnflag = 'R'""",
    "fx_address": """
        SELECT c.c_custkey AS row_no,
               (SELECT max(p_partkey) FROM {part}) - c.c_custkey % 300 AS filing_num,
               concat('UNIT ', CAST(c.c_custkey % 40 AS VARCHAR(10)), ' ', c.c_mktsegment)
                 AS address1,
               n.n_name AS city,
               lpad(CAST(c.c_custkey % 20 AS VARCHAR(10)), 5, '0') AS zip_code,
               'US' AS country
        FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey""",
    "fx_roll": """
        SELECT c.c_custkey AS prop_id, p.p_name AS prop_owner,
               concat('UNIT ', CAST(c.c_custkey % 40 AS VARCHAR(10)), ' ', c.c_mktsegment)
                 AS mail_add_2,
               CAST(NULL AS VARCHAR(60)) AS mail_add_3, n.n_name AS mail_city,
               lpad(CAST(c.c_custkey % 20 AS VARCHAR(10)), 5, '0') AS mail_zip
        FROM {customer} c
        JOIN {part} p ON p.p_partkey = c.c_custkey
        JOIN {nation} n ON n.n_nationkey = c.c_nationkey""",
    "fx_link": """
        SELECT p_partkey AS unique_id, p_partkey AS filing_num, p_name AS name,
               p_brand AS brand, p_type AS city, p_size AS size
        FROM {part}""",
}

TABLES = ("part", "lineitem", "customer", "nation", "supplier", "orders")


_OPENED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; its footer is read once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(path)
    return _OPENED[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    body = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in body}
    return spark.sql(body, **used)


def view_sql(name: str) -> str:
    """The body as plain SQL over tables of the same names."""
    return VIEWS[name].format(**{t: t for t in TABLES})
