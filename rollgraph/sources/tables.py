"""Column-pruned table scans and the graph sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns each step of the graph build and the linkage reads.
SCANS = {
    "names": ("master", ("name", "filing_num")),
    "corp_types": ("master", ("filing_num", "corp_type_id")),
    "officers": ("charter_officer_business", ("filing_num", "business_name")),
    "agents": ("registered_agent_business", ("filing_num", "business_name")),
    "addresses": (
        "address",
        (
            "filing_num", "address1", "address2", "city", "state",
            "zip_code", "zip_extension", "country",
        ),
    ),
    "link_names": ("master", ("filing_num", "name")),
    "link_addresses": ("address", ("filing_num", "address1", "zip_code", "city")),
}


def read_table(
    spark: SparkSession,
    root: str | dict,
    table: str,
    columns: Sequence[str],
    suffix: str = "",
    tagged: bool = False,
) -> DataFrame:
    """Named columns of a table below a folder, or of a database by JDBC options.

    ``tagged`` adds ``_row``, a number per row of the files, so that a skewed
    join can spread even full copies of one row.  Give the JDBC options ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` to let the executors read a database side by side.
    """
    if isinstance(root, dict):
        df = spark.read.format("jdbc").options(dbtable=table, **root).load()
    else:
        df = spark.read.parquet(f"{root.rstrip('/')}/{table}{suffix}")
        if tagged:
            place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
            return df.select(*columns, place.alias("_row"))
    return df.select(*columns)


def read_registry(spark: SparkSession, root: str | dict, scan: str) -> DataFrame:
    """One of the scans of ``SCANS``."""
    table, columns = SCANS[scan]
    return read_table(spark, root, table, columns)


def write_graph(nodes: dict[str, DataFrame], edges: DataFrame, path: str) -> None:
    """Overwrite the node tables and the edge table below ``path``.

    Edges are partitioned by kind (four values).  A rerun replaces the graph.
    """
    for label, df in nodes.items():
        df.write.mode("overwrite").parquet(f"{path}/nodes_{label}")
    edges.write.mode("overwrite").partitionBy("type").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str, labels: Sequence[str]) -> tuple[dict, DataFrame]:
    """The tables written by ``write_graph``."""
    nodes = {label: spark.read.parquet(f"{path}/nodes_{label}") for label in labels}
    return nodes, spark.read.parquet(f"{path}/edges").select("src", "dst", "type")
