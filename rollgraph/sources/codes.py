"""Code tables that share one CSV side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The header of the CSV.
HEADER = (
    "status_id", "status_description",
    "corp_type_id", "corp_type",
    "nonprofit_subtype_id", "description_n",
    "name_status_id", "status",
    "name_type_id", "name_description",
    "capacity_id", "corp_type_id_description",
    "table_id", "table_name", "description_t",
    "table_id", "table_name", "description_tn",
    "field_id", "table_id", "field_name",
    "field_id", "table_id", "field_name",
    "selected_county_array", "county_name",
)

# A name that repeats is numbered in file order.
CSV_COLUMNS = tuple(
    f"{name}_{HEADER[: i + 1].count(name)}" if HEADER.count(name) > 1 else name for i, name in enumerate(HEADER)
)

# Code and label column of each domain.
DOMAINS = {
    "status": ("status_id", "status_description"),
    "corp_type": ("corp_type_id", "corp_type"),
    "nonprofit_subtype": ("nonprofit_subtype_id", "description_n"),
    "name_status": ("name_status_id", "status"),
    "name_type": ("name_type_id", "name_description"),
    "capacity": ("capacity_id", "corp_type_id_description"),
    "county": ("selected_county_array", "county_name"),
}

# Registry columns that carry a code, by record type.
CODED_COLUMNS = {
    "master": {
        "status_id": "status",
        "corp_type_id": "corp_type",
        "nonprofit_subtype_id": "nonprofit_subtype",
    },
    "charter_names": {"name_status_id": "name_status", "name_type_id": "name_type"},
    "associated_entity": {"capacity_id": "capacity"},
}

SCHEMA = StructType([StructField(name, StringType()) for name in CSV_COLUMNS])


def unpack_code_tables(packed: DataFrame) -> dict[str, DataFrame]:
    """Tables (code, label) by domain; ``tables`` and ``fields`` for the audit log."""
    tables = {
        domain: packed.select(F.col(code).alias("code"), F.col(label).alias("label")).where(
            F.col("code").isNotNull()
        )
        for domain, (code, label) in DOMAINS.items()
    }

    def block(columns: dict[str, str]) -> DataFrame:
        picked = packed.select(*[F.col(c).alias(name) for name, c in columns.items()])
        return picked.where(F.col(next(iter(columns))).isNotNull())

    tables["tables"] = block(
        {"table_id": "table_id_1", "table_name": "table_name_1", "description": "description_t"}
    ).unionByName(block({"table_id": "table_id_2", "table_name": "table_name_2", "description": "description_tn"}))
    tables["fields"] = block(
        {"field_id": "field_id_1", "table_id": "table_id_3", "field_name": "field_name_1"}
    ).unionByName(block({"field_id": "field_id_2", "table_id": "table_id_4", "field_name": "field_name_2"}))
    return tables


def read_code_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Unpack the CSV; every value stays text and blanks are null.

    Raises ``ValueError`` if the file's header is another one (names that repeat may
    be numbered).
    """
    first = spark.read.text(path).first()
    found = tuple(first[0].strip().split(",")) if first else HEADER
    if found not in (HEADER, CSV_COLUMNS):
        raise ValueError(f"{path} has other columns: {', '.join(found)}")
    packed = spark.read.csv(path, schema=SCHEMA, header=True, enforceSchema=True)
    return unpack_code_tables(packed)
