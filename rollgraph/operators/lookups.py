"""Code tables put to use.

No broadcast is forced: Spark broadcasts a code table when its measured size
allows it and hash-joins it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.sources.layouts import TOTAL_CODES


def decode(df: DataFrame, table: DataFrame, code: str, label: str) -> DataFrame:
    """Add ``label`` for the code in column ``code``; unknown codes give null.

    ``table`` has the columns ``code`` and ``label``, one row per code.
    """
    pairs = table.select(
        F.col("code").try_cast("bigint").alias("_code"), F.col("label").alias(label)
    )
    return df.join(pairs, F.col(code).try_cast("bigint") == F.col("_code"), "left").drop("_code")


def decode_audit(audit: DataFrame, tables: DataFrame, fields: DataFrame) -> DataFrame:
    """Names for the table and the field of every audit row.

    A field number is only unique within its table, so fields join on both.
    """
    named_tables = tables.select(
        F.col("table_id").try_cast("bigint").alias("_t"), "table_name"
    )
    named_fields = fields.select(
        F.col("table_id").try_cast("bigint").alias("_ft"),
        F.col("field_id").try_cast("bigint").alias("_ff"),
        "field_name",
    )
    return (
        audit.join(named_tables, F.col("table_id") == F.col("_t"), "left")
        .join(
            named_fields,
            (F.col("table_id") == F.col("_ft")) & (F.col("field_id") == F.col("_ff")),
            "left",
        )
        .drop("_t", "_ft", "_ff")
    )


def explode_flags(
    df: DataFrame, flags: str, labels: DataFrame, label: str, set_flag: str = "1"
) -> DataFrame:
    """One row per set flag, with the label whose code is its 1-based position."""
    marked = F.transform(
        F.split(F.col(flags), ""), lambda flag, at: F.when(flag == F.lit(set_flag), at + 1)
    )
    positions = F.filter(marked, lambda position: position.isNotNull())
    kept = [c for c in df.columns if c != flags]
    flat = df.select(*kept, F.explode(positions).alias("position"))
    return decode(flat, labels, "position", label)


def reconcile_totals(records: DataFrame, trailer: DataFrame) -> DataFrame:
    """Records found per layout code beside the count the trailer announces."""
    found = records.groupBy("layout_code").agg(F.count(F.lit(1)).alias("found"))
    entries = ", ".join(f"{code}L, count_{i:02d}" for i, code in enumerate(TOTAL_CODES, start=1))
    announced = trailer.select(
        F.expr(f"stack({len(TOTAL_CODES)}, {entries}) AS (layout_code, announced)")
    )
    return found.join(announced, "layout_code", "full_outer").select(
        "layout_code",
        F.coalesce("found", F.lit(0)).alias("found"),
        "announced",
        F.coalesce(F.coalesce("found", F.lit(0)) == F.col("announced"), F.lit(False)).alias("agrees"),
    )
