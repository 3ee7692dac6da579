"""Fixed-width files as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollgraph.functions.columns import (
    blank_to_null,
    cut,
    padded_date,
    padded_number,
    sentinel_to_null,
)
from rollgraph.session import scratch_path
from rollgraph.sources.layouts import (
    PROPERTY_ROLL,
    RECORD_LENGTH,
    RECORD_TYPES,
    Field,
    layout_fields,
)


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines decoded before they are cut, so that offsets count characters."""
    raw = spark.read.text(path)
    return raw.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))


def parse_fixed_width(
    lines: DataFrame, fields: Iterable[Field], sentinels: Sequence[str] = ("NAN",)
) -> DataFrame:
    """Slices of ``value`` as trimmed upper-case text; blanks and sentinels are null.

    Every line is a record, the first one too, and no type is inferred.
    """
    return lines.select(
        *[
            sentinel_to_null(
                F.nullif(F.upper(F.trim(cut(F.col("value"), f.start, f.end))), F.lit("")), sentinels
            ).alias(f.name)
            for f in fields
        ]
    )


def read_fixed_width(
    spark: SparkSession,
    path: str,
    fields: Iterable[Field],
    encoding: str = "ISO-8859-1",
    sentinels: Sequence[str] = ("NAN",),
) -> DataFrame:
    return parse_fixed_width(read_lines(spark, path, encoding), fields, sentinels)


def read_property_roll(spark: SparkSession, path: str) -> DataFrame:
    """The county property roll with its own slices."""
    return read_fixed_width(spark, path, list(PROPERTY_ROLL))


REJECTS = "rejects"
PLACE = ("_file", "_block", "_line")  # file, split of the file, order within a task
LINES_PER_FILE = 100_000  # a compressed file is read by one task
ROW_GROUP_BYTES = 16 << 20


def _layout() -> Column:
    """Layout code of a line, or ``REJECTS`` if it has none or another length."""
    known = [code for code, (_, fields) in RECORD_TYPES.items() if fields]
    fits = (F.length("value") == RECORD_LENGTH) & F.substring("value", 1, 2).isin(*known)
    return F.when(fits, F.substring("value", 1, 2)).otherwise(F.lit(REJECTS)).alias("layout")


@dataclass(frozen=True)
class Registry:
    """A bulk file: one table per layout that has fields, plus what fits none.

    Each table is a filter and a projection over ``lines``.  Lines that ``split_layouts``
    has parted by layout have a ``layout`` column: a table then reads its part only.
    """

    lines: DataFrame
    date_fields: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, fields in RECORD_TYPES.values() if fields]

    def _part(self, layout: str) -> DataFrame:
        if "layout" in self.lines.columns:
            return self.lines.where(F.col("layout") == layout).select("value")
        return self.lines.where(_layout() == layout)

    def table(self, name: str) -> DataFrame:
        code = next(code for code, (n, _) in RECORD_TYPES.items() if n == name)
        return parse_layout(self._part(code), code, self.date_fields)

    def placed(self, name: str) -> DataFrame:
        """A table with the columns of ``PLACE``, the place of each row in the bulk file,
        for steps in which the last row wins."""
        if not set(PLACE) <= set(self.lines.columns):
            raise ValueError("part the file by layout first")
        code = next(code for code, (n, _) in RECORD_TYPES.items() if n == name)
        lines = self.lines.where(F.col("layout") == code).select("value", *PLACE)
        return parse_layout(lines, code, self.date_fields, kept=PLACE)

    @property
    def rejects(self) -> DataFrame:
        return self._part(REJECTS)


def _part_by_layout(lines: DataFrame, target: str) -> None:
    """``lines`` with a ``layout`` column, one folder per layout below ``target``.

    A task keeps one open file per layout instead of sorting its lines by layout, so
    nothing is spilled; row groups are small, since a task holds one for each of them.
    """
    spark, writers = lines.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, str(len(RECORD_TYPES) + 1))
    try:
        options = {"compression": "zstd", "parquet.block.size": str(ROW_GROUP_BYTES)}
        lines.write.mode("overwrite").options(**options).partitionBy("layout").parquet(target)
    finally:
        spark.conf.set(writers, before)


def _typed(field: Field, kind: str) -> Column:
    text = cut(F.col("value"), field.start, field.end)
    if kind == "N":
        return padded_number(text)
    if kind == "D":
        return padded_date(text)
    return blank_to_null(text)


def parse_layout(
    lines: DataFrame,
    code: str,
    date_fields: Sequence[str] = (),
    keep_filler: bool = False,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Records of one layout as typed columns, and the ``kept`` ones of the lines.

    ``date_fields`` reads further columns as dates, e.g. ``creation_date`` of
    the master layout, which is listed as a number.
    """
    fields = layout_fields(RECORD_TYPES[code][1])
    wanted = [f for f in fields if keep_filler or f.name != "filler"]
    records = lines.where(
        (F.substring("value", 1, 2) == code) & (F.length("value") == RECORD_LENGTH)
    )
    return records.select(
        *[_typed(f, "D" if f.name in date_fields else f.kind).alias(f.name) for f in wanted], *kept
    )


def parse_multi_layout(lines: DataFrame, date_fields: Sequence[str] = ()) -> Registry:
    """The tables of a bulk file given as lines."""
    return Registry(lines, tuple(date_fields))


def layout_counts(lines: DataFrame) -> DataFrame:
    """Layout code of every full-length line, for comparison with the trailer."""
    return lines.where(F.length("value") == RECORD_LENGTH).select(
        padded_number(F.substring("value", 1, 2)).alias("layout_code")
    )


def read_multi_layout(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1", date_fields: Sequence[str] = ()
) -> Registry:
    return parse_multi_layout(read_lines(spark, path, encoding), date_fields)


def split_layouts(
    spark: SparkSession, path: str, target: str, encoding: str = "ISO-8859-1", date_fields: Sequence[str] = ()
) -> Registry:
    """Part a bulk file by layout in one scan: folders ``layout=<code>`` below
    ``target``, and one for the rejects.  Its tables read their own folder only."""
    place = ["_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id()]
    lines = spark.read.text(path).select(
        F.decode(F.col("value").cast("binary"), encoding).alias("value"),
        *[(F.col(p) if isinstance(p, str) else p).alias(name) for p, name in zip(place, PLACE)],
    )
    _part_by_layout(lines.withColumn("layout", _layout()), target)
    parted = spark.read.schema("value string, _file string, _block long, _line long, layout string").parquet(target)
    return Registry(parted, tuple(date_fields))


def write_tables(registry: Registry, path: str) -> None:
    """One columnar folder per layout below ``path``; rejects beside them.  Lines that
    are not parted by layout yet are parted first, so they are read once."""
    spark = registry.lines.sparkSession
    if "layout" not in registry.lines.columns:
        parted = scratch_path(spark, "layouts")
        _part_by_layout(registry.lines.select("value", _layout()), parted)
        registry = Registry(spark.read.schema("value string, layout string").parquet(parted), registry.date_fields)
    for name in registry.names:
        registry.table(name).write.mode("overwrite").parquet(f"{path}/{name}")
    registry.rejects.write.mode("overwrite").parquet(f"{path}/rejects")


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as a text file in compressed pieces: most of a fixed-width line is padding."""
    options = {"compression": "gzip", "maxRecordsPerFile": LINES_PER_FILE}
    lines.write.options(**options).text(path)


def render_layout(df: DataFrame, code: str, values: dict[str, Column]) -> DataFrame:
    """Full-length lines of one layout; fields without a value are padding.

    The inverse of ``parse_layout``: numbers and dates are filled with zeros on
    the left, text with spaces on the right.
    """
    parts = []
    for f in layout_fields(RECORD_TYPES[code][1]):
        width = f.end - f.start
        if f.name == "layout_code":
            parts.append(F.lit(code))
        elif f.kind == "C" or f.name == "filler":
            text = values.get(f.name, F.lit("")).cast("string")
            parts.append(F.rpad(F.coalesce(text, F.lit("")), width, " "))
        else:
            value = values.get(f.name, F.lit("0"))
            text = F.date_format(value, "yyyyMMdd") if f.kind == "D" and f.name in values else value
            parts.append(F.lpad(F.coalesce(text.cast("string"), F.lit("0")), width, "0"))
    return df.select(F.concat(*parts).alias("value"))
