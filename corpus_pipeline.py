"""The corpus pipeline: language ID, line dedup, near duplicates, decontamination, mix.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents; the
last one adds size, source_size, target and taken.

Cases: language ID drops null texts and texts without a letter; line dedup drops a
document whose every line that held something went, and the mix drops documents without
words.  A null doc_id or source stays.  Rows that repeat are near copies of each other:
one stays; rows of one doc_id with different texts are documents of their own.  Ties go
as the operators say.  Texts of any length are read whole.  Empty tables give empty
results, and n_chars need not be there.  Extra columns are carried along, whatever their
names, but for those that the last stage adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollgraph.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from rollgraph.llm.store import materialise

LEAST_SHARE = 0.4  # of a document's words in its language
ORACLE_SQL: str | None = None  # the first stage is a trained model


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that an operator would replace under other names."""
    moved = {c: f"_kept_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(moved), moved


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without one leading language go."""
    field = language_id.learn_languages(docs.where(language_id.fold("doc_id", 5) != 0))
    if field is None:  # nothing to learn from: nothing is rejected
        return docs
    given, moved = _aside(docs, "lang_pred", "score")
    found = language_id.predict_languages(given, field, tuple(given.columns))
    found = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE))
    return found.select(*[F.col(moved.get(c, c)).alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; n_chars follows.  A document goes if its text did."""
    given, moved = _aside(docs, "n_lines", "n_dropped", "kept")
    found = line_dedup.drop_repeated_lines(given)
    changed = F.col("n_dropped") > 0
    found = found.where(~changed | (F.trim("kept", F.lit(line_dedup.BLANKS)) != ""))
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return found.select(
        *[F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(moved.get(c, c)).alias(c) for c in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return jaccard_join.keep_one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the words it takes of each."""
    return mixing.mix_sources(docs).where("taken > 0")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_copies", drop_near_copies),
    ("decontaminate", decontaminate_benchmark),
    ("mix_sources", mix_to_weights),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
