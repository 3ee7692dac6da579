"""Line dedup over levelled sorted runs (operator 5), built-in functions only.

A line's key is the line without blanks at both ends and with A-Z lower-cased; 128
bits of hash stand for it.  ``LineRuns`` keeps what is known about keys in runs:
tables that are bucketed and sorted by key, so a merge join reads them as they lie.
A new batch of documents is merged against the runs (an anti-join): keys that no run
has get the batch's largest document as their holder; keys that are known only add
to their counts.  The batch's own run goes to level 0, and ``FANOUT`` runs of a level
are compacted into one of the next.  Batches come from the largest doc_id down, so
the first batch with a key has its last document.

Keys are counted with map-side combine, so a line in a third of all documents is one
row per task.  Texts are shuffled once, by document, for the result; lost lines are
marked by their positions, a byte each, so a text of many lines costs no search.

Runs are tables of the session's warehouse, which all executors must share; they are
dropped at the end, also after a failure.

Cases: a null or empty text is one empty line; a null doc_id counts as one document
below all others; repeated rows of a doc_id are one document, also with other texts; a
line that repeats in its document stays or goes with all of its copies; texts of any
length are split whole; an empty table gives no rows.  Columns other than doc_id and text
are carried along by ``drop_repeated_lines``, whatever their names, but for ``n_lines``,
``n_dropped`` and ``kept``, which are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollgraph.llm.store import materialise

LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
BATCHES = 4
FANOUT = 2
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWEST = -(1 << 63)


def line_key(line):
    """The line as it is compared."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def _hashes(line):
    key = line_key(line)
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _lines():
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _row(documents: DataFrame) -> list:
    """What a line's row is known by: document and text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"), F.xxhash64("text").alias("body")]


def line_keys(documents: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(h1, h2, doc, body, pos): the keys of at least ``least`` code points."""
    key = lambda x: F.when(F.char_length(line_key(x)) >= least, _hashes(x))
    keys = F.filter(F.transform(_lines(), lambda x, i: F.struct(i.alias("pos"), key(x).alias("key"))), lambda x: x["key"].isNotNull())
    lines = documents.select(*_row(documents), F.explode(keys).alias("line"))
    return lines.select("line.key.h1", "line.key.h2", "doc", "body", "line.pos")


class LineRuns:
    """Counts and holders of line keys, in levels of sorted runs."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _store(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows.select("h1", "h2", "n", "holder").repartition(self.buckets, "h1", "h2")
        rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, keys: DataFrame) -> None:
        """Merge a batch of (h1, h2, doc); its documents lie below all added before."""
        own = keys.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("holder"))
        fresh = own
        for names in self.levels:
            for name in names:
                fresh = fresh.join(self.spark.table(name), ["h1", "h2"], "left_anti")
        fresh = fresh.select("h1", "h2", F.lit(True).alias("fresh")) if self.levels else None
        if fresh is not None:
            known = own.join(fresh, ["h1", "h2"], "left")
            own = known.withColumn("holder", F.when(F.col("fresh"), F.col("holder"))).drop("fresh")
        self._store(own, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        merged = self.merged(names)
        self.levels[level] = []
        self._store(merged, level + 1)
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def merged(self, names: list[str] | None = None) -> DataFrame:
        """(h1, h2, n, holder) over the named runs, or over all of them."""
        chosen = [n for level in self.levels for n in level] if names is None else names
        rows = self.spark.table(chosen[0])
        for name in chosen[1:]:  # both sides lie bucketed and sorted by key
            other = self.spark.table(name).select("h1", "h2", F.col("n").alias("_n"), F.col("holder").alias("_holder"))
            rows = rows.join(other, ["h1", "h2"], "full").select(
                "h1", "h2",
                (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"),
                F.greatest("holder", "_holder").alias("holder"),
            )
        return rows

    def drop(self) -> None:
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def repeated_keys(keys: DataFrame, least: int = LEAST_DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """(h1, h2, holder) of keys in at least ``least`` documents."""
    low, high = keys.where(F.col("doc") > LOWEST).agg(F.min("doc"), F.max("doc")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = (high - low) // batches + 1
    runs = LineRuns(keys.sparkSession)
    try:
        for k in reversed(range(batches)):
            batch = keys.where(F.col("doc") >= low + k * width) if k else keys
            runs.add(batch if k == batches - 1 else batch.where(F.col("doc") < low + (k + 1) * width))
        return materialise(runs.merged().where(F.col("n") >= least).select("h1", "h2", "holder"), "line-repeated")
    finally:
        runs.drop()


def drop_repeated_lines(documents: DataFrame, length: int = LEAST_LENGTH, least: int = LEAST_DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """``documents`` with n_lines, n_dropped and kept: keys of at least ``length`` code
    points found in at least ``least`` documents lose their lines, but for the largest
    doc_id holding them.  ``kept`` holds the other lines."""
    keys = materialise(line_keys(documents, length), "line-keys")
    repeated = repeated_keys(keys, least, batches)
    gone = keys.join(repeated, ["h1", "h2"]).where("doc < holder").groupBy("doc", "body")
    gone = gone.agg(F.sort_array(F.collect_set("pos")).alias("_gone"))  # lines of one text
    # A byte for each line up to the last lost one: 1 if it goes.
    gap = lambda p, i: p - F.when(i > 0, F.get(F.col("_gone"), i - 1)).otherwise(F.lit(-1)) - 1
    marks = F.array_join(F.transform("_gone", lambda p, i: F.concat(F.repeat(F.lit("0"), gap(p, i)), F.lit("1"))), "")
    gone = gone.select(F.col("doc").alias("_l_doc"), F.col("body").alias("_l_body"), marks.cast("binary").alias("_l_marks"))

    held = {c: f"_d_{c}" for c in documents.columns if c not in ("n_lines", "n_dropped", "kept")}
    doc, body = _row(documents)
    rows = documents.select(*[F.col(c).alias(n) for c, n in held.items()], doc.alias("_l_doc"), body.alias("_l_body"))
    joined = rows.join(gone, ["_l_doc", "_l_body"], "left")
    lines = F.split(F.coalesce(F.col(held["text"]), F.lit("")), "\n", -1)
    mark = lambda i: F.substring(F.col("_l_marks"), i + 1, F.lit(1))
    stay = F.filter(lines, lambda x, i: mark(i) != F.lit("1").cast("binary"))
    kept = F.when(F.col("_l_marks").isNull(), lines).otherwise(stay)
    return joined.select("*", kept.alias("_l_kept")).select(
        *[F.col(n).alias(c) for c, n in held.items()], F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size("_l_kept")).cast("long").alias("n_dropped"), F.array_join("_l_kept", "\n").alias("kept"),
    )
