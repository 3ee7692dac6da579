"""Resampling towards a target distribution by hashed n-gram features (operator 11).

Every text becomes a bag of n-grams hashed into ``buckets`` by CRC-32.  A bucket's gain
is the log ratio of its smoothed share in the target texts to that in the raw texts; a
document's weight is the sum of its features' gains.  Gumbel noise, fixed by seed and
doc_id, is added, and the highest scores are drawn: a draw without replacement in
proportion to the importance weights, the same in every run.

Hashing: words of a slice are written one space apart, so every n-gram is a run of
bytes.  Runs are grouped by length; the distinct ones of a length are the rows of one
uint8 matrix, whose CRCs are updated column by column; the buckets go back to all their
places.  Equal rows are found by a hash and compared byte for byte.

Scale: texts are read twice (bucket counts, then scores).  A task sends at most
``buckets`` counts, and the driver holds two arrays of ``buckets``.  Ranks come from
a range partitioning by score: the place in a partition plus the rows of those before.

Cases: null and empty texts have no features, weight 0; a null doc_id draws the noise
of an empty id; rows that repeat are rows of their own, with one score; ties go to the
smaller doc_id (nulls first), then to fewer features; without documents there are no
rows; without target texts every bucket of the target counts 0; other columns are
ignored.  A text of any length is one row of a slice and is never cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import words as w
from rollgraph.llm.store import materialise, ranked

BUCKETS = 10_000
LONG = 512  # bytes from which a run is hashed alone: its matrix would have a row or two
_SLICE = 1 << 20

_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, np.uint32(0xEDB88320) ^ (_TABLE >> np.uint32(1)), _TABLE >> np.uint32(1))


def crc_rows(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a uint8 matrix, all rows advanced by one column a step."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that differ, for each row its place among them), compared as bytes."""
    n, width = rows.shape
    if width <= 8:
        key = np.zeros(n, np.uint64)
        for column in rows.T:
            key = key << np.uint64(8) | column
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        return rows[first], back
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = rows
    key = np.zeros(n, np.uint64)
    for column in wide.view(np.uint64).T:
        key = w.mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    if not np.array_equal(rows[first][back], rows):  # one hash, two texts
        plain = np.ascontiguousarray(rows).view(f"V{width}").ravel()
        _, first, back = np.unique(plain, return_index=True, return_inverse=True)
    return rows[first], back


def crc_runs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes: runs of one length in one matrix."""
    out = np.empty(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    bounds = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        at, width = order[a:b], int(length[order[a]])
        if width >= LONG:
            for i in at:
                out[i] = zlib.crc32(data[start[i] : start[i] + width].tobytes())
            continue
        rows = np.lib.stride_tricks.sliding_window_view(data, width)[start[at]]
        different, back = _distinct_rows(rows)
        out[at] = crc_rows(different)[back]
    return out


def features(data: np.ndarray, bounds: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every run of 1 to ``n`` words, and the words of each row."""
    found = w.find_words(data, bounds, w.NOT_ALNUM)
    sizes = found.end - found.start
    words = np.diff(found.first)
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words
    # All words, lower-cased, one space apart.
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    line = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    inside = np.ones(len(line), bool)
    inside[start + sizes] = False
    source = np.arange(int(sizes.sum())) + np.repeat(found.start - (start - np.arange(len(start))), sizes)
    line[inside] = w.LOWER[data[source]]
    end, rows = start + sizes, found.rows
    last = found.first[1:][rows]  # one behind the row's last word
    found_buckets, found_rows = [], []
    for k in range(1, n + 1):
        at = np.flatnonzero(np.arange(len(start)) + k <= last)
        crc = crc_runs(line, start[at], end[at + k - 1] - start[at])
        found_buckets.append(crc.astype(np.int64) % buckets)
        found_rows.append(rows[at])
    return np.concatenate(found_buckets), np.concatenate(found_rows), words


def bucket_counts(texts: DataFrame, n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``text`` in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, bounds in w.text_slices(batch.column(0), _SLICE):
                total += np.bincount(features(data, bounds, n, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    summed = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, number in summed.collect():  # at most ``buckets`` rows
        counts[bucket] = number
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of a bucket's smoothed shares."""
    up = (target + 1.0) * (float(raw.sum()) + len(raw))
    down = (raw + 1.0) * (float(target.sum()) + len(raw))
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def weigh(documents: DataFrame, gains: np.ndarray, n: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])
    buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in w.text_slices(batch.column(1), _SLICE):
                found, rows, words = features(data, bounds, n, buckets)
                number = np.bincount(rows, minlength=high - low)
                weight = np.zeros(high - low, np.int64)
                np.add.at(weight, rows, gains[found])
                columns = [batch.column(0)[low:high], *(pa.array(c, pa.int64()) for c in (words, number, weight))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ids = documents.select(F.col("doc_id").cast("long"), "text")
    return ids.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int):
    """Thousandths of standard Gumbel noise, from the seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(uniform))).cast("long")


def resample(
    documents: DataFrame, target: DataFrame, percent: int = 10, n: int = 1,
    buckets: int = BUCKETS, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``rank`` is
    null but for the drawn ``percent`` of the documents of ``least_words`` or more."""
    gains = bucket_gains(bucket_counts(documents, n, buckets), bucket_counts(target, n, buckets))
    scored = weigh(documents, gains, n).withColumn("score", F.col("weight") + gumbel(seed))
    scored = materialise(scored, "resample-scores")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    places = ranked(scored.where(able), [F.desc("score"), F.asc("doc_id"), F.asc("n_features")], "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return places.withColumn("rank", rank).unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
