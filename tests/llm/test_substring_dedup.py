"""Substring dedup against a dictionary of all windows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from rollgraph.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, doc long, places int"


def expected(rows, window=20):
    """Rows with one doc_id and text are one document."""
    first = {}
    texts = {(d if d is not None else 1 << 62, t or "") for d, t in rows}
    for d, t in sorted(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), []).append((d, i, t))
    first = {k: min(v)[:2] for k, v in first.items()}
    out = []
    for d, t in rows:
        key, t = d if d is not None else 1 << 62, t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (key, i):
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(words) if i not in gone]
        out.append((d if d is not None else -1, len(words), len(gone), " ".join(kept)))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 7, 7) for d, t in rows], SCHEMA).repartition(5)
    return sorted(
        (r[0] if r[0] is not None else -1, r[1], r[2], r[3]) for r in remove_repeats(df).collect()
    )


def test_cases(spark):
    rng = random.Random(3)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(300))
    cut = base.split(" ")
    rows = [
        (1, base), (2, base), (2, base), (3, None), (4, ""), (None, base), (5, "one\x0btwo  three\n"),
        (6, " ".join(cut[40:75]) + " x y " + " ".join(cut[10:30])),
        (7, "a " * 90), (8, "a " * 19), (9, "é ü " * 25), (10, " ".join(cut[40:59])),
        (11, " ".join(cut[41:60]) + " " + " ".join(cut[41:62])), (12, "b c " * 40 + "z" * 3_000_000),
    ]
    assert run(spark, rows) == expected(rows)


def test_random_overlaps(spark):
    rng = random.Random(5)
    pool = [[f"v{rng.randrange(50)}" for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    rows = [(i, " ".join(x for _ in range(rng.randrange(6)) for x in rng.choice(pool))) for i in range(80)]
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("size", ["sf0.001"])
def test_test_table(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    rows = [(r[0], r[1]) for r in docs.collect()]
    got = sorted((r[0], r[1], r[2], r[3]) for r in remove_repeats(docs.withColumn("at", F.lit(1))).collect())
    assert got == expected(rows)
