"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rollgraph.llm import jaccard_join
from rollgraph.llm.jaccard_join import POSTING, _meet, link_components


def shingles(text, k=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 1) for d, t in rows], "doc_id long, text string, sid int, n int")
    return sorted((tuple(r)[:3] for r in link_components(df.repartition(4)).collect()), key=str)


def test_cases_and_near_copies(spark):
    rng = random.Random(1)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (None, "one two"), (7, "a b c d e"), (7, "a b c d e")]
    shared = [f"s{rng.randrange(99)}" for _ in range(60)]
    for i in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 160))]
        if i % 3 == 0:
            words[3:3] = shared
        for j in range(6):
            copy = list(words)
            for _ in range(rng.randrange(j + 1)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
            rows.append((100 + 10 * i + j, " ".join(copy[: len(copy) - rng.randrange(3)])))
    rows.append((999, "z y x w v " * 30_000))
    rows.append((998, "z y x w v " * 30_000))
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_row_of_each_component(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, one), (5, two), (7, one + " more"), (3, two), (3, two), (None, one), (8, ""), (8, ""), (9, None), (2, "c d e")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, label string, n int")
    kept = jaccard_join.keep_one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(5, one), (3, two), (8, ""), (8, ""), (9, None), (2, "c d e")], key=str)


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_test_table(spark, size):
    docs = spark.read.parquet(f"/root/testdata/sf{size}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted((tuple(r)[:3] for r in link_components(docs).collect()), key=str) == expected(rows)


def test_groups_over_batches():
    rng = random.Random(2)
    rows = sorted((rng.randrange(12), s % 2, s % 3, s, 9, 8, 7) for s in (rng.randrange(9) for _ in range(60)))
    rows += [(50, 0, 0, 1, 9, 8, 7), (51, 0, 0, 1, 9, 8, 7), (51, 1, 0, 2, 9, 8, 7)]  # alone; two bands of one shingle
    groups = {}
    for t, b, o, s, *_ in rows:
        groups.setdefault(t, set()).add((b, o, s))
    want = [(t, s, min((p, x) for c, p, x in g if c == b)[1]) for t, g in groups.items() if len(g) > 1 for b, _, s in g]
    for size in (1, 2, 3, 7, 63):
        parts = [rows[i : i + size] for i in range(0, 63, size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], names=POSTING.names) for p in parts]
        found = [r for b in _meet(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["tok"], r["sid"], r["first"]) for r in found) == sorted(want), size
        assert all((r["n"], r["c"], r["i"], r["fn"], r["fc"], r["fi"]) == (9, 8, 7, 9, 8, 7) for r in found)


def test_shared_sets_keep_every_overlap(spark):
    """What comes back from small blocks: all shingles of two sets or more, in one order."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choices(words, k=rng.randrange(4, 60)) for _ in range(40)]
    rows = [(i, " ".join(b[rng.randrange(3) : len(b) - rng.randrange(3)])) for i, b in enumerate(base * 3)]
    rows += [(900 + i, rows[5][1]) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for most in ((1 << 21, 0xFFFF), (90, 0xFFFF), (1 << 21, 4)):
        profiles, sets = jaccard_join.shared_sets(docs, 5, 0, most)
        names = {r["doc_id"]: r["sid"] for r in profiles.collect()}
        found = {r["sid"]: (r["n"], np.frombuffer(r["toks"], ">u8")) for r in sets.collect()}
        plain = {names[i]: shingles(t) for i, t in rows}
        assert len(found) == len(plain)
        levels = {}
        for sid, (n, toks) in found.items():
            assert n == len(plain[sid]) and list(toks) == sorted(set(toks))
            for t in toks:
                assert levels.setdefault(int(t) & ((1 << 58) - 1), int(t) >> 58) == int(t) >> 58
        for a, x in plain.items():
            for b, y in plain.items():
                if a < b:
                    assert len(np.intersect1d(found[a][1], found[b][1])) == len(x & y)
