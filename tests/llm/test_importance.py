"""Importance resampling against a plain loop over features."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from rollgraph.llm import importance
from rollgraph.llm.store import ranked

SCHEMA = "doc_id long, text string, score string, rank string, n_words int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def expected(rows, target, n, buckets, least, percent, seed=2024):
    hashed = lambda f: zlib.crc32(f.encode()) % buckets
    raw, wanted = [0] * buckets, [0] * buckets
    for counts, texts in ((raw, [t for _, t in rows]), (wanted, target)):
        for text in texts:
            for f in bag(text, n)[1]:
                counts[hashed(f)] += 1
    gain = [
        math.floor(1000 * math.log((t + 1) * (sum(raw) + buckets) / ((s + 1) * (sum(wanted) + buckets))))
        for s, t in zip(raw, wanted)
    ]
    out = []
    for i, text in rows:
        words, found = bag(text, n)
        weight = sum(gain[hashed(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    drawn = [(*r, k + 1 if k < len(able) * percent // 100 else None) for k, r in enumerate(able)]
    return sorted([*drawn, *((*r, None) for r in out if r[1] < least)], key=repr)


def run(frame, rows, target, **given):
    docs = frame([(i, t, "clash", "clash", 7) for i, t in rows], SCHEMA)
    got = importance.resample(docs, frame([(t, "x") for t in target], "text string, doc_id string"), **given)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2])
def test_equals_a_plain_loop(frame, n):
    random = np.random.default_rng(3)
    vocabulary = ["Alpha", "beta2", "Ünï", "文字", "x", "z" * 700, "q" * 9, "İ", "42"]
    rows = [(int(i), " - ".join(random.choice(vocabulary, random.integers(0, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "!? \t\n"), (None, "alpha " * 6), (3, rows[3][1]), (3, rows[3][1]), (203, "long " * 60_000)]
    target = ["beta2 beta2 文字", None, "", "new words"]
    assert run(frame, rows, target, n=n, buckets=97, least_words=5, percent=30) == expected(rows, target, n, 97, 5, 30)


def test_empty_tables(frame):
    assert run(frame, [], ["a b"]) == []
    rows = [(i, "one two three") for i in range(10)]
    assert run(frame, rows, [], least_words=1) == expected(rows, [], 1, 10_000, 1, 10)


def test_crc_of_runs_of_all_lengths():
    random = np.random.default_rng(0)
    data = random.integers(0, 4, 40_000).astype(np.uint8)
    start = random.integers(0, 30_000, 500)
    length = random.integers(0, 30, 500) ** 2 + 1
    length[:40] = 9  # many rows of one length, some alike
    start[:40] = start[0] + random.integers(0, 5, 40)
    want = [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(start, length)]
    assert importance.crc_runs(data, start, length).tolist() == want


def test_rows_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(importance.w, "mix", lambda x: np.zeros_like(x))
    rows = np.random.default_rng(1).integers(0, 3, (50, 12)).astype(np.uint8)
    different, back = importance._distinct_rows(rows)
    assert np.array_equal(different[back], rows) and len(different) == len({bytes(r) for r in rows})


def test_ranks_over_many_partitions(frame, spark):
    rows = frame([(i, i % 7) for i in range(5000)], "doc_id long, score long")
    order = [importance.F.desc("score"), importance.F.asc("doc_id")]
    got = {r.doc_id: r.rank for r in ranked(rows, order, "rank").collect()}
    want = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert got == {i: k + 1 for k, i in enumerate(want)}
