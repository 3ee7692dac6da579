"""Grouping of near-identical strings against comparing all pairs."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest

from conftest import rows
from rollgraph.operators.grouping import group_similar, similar_strings
from rollgraph.functions import columns as fn
from pyspark.sql import functions as F


def vectors(strings):
    """Unit TF-IDF vectors of distinct strings given with their copies."""
    grams = {}
    for s in strings:
        t = re.sub(r"[,\-./]|\s", "", s.upper())
        grams[s] = Counter(t[i : i + 3] for i in range(len(t) - 2))
    total = sum(strings.values())
    df = Counter()
    for s, counts in grams.items():
        for g in counts:
            df[g] += strings[s]
    out = {}
    for s, counts in grams.items():
        v = {g: n * (math.log((total + 1) / (df[g] + 1)) + 1) for g, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        out[s] = {g: w / norm for g, w in v.items()}
    return out


def alike(strings, threshold):
    v = vectors(strings)
    return sorted(
        (a, b)
        for a, b in combinations(sorted(strings), 2)
        if sum(w * v[b].get(g, 0.0) for g, w in v[a].items()) >= threshold
    )


def addresses(seed, n):
    rng = random.Random(seed)
    streets = ["MAIN ST", "MAIN STREET", "OAK AVENUE", "ÑANDÚ ROAD", "ELM", "COMMERCE BLVD"]
    out = []
    for _ in range(n):
        out.append(
            f"{rng.randrange(1, 60)} {rng.choice(streets)}{rng.choice(['', ',', ' UNIT 2'])}\n"
            f"{rng.choice(['WACO', 'AUSTIN'])}\n7870{rng.randrange(4)}"
        )
    return out + out[: n // 3] + [out[0]] * (n // 3) + ["AB", "", "AB"]


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.95])
def test_similar_strings_finds_every_pair(frame, threshold):
    counts = Counter(addresses(2, 90))
    df = frame(list(counts.items()), "s string, copies int")
    got = rows(similar_strings(df, threshold), "a", "b")
    assert got == sorted(alike(counts, threshold), key=repr)


def test_groups_are_the_closure_with_copies_and_nulls(frame):
    texts = addresses(4, 60) + [None, None]
    df = frame(list(enumerate(texts)), "id int, s string")
    got = {r["id"]: r["gp"] for r in group_similar(df, "s", "id", 0.8).collect()}
    counts = Counter(t for t in texts if t is not None)
    group = {s: s for s in counts}
    changed = True
    pairs = alike(counts, 0.8)
    while changed:
        changed = False
        for a, b in pairs:
            low = min(group[a], group[b])
            if group[a] != low or group[b] != low:
                group[a] = group[b] = low
                changed = True
    least = {}
    for i, t in enumerate(texts):
        if t is not None:
            least.setdefault(group[t], i)
    want = {i: i if t is None else least[group[t]] for i, t in enumerate(texts)}
    assert got == want


def test_column_helpers(frame):
    df = frame(
        [("0012", "20200101", "x  ", " 5  Main St", None, "00701-123"), ("1x", "00000000", "   ", None, None, None)],
        "n string, d string, t string, a string, b string, z string",
    )
    got = df.select(
        fn.padded_number(F.col("n")).alias("n"),
        fn.padded_date(F.col("d")).cast("string").alias("d"),
        fn.blank_to_null(F.col("t")).alias("t"),
        fn.canonical_address(F.col("a"), F.col("b"), F.lit("waco"), F.col("z"), F.lit("US")).alias("p"),
        fn.joined_key(F.col("a"), F.col("n")).alias("k"),
        fn.cut(F.col("d"), 6, 20).alias("c"),
        fn.sentinel_to_null(F.lit("NAN"), ()).alias("s"),
    ).collect()
    assert tuple(got[0]) == (12, "2020-01-01", "x", "5 MAIN ST\nWACO\n00701-123\nUS", " 5  Main St0012", "01", "NAN")
    assert tuple(got[1])[:5] == (None, None, None, "WACO\nUS", None)


def test_foreign_postal_codes_stay_whole(frame):
    df = frame([("m5v 2t6",), ("M5V  2Z9",), ("SW1A 1AA",), ("SW1A 2BB",)], "z string")
    none = F.lit(None).cast("string")
    got = df.select(fn.canonical_address(none, none, F.lit("x"), F.col("z"), F.lit("CA")).alias("p")).collect()
    assert [r["p"] for r in got] == ["X\nM5V 2T6\nCA", "X\nM5V 2Z9\nCA", "X\nSW1A 1AA\nCA", "X\nSW1A 2BB\nCA"]
