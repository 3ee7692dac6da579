"""Mixing: targets and Sainte-Lague seats against plain loops."""

from __future__ import annotations

import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from rollgraph.llm import mixing
from rollgraph.llm.mixing import BLOCK, apportion, mix_sources


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        w = sum(weight[s] for s in names if s not in full)
        share = {s: full.get(s, rest * weight[s] / w if w else 0) for s in names}
        over = [s for s in names if s not in full and share[s] >= 3 * sizes[s]]
        if not over:
            return share
        full.update({s: 3.0 * sizes[s] for s in over})


def check(rows, out):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = targets(sizes), {}
    assert len(out) == len(rows)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, n in sizes.items():
        assert abs(taken[s] - want[s]) <= 3 * BLOCK + 0.002 * want[s], s


def test_targets_and_reruns(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(1, 900), rng.choice(["b", "a", "é", None, "c", "Z"] + ["hot"] * 4)) for i in range(300)]
    rows += [(5, None, "a"), (6, "", "empty"), (None, "x y", None), (7, "w " * 400_000, "hot"), (8, "one", "tiny"), (8, "one", "tiny")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, rank int, quota int")
    out = mix_sources(df.repartition(3)).collect()
    check(rows, out)
    again = mix_sources(df.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(df).count() == 0


@pytest.mark.parametrize("close", [4096, 3])
def test_seats_are_sainte_lague(spark, monkeypatch, close):
    monkeypatch.setattr(mixing, "CLOSE", close)
    rng = random.Random(2)
    cases = [[rng.randrange(1, 10 ** rng.randrange(1, 6)) for _ in range(rng.randrange(1, 40))] for _ in range(3)]
    cases += [[7] * 30, [0, 0, 5], [10**9, 1, 1]]  # ties, nobody, one for all
    for g, votes in enumerate(cases):
        limits = [10_000 if g % 2 else rng.randrange(30) for _ in votes]
        df = spark.createDataFrame([(i, float(v), x) for i, (v, x) in enumerate(zip(votes, limits))], "i int, v double, x long")
        got = {r["i"]: r["quota"] for r in apportion(df, "i", "v", "x", 50 + 31 * g).collect()}
        heap = [(-v, i, 0) for i, v in enumerate(votes) if v and limits[i]]
        heapq.heapify(heap)
        seats = [0] * len(votes)
        for _ in range(50 + 31 * g):
            if heap:
                _, i, j = heapq.heappop(heap)
                seats[i] = j + 1
                if j + 1 < limits[i]:
                    heapq.heappush(heap, (-votes[i] / (2 * j + 3), i, j + 1))
        assert [got[i] for i in range(len(votes))] == seats, g


def test_many_sources(spark):
    """More sources than seats, most of them of one size; every document's words against
    the blocks that its place has."""
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([3, 3, 3, 3, 40, 900]), f"s{i % 400}") for i in range(600)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, _hash int")
    out = mix_sources(df).collect()
    check([(r["doc_id"], r["text"], r["source"]) for r in out], out)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)


def test_words_taken_follow_the_blocks(spark, monkeypatch):
    """A shard's taken words, document by document, from a plain list of its blocks."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), "ab"[i % 3 == 0]) for i in range(200)]
    held = {}
    deal = mixing.deal_to_shards
    monkeypatch.setattr(mixing, "deal_to_shards", lambda *given: held.setdefault("q", deal(*given)))
    out = {r["doc_id"]: r for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    quotas = {(r["rank"], r["_shard"]): (r["blocks"], r["quota"]) for r in held["q"].collect()}
    hashes = {r["doc_id"]: r["h"] for r in spark.createDataFrame(rows, "doc_id long, text string, source string").select("doc_id", F.xxhash64(F.lit(7), "doc_id", "text").alias("h")).collect()}
    offsets = {k: spark.range(1).select(F.pmod(F.xxhash64(F.lit(7), F.lit(k[0]).cast("long"), F.lit(k[1]).cast("long")), F.lit(b))).first()[0] for k, (b, _) in quotas.items()}
    shards = {}
    for d, t, s in rows:
        rank = "ab".index(s)
        n = max(1, -(-out[d]["source_size"] // 500))
        shards.setdefault((rank, hashes[d] % n), []).append((hashes[d], d, len(t.split())))
    for key, docs in shards.items():
        blocks, quota = quotas[key]
        rounds, rest = divmod(quota, blocks)
        chosen = [(b + 1) * rest // blocks != b * rest // blocks if not offsets[key] else ((b + 1) * rest + offsets[key]) // blocks != (b * rest + offsets[key]) // blocks for b in range(blocks + 1)]
        place = 0
        for _, d, n in sorted(docs):
            words = sum(rounds + chosen[(place + i) // BLOCK] for i in range(n))
            assert out[d]["taken"] == words, (key, d)
            place += n
