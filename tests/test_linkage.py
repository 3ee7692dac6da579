"""Linkage against listing all pairs, on records with nulls and hot blocks."""

import math
import random
import re
from itertools import combinations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from rollgraph.functions.similarity import jaro_winkler_batch
from rollgraph.operators import agreement as agr
from rollgraph.operators import scoring as sco
from rollgraph.operators import skew
from rollgraph.operators.pairs import list_pairs
from rollgraph.operators.similar import similar_values
from rollgraph.operators.skew import pairs_between, pairs_in_runs, pairs_within
from rollgraph.plans import dedupe, link_queries
from rollgraph.session import cut_lineage


def jaro_winkler(a, b):
    return float(jaro_winkler_batch(pd.Series([a]), pd.Series([b]))[0])


def test_jaro_winkler_known_values():
    known = {
        ("MARTHA", "MARHTA"): 0.961111,
        ("DIXON", "DICKSONX"): 0.813333,
        ("DWAYNE", "DUANE"): 0.84,
        ("ABC", "XYZ"): 0.0,
        ("", "A"): 0.0,
        ("SAME", "SAME"): 1.0,
    }
    for (a, b), want in known.items():
        assert jaro_winkler(a, b) == pytest.approx(want, abs=1e-6)
    mixed = jaro_winkler_batch(pd.Series(["A" * 300, None, "AB"]), pd.Series(["A" * 300, "X", "AB"]))
    assert mixed[0] == 1.0 and math.isnan(mixed[1]) and mixed[2] == 1.0


def words(rng, n):
    stems = ["ACME SUPPLY", "ACME SUPLY", "BOLT WORKS", "CARGO LINES", "DELTA FOODS", "É & SØN"]
    out = []
    for _ in range(n):
        text = list(rng.choice(stems))
        for _ in range(rng.randrange(3)):
            text.insert(rng.randrange(len(text)), rng.choice("ABEL 19"))
        out.append("".join(text))
    return out


@pytest.mark.parametrize("threshold", [0.75, 0.9, 0.96])
def test_similar_values_finds_every_pair(frame, threshold):
    rng = random.Random(3)
    values = [(rng.choice("xy"), w) for w in words(rng, 120)] + [("x", None), ("x", ""), ("x", "A")]
    got = similar_values(frame(values, "b string, w string"), ["b"], "w", threshold)
    want = set()
    for block in "xy":
        texts = sorted({w for b, w in values if b == block and w})
        for a, b in combinations(texts, 2):
            if jaro_winkler(a, b) >= threshold:
                want.add((block, a, b))
    found = [(r[0], r[1], r[2]) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == want


def test_pairs_within_meets_every_pair_once(frame):
    df = frame([("k", i) for i in range(37)] + [("one", 99)], "k string, i int")
    for cell in (1, 4, 1000):
        got = pairs_within(df, ["k"], "i", [], rows_per_cell=cell)
        met = sorted((min(r.i_l, r.i_r), max(r.i_l, r.i_r)) for r in got.collect())
        assert met == list(combinations(range(37), 2))


def records(rng, n, hot=0.35):
    """A third of the rows in one zip, copies, and nulls everywhere."""
    out = []
    for i in range(n):
        zip_code = "00001" if rng.random() < hot else rng.choice(["00002", "00003", None])
        out.append(
            (
                i,
                rng.choice(["1 MAIN", "2 MAIN", "2 MAINE", None, "9 OAK"]),
                rng.choice(["WACO", "AUSTIN", None]),
                zip_code,
            )
        )
    return out


SCHEMA = "unique_id int, address1 string, city string, zip_code string"
COLUMNS = ("unique_id", "address1", "city", "zip_code")


def by_hand(data, settings):
    """Group counts by listing all pairs."""
    at = {c: i for i, c in enumerate(COLUMNS)}
    found = {}
    for left, right in combinations(data, 2):
        def same(c):
            a, b = left[at[c]], right[at[c]]
            return a is not None and a == b

        if not any(all(same(c) for c in rule) for rule in settings.rules):
            continue
        key = [left[at[c]] for c in settings.fixed]
        for c in settings.free:
            comparison = settings.comparison(c)
            a, b = left[at[c]], right[at[c]]
            pair = [None, None]
            if a is None or b is None:
                gamma, value = -1, None
            elif a == b:
                gamma, value = comparison.equal, a
            elif comparison.similarity and jaro_winkler(a, b) >= comparison.similarity:
                gamma, value, pair = 1, None, sorted([a, b])
            else:
                gamma, value = 0, None
            key += [gamma, value] + (pair if comparison.similarity else [])
        found[tuple(key)] = found.get(tuple(key), 0) + 1
    return found


CASES = {
    "shipped": dedupe.ADDRESSES,
    "one rule": agr.LinkSettings(
        (agr.Comparison("address1", similarity=0.9), agr.Comparison("city")), (("zip_code",),)
    ),
    "rule of two columns": agr.LinkSettings(
        (agr.Comparison("address1"), agr.Comparison("zip_code")),
        (("zip_code", "city"), ("zip_code", "address1")),
    ),
    "two similar columns": agr.LinkSettings(
        (agr.Comparison("address1", similarity=0.9), agr.Comparison("city", similarity=0.5)),
        (("zip_code",), ("address1", "city")),
    ),
}


@pytest.mark.parametrize("name", list(CASES))
def test_groups_count_every_pair_once(frame, name):
    settings = CASES[name]
    data = records(random.Random(7), 150)
    groups = agr.agreement_groups(frame(data, SCHEMA), settings)
    columns = [c for c in settings.fixed]
    for c in settings.free:
        columns += [f"gamma_{c}", c]
        if settings.comparison(c).similarity:
            columns += [f"{c}_l", f"{c}_r"]
    got = {tuple(r[:-1]): int(r[-1]) for r in groups.select(*columns, "n_pairs").collect()}
    assert got == by_hand(data, settings)


def test_block_members_hold_all_pairs(frame):
    data = frame(records(random.Random(1), 60), SCHEMA).withColumn("filing_num", F.col("unique_id"))
    members = agr.block_members(data, dedupe.ADDRESSES)
    sizes = members.groupBy("rule", "block").agg(
        F.count("*").alias("n"), F.max("size").alias("size"), F.max("pairs").alias("pairs")
    )
    for r in sizes.collect():
        assert r["n"] == r["size"] and r["pairs"] == r["n"] * (r["n"] - 1) // 2


def test_a_huge_block_costs_one_row(spark):
    copies = spark.range(3_000_000).select(F.lit("ACME").alias("name"), F.lit(1).alias("filing_num"))
    got = dedupe.dedupe_names(copies).collect()
    assert len(got) == 1 and int(got[0]["n_pairs"]) == 3_000_000 * 2_999_999 // 2
    assert 0.0 < got[0]["match_probability"] <= 1.0


def test_lone_pattern_and_no_pairs_give_finite_weights(frame):
    same = frame([(1, "A"), (2, "A"), (3, "B"), (4, "B")], "filing_num int, name string")
    for df in (same, same.limit(0), same.where("filing_num IN (1, 3)")):
        groups = agr.agreement_groups(df, dedupe.NAMES)
        weights = sco.estimate_em(sco.pattern_counts(groups, dedupe.NAMES), dedupe.NAMES)
        values = [weights.prior, *weights.m["name"], *weights.u["name"]]
        assert all(0.0 < v < 1.0 and math.isfinite(v) for v in values)
    scored = dedupe.dedupe_names(same)
    assert scored.where(F.isnan("match_probability") | F.col("match_probability").isNull()).count() == 0


def test_rare_values_weigh_more(frame):
    data = [(i, "COMMON", "X", "1") for i in range(30)] + [(100 + i, "RARE", "X", "1") for i in range(2)]
    weights = sco.Weights(
        0.1,
        {c: (0.1, 0.9) for c in ("address1", "city", "zip_code")},
        {c: (0.5, 0.5) for c in ("address1", "city", "zip_code")},
    )
    scored = dedupe.dedupe_addresses(frame(data, SCHEMA), weights)
    got = {r["address1"]: r["tf_match_probability"] for r in scored.where("gamma_address1 = 1").collect()}
    assert got["RARE"] > got["COMMON"]
    odds = 0.1 / 0.9 * (0.9 / 0.5) ** 3 * (0.5 / (2 / 32)) * 0.5 * 0.5
    assert got["RARE"] == pytest.approx(odds / (1 + odds))


def test_missing_values_leave_the_odds_alone(frame):
    data = [(1, "A", None, "1"), (2, "A", "X", "1")]
    weights = sco.Weights(
        0.2,
        {c: (0.1, 0.9) for c in ("address1", "city", "zip_code")},
        {c: (0.8, 0.2) for c in ("address1", "city", "zip_code")},
    )
    got = dedupe.dedupe_addresses(frame(data, SCHEMA), weights).first()
    odds = 0.2 / 0.8 * (0.9 / 0.2) ** 2
    assert got["gamma_city"] == -1 and got["match_probability"] == pytest.approx(odds / (1 + odds))


def test_estimate_separates_duplicates_from_chance(frame):
    rng = random.Random(5)
    data = []
    for i in range(120):
        row = (f"{i % 60} ST", rng.choice("ABCDEF"), rng.choice("123456"))
        data.append((2 * i, *row))
        if i % 3 == 0:
            data.append((2 * i + 1, *row))
    settings = dedupe.ADDRESSES
    groups = agr.agreement_groups(frame(data, SCHEMA), settings)
    weights = sco.estimate_em(sco.pattern_counts(groups, settings), settings)
    scored = sco.score(groups, settings, weights)
    best = scored.where("gamma_address1 = 1 AND gamma_city = 1 AND gamma_zip_code = 1")
    worst = scored.where("gamma_address1 = 0 AND gamma_city = 0")
    assert best.agg(F.min("match_probability")).first()[0] > worst.agg(F.max("match_probability")).first()[0]


def test_level_of_single_pairs(frame):
    df = frame([("A", "A"), ("A", "B"), (None, "A")], "l string, r string")
    exact, fuzzy = agr.Comparison("c"), agr.Comparison("c", similarity=0.9)
    got = df.select(
        agr.level(exact, F.col("l"), F.col("r")).alias("e"),
        agr.level(fuzzy, F.col("l"), F.col("r"), F.lit(0.95)).alias("f"),
    )
    assert [tuple(r) for r in got.collect()] == [(1, 2), (0, 1), (-1, -1)]


def test_unique_ids_are_stable_and_accept_nulls(frame):
    df = frame([(1, None), (1, "A"), (2, "A")], "filing_num int, address1 string")
    first = rows(dedupe.with_unique_id(df, "filing_num", "address1"), "unique_id")
    assert len(set(first)) == 3 and None not in {r[0] for r in first}
    assert first == rows(dedupe.with_unique_id(df, "filing_num", "address1"), "unique_id")


@pytest.mark.parametrize("name", ["shipped", "two similar columns"])
def test_listed_pairs_are_the_pairs_of_the_chosen_groups(frame, name):
    settings = CASES[name]
    data = records(random.Random(11), 80)
    df = frame(data, SCHEMA).withColumn("filing_num", F.col("unique_id") + 1000)
    weights = sco.starting_weights(settings)
    scored = cut_lineage(sco.scored_comparisons(df, settings, weights))
    for chosen in (scored, scored.where("match_probability > 0.5")):
        listed = cut_lineage(list_pairs(chosen, df, settings))
        want = int(chosen.agg(F.sum("n_pairs")).first()[0] or 0)
        got = rows(listed, "unique_id_l", "unique_id_r", "filing_num_l")
        assert len(got) == len(set(got)) == want
        assert all(a < b and f == a + 1000 for a, b, f in got)
    low = listed.agg(F.min("match_probability")).first()[0]
    assert low is None or low > 0.5


def test_pairs_between_meets_every_pair_of_two_sides_once(frame):
    data = [(k, i, i % 3 == 0) for k in "ab" for i in range(40)] + [("c", 1, True)]
    df = frame(data, "k string, i int, s boolean")
    want = sorted(((k, i, j) for k, i, s in data for h, j, t in data if k == h and s and not t), key=repr)
    for cell in (1, 7, 100):
        assert rows(pairs_between(df, ["k"], "s", "i", [], rows_per_cell=cell), "k", "i_l", "i_r") == want


PARTS_SCHEMA = "unique_id int, filing_num int, name string, brand string, city string, size int"


def test_similar_groups_meet_only_the_records_of_their_two_values(frame):
    names = ["ACME SUPPLY", "ACME SUPLY"] + [f"{a}{b} {b}{a}" * 2 for a in "QXZJK" for b in "WVUT"]
    data = [(i, i + 1000, names[i % len(names)], "b", "c", 1) for i in range(110)]
    data += [(0, 1000, names[1], "b", "c", 1), (None, 5, names[0], "b", "c", 1)]  # an id of two rows, and none
    df = frame(data, PARTS_SCHEMA)
    weights = link_queries.GIVEN
    scored = cut_lineage(sco.scored_comparisons(df, link_queries.PARTS, weights))
    listed = list_pairs(scored.where("gamma_name = 1 and name_l = 'ACME SUPLY'"), df, link_queries.PARTS)
    want = {
        tuple(sorted((a[0], b[0]))) for a in data for b in data
        if a[2] == names[0] and b[2] == names[1] and None not in (a[0], b[0]) and a[0] != b[0]
    }
    got = rows(listed, "unique_id_l", "unique_id_r")
    assert set(got) == want and len(got) == len(want) == 29
    # The values are known to be similar: nothing is compared again, pair by pair.
    assert "ArrowEvalPython" not in listed._jdf.queryExecution().executedPlan().toString()


def test_scores_are_rounded_and_joined_before_the_pairs_are_listed(frame):
    df = frame([(i, f"n{i % 3}") for i in range(30)], "filing_num int, name string")
    listed = dedupe.name_pairs(df, link_queries.GIVEN_NAMES, 0.0, digits=6)
    assert listed.count() == 3 * 45
    assert {r[0] for r in listed.select(F.length(F.col("match_probability").cast("string"))).collect()} <= {8}
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan
    assert "_i#" in next(row for row in plan.splitlines() if " Join " in row)  # the cells come last


def test_records_are_not_broadcast_to_list_pairs(spark, tmp_path):
    # The file holds repeated values: it looks small, whatever its records take.
    data = spark.range(20_000).selectExpr(
        "id AS unique_id", "id AS filing_num", "'acme' AS name", "'b' AS brand", "string(id % 10000) AS city", "1 AS size"
    )
    data.write.parquet(str(tmp_path / "parts"))
    df = spark.read.parquet(str(tmp_path / "parts"))
    scored = cut_lineage(sco.scored_comparisons(df, link_queries.PARTS, link_queries.GIVEN))
    listed = list_pairs(scored, df, link_queries.PARTS)
    plan = listed._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [_key#" in plan
    assert not re.search(r"BroadcastHashJoin \[_key#\d+\], \[_key#\d+\], Inner", plan)
    assert listed.count() == 10_000


def test_records_get_the_keys_of_the_wanted_groups_only(frame):
    df = frame([(i, i, "acme", "b", "c", i % 2) for i in range(20)], PARTS_SCHEMA)
    scored = cut_lineage(sco.scored_comparisons(df, link_queries.PARTS, link_queries.GIVEN))
    listed = list_pairs(scored.where("gamma_name = 2 and gamma_size = 1"), df, link_queries.PARTS)
    assert listed.count() == 2 * 45
    # One set of columns agrees, so each record has one key.
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"explode\(array\((.*?)\)\), \[", plan)
    assert all(k.count("to_json") + k.count("StructsToJson") <= 1 for k in keys)


@pytest.mark.parametrize("cell", [1, 7, 50, 1000])
def test_pairs_in_runs_are_all_pairs_once_with_the_smaller_id_first(frame, monkeypatch, cell):
    monkeypatch.setattr(skew, "RUN_L", 3)
    monkeypatch.setattr(skew, "RUN_R", 5)
    data = [(k, f"{i * 37 % 101:03}", i, k * 2) for k in "ab" for i in range(60)]
    data += [("c", "1", 0, "cc"), ("a", "005", 99, "aa"), ("a", None, 7, "aa"), (None, "1", 1, "x"), (None, "2", 2, "x")]
    df = frame(data, "k string, i string, p int, s string")
    want = sorted(
        ((k, s, a, b, p, q) for k, a, p, s in data for h, b, q, _ in data
         if k is not None and k == h and None not in (a, b) and a < b), key=repr
    )
    for expected in (10, 30_000_000):  # as few tasks as may be, and more
        got = pairs_in_runs(df, ["k"], "i", ["p"], ["s"], expected, rows_per_cell=cell)
        assert rows(got, "k", "s", "i_l", "i_r", "p_l", "p_r") == want


def test_listed_pairs_take_little_room_in_a_file(spark, tmp_path):
    names = spark.range(3_000).select(F.col("id").alias("filing_num"), F.lit("acme").alias("name"))
    dedupe.name_pairs(names, link_queries.GIVEN_NAMES, 0.0).write.parquet(str(tmp_path / "pairs"))
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 3_000 * 2_999 // 2
    size = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert size < 3_000 * 2_999 // 2  # less than a byte a pair
