"""Decontamination against all items in all passages, and WAND against full scores."""

from __future__ import annotations

import random
import re

import numpy as np

from rollgraph.llm import decontaminate
from rollgraph.llm.decontaminate import ItemIndex, find_leaks, remove_leaks

DOCS = "doc_id long, text string, item_id int, score string"


def plain_terms(text, k=5):
    found = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text or "")
    found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in found]
    return found, [tuple(found[i : i + k]) for i in range(len(found) - k + 1)]


def plain_parts(text):
    """Question and answer terms, or those of the whole item."""
    for pattern in ("\n", r"[.!?](?=\s)"):
        for cut in reversed([m.end() for m in re.finditer(pattern, text)]):
            parts = [set(plain_terms(text[:cut])[1]), set(plain_terms(text[cut:])[1])]
            if all(parts):
                return parts
    return [set(plain_terms(text)[1])]


def brute(rows, items, share=0.8):
    """(doc, item, overlaps) by all items in all of their passages, on plain words."""
    out = {}
    for i, item in items:
        found, terms = plain_terms(item)
        if not terms:
            continue
        parts, stride = plain_parts(item), 1
        while stride < len(found):
            stride *= 2
        for d, text in rows:
            _, grams = plain_terms(text)
            for a in range(0, max(1, len(grams)), stride):
                held = set(grams[a : a + 2 * stride - 4])
                overlaps = [len(p & held) / len(p) for p in parts]
                if min(overlaps) >= share - 1e-9:
                    out.setdefault((d, i), set()).add((round(overlaps[0], 6), round(overlaps[-1], 6)))
    return out


def words(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(n)]


def test_planted_items(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randrange(12, 50))) + ".\n" + " ".join(words(rng, 9)) + ".") for i in range(70)]
    items += [(100, None), (101, "too short"), (None, " ".join(words(rng, 15)))]
    rows = [(0, None), (1, ""), (2, "a b c"), (None, items[3][1])]
    for i in range(60):
        text = words(rng, rng.randrange(300))
        if i % 2:
            item = items[rng.randrange(70)][1].upper().split(" ")
            if i % 3 == 0:
                item[rng.randrange(len(item))] = "changed"
            if i % 5 == 0:
                item = item[: len(item) // 2]
            at = rng.randrange(len(text) + 1)
            text[at:at] = item
        rows.append((10 + i, " ".join(text)))
    rows += [rows[-1], (500, "z1 " * 200_000 + items[0][1])]
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = find_leaks(df, bench).collect()
    want = brute(rows, items)
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(want) and len(want) > 15
    assert all((round(r["question_overlap"], 6), round(r["answer_overlap"], 6)) in want[r["doc_id"], r["item_id"]] for r in found)
    kept = remove_leaks(df, bench)
    assert kept.columns == df.columns
    bad = {d for d, _ in want}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d for d, _ in rows if d not in bad), key=str)
    other = spark.createDataFrame([(rows[-1][0], "another text of one id", 1, "s")], DOCS)
    assert [r["text"] for r in remove_leaks(df.unionByName(other), bench).where(f"doc_id = {rows[-1][0]}").collect()] == ["another text of one id"]


def test_wand_finds_all_above_threshold():
    rng = random.Random(6)
    pool = words(rng, 40)
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(6, 60)))) for i in range(300)]
    index = ItemIndex(items, k=1, share=0.5)
    for _ in range(40):
        some = np.array(sorted(rng.sample(range(len(index.terms)), rng.randrange(1, 20))))
        scores = np.zeros(len(index.ids))
        for t in some:
            s = slice(index.begin[t], index.begin[t + 1])
            scores[index.doc[s]] += index.impact[s]
        want = {d for d in range(len(scores)) if scores[d] >= index.threshold}
        assert {d for d, _ in index.retrieve(some)} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f g", 1, "s")], DOCS)
    assert find_leaks(one, bench).count() == 0 and remove_leaks(one, bench).count() == 1


def test_results_do_not_depend_on_other_items_or_blocks(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, rng.randrange(20, 90))) + ".\n" + " ".join(words(rng, 9)) + ".") for i in range(30)]
    items += [(3, " ".join(words(rng, 30)))]  # an item_id that repeats with another text
    rows = [(i, " ".join(words(rng, 40)) + " " + items[i % 31][1] + " " + " ".join(words(rng, 40))) for i in range(62)]
    pieces = items[4][1].split()
    rows.append((900, " ".join(" ".join(pieces[i : i + 6]) + " " + " ".join(words(rng, 400)) for i in range(0, len(pieces), 5))))
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], DOCS)

    def leaks(some):
        found = find_leaks(docs, spark.createDataFrame(some, "item_id long, text string")).collect()
        return sorted((r["doc_id"], r["item_id"], round(r["score"], 9), r["question_overlap"], r["answer_overlap"]) for r in found)

    whole = leaks(items)
    assert len(whole) == 62 and {r[0] for r in whole} == set(range(62))  # scattered pieces are no passage
    long = (999, " ".join(f"u{rng.randrange(10**9)}" for _ in range(20_000)))
    assert [r[:2] for r in leaks([*items, long])] == [r[:2] for r in whole]
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 2000)
    assert leaks(items) == whole
