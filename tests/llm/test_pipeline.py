"""Every stage of the pipeline on planted rows."""

from __future__ import annotations

import random

import corpus_pipeline

EN = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat".split()

DOCS = "doc_id long, url string, text string, lang string, source string, n_chars long"
ITEM = "Which of these metals melts first when heated slowly in a furnace today?\nGallium melts before copper, iron and tungsten do."


def planted():
    rng = random.Random(9)
    rows = []
    for i in range(80):
        text = " ".join(rng.choices((EN, DE)[i % 2], k=60)) + f" id{i}"
        rows.append((i, text))
    line = "this very line is found in all of these documents"
    rows += [(100 + i, f"{rows[i][1][::2]} {line}".replace(f" {line}", f"\n{line}")) for i in (0, 2, 4)]
    rows += [(200, rows[6][1] + " more"), (201, rows[8][1] + " " + ITEM), (202, "123 456"), (203, None)]
    return [(i, "u", t, ("en", "de")[i % 2], ("a", "b", None)[i % 3], len(t or "")) for i, t in rows]


def test_stages(spark, frame, tmp_path):
    frame(planted(), DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    frame([(1, ITEM)], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = kept["language_id"]
    assert {202, 203}.isdisjoint(first) and set(range(80)) | {200, 201} <= set(first)
    lines = kept["line_dedup"]
    assert set(lines) == set(first)
    marked = [i for i in (100, 102, 104) if i in first]
    if len(marked) == 3:
        assert ["\n" in lines[i] for i in marked] == [False, False, True]
    assert set(lines) - set(kept["near_copies"]) == {200}
    assert set(kept["near_copies"]) - set(kept["decontaminate"]) == {201}
    assert set(range(80)) <= set(kept["decontaminate"])
    assert set(kept["mix_sources"]) <= set(kept["decontaminate"])


def test_empty_tables(spark, frame, tmp_path):
    frame([], DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    frame([], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_names(spark, frame, tmp_path):
    """Against what each stage is to do: names kept, rows of one doc_id apart, copies once."""
    rng = random.Random(3)
    clash = ["score", "lang_pred", "kept", "n_lines", "n_dropped", "_doc", "_lost", "body", "label", "_id", "rank", "_hash"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in clash)
    own = lambda i: " ".join(rng.choices((EN, DE)[i % 2], k=50)) + f" id{i}"
    texts = {i: own(i) for i in range(60)}
    rows = [(i, t, ("en", "de")[i % 2]) for i, t in texts.items()]
    rows += [(7, texts[7], "de"), (7, texts[7], "de")]  # rows that repeat
    rows += [(8, own(0), "en"), (None, own(1), "de")]  # one id, two texts; no id
    rows += [(300, texts[9] + " tail", "de"), (301, texts[10] + " " + ITEM, "en"), (302, None, "en")]
    rows += [(8, own(2) + " " + ITEM, "en")]  # only this text of id 8 leaks
    long = " ".join(rng.choices(EN, k=40_000))
    rows += [(400, long, "en")] + [(i, "only one line that all of these documents have", "en") for i in (500, 501, 502)]
    frame([(*r, "s", *clash) for r in rows], schema).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    frame([(1, ITEM)], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = sorted([(i, t) for i, t, _ in rows if i != 302], key=str)
    after = {
        "language_id": lambda x: True,
        "line_dedup": lambda x: x[0] not in (500, 501),  # the largest holder keeps the line
        "near_copies": lambda x: x[0] != 300,
        "decontaminate": lambda x: ITEM not in x[1],
        "mix_sources": lambda x: True,
    }
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[: len(columns)] == columns
        want = [x for x in want if after[name](x)]
        if name == "near_copies":
            want = sorted(set(want), key=str)
        got = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        assert got == want, name
        assert all(r[c] == c for r in docs.select(*clash).collect() for c in clash)
