"""Line dedup against a dictionary of lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollgraph.llm.line_dedup import LineRuns, drop_repeated_lines, line_keys

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def expected(rows):
    docs = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                docs.setdefault(key(line), set()).add(-(1 << 63) if d is None else d)
    holder = {k: max(v) for k, v in docs.items() if len(v) >= 3}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        mine = -(1 << 63) if d is None else d
        kept = [x for x in lines if len(key(x)) < 20 or mine >= holder.get(key(x), mine)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "h", 3, "k") for d, t in rows], "doc_id long, text string, h1 string, doc int, key string")
    kept = drop_repeated_lines(df.repartition(3))
    assert kept.columns[:5] == df.columns
    return sorted((tuple(r) for r in kept.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def test_cases(spark):
    long = "A line of twenty code points é"
    rows = [
        (1, f"{long}\nx\n{long}"), (2, f"\t{long.upper().replace('É', 'é')} \r\n"), (2, f"\t{long.upper().replace('É', 'é')} \r\n"),
        (3, f"y\n {long}"), (9, f"{long}\n{long}"), (4, None), (5, ""), (6, "\n\n"), (None, f"{long}\nz"),
        (7, "only in two documents, here"), (8, "only in two documents, here"), (10, "short\n" * 5), (11, "short"), (12, "short"),
        (2, f"another text of one id\n{long}\nend"), (3, f"{long}\n" * 400 + "last\n" * 400 + long),
        (13, "w" * 2_000_000 + "\n" + long), (14, "\x0b nineteen code point"), (15, "nineteen code point"), (16, "nineteen code point"),
    ]
    assert run(spark, rows) == expected(rows)


def test_many_batches(spark):
    rows = [(i, "\n".join(f"line number {(i * j) % 37} of the repeated ones" for j in range(8))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3, 7):
        kept = drop_repeated_lines(df, batches=batches).select("doc_id", "n_lines", "n_dropped", "kept")
        assert sorted(tuple(r) for r in kept.collect()) == sorted(expected(rows))


def test_runs_are_compacted(spark):
    runs = LineRuns(spark, fanout=2)
    docs = spark.range(40).select((F.lit(100) - F.col("id")).alias("doc_id"), F.lit("the same line in all of them").alias("text"))
    for k in range(5):
        runs.add(line_keys(docs.where((F.col("doc_id") <= 100 - 8 * k) & (F.col("doc_id") > 92 - 8 * k))))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert [(r["n"], r["holder"]) for r in runs.merged().collect()] == [(40, 100)]
    runs.drop()


def test_empty_table(spark):
    assert run(spark, []) == []


def test_runs_are_dropped_after_a_failure(spark, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(LineRuns, "merged", lambda self, names=None: 1 / 0)
    try:
        run(spark, [(1, "a line of more than twenty letters")])
    except ZeroDivisionError:
        pass
    assert {t.name for t in spark.catalog.listTables()} == before
