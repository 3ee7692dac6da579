"""Secret scans against plain patterns, and strings that are and are not random."""

from __future__ import annotations

import random
import re
import string

import pytest

from rollgraph.llm import secrets
from rollgraph.llm.queries import op13_secrets

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain(text):
    """The patterns as given, with failing matches dropped."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def scan(frame, texts):
    docs = frame([(i, t, "clash", "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string, kind string")
    got = secrets.find_secrets(docs)
    assert got.columns == ["doc_id", "kind", "spans"]
    rows = got.withColumn("spans", secrets.span_text(secrets.F.col("spans"))).orderBy("doc_id").collect()
    return [r.spans.split(",") if r.spans else [] for r in rows]


def test_patterns_equal_plain_search(frame):
    pick = random.Random(4)
    parts = ["token", "Secret", "PASSWORD", "api_key", "apikey", "=", ":", " ", "\"", "'", "  ", "abcdefghijkl", "abc", "é", "文",
             "AKIA", "ABCDEFGHIJKLMN", "AKIAAKIAABCDEFGHIJ", "0123456789abcdef", "deadbeef", "\n", ".", "ſecret", "toKen", "-"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 40))) for _ in range(600)]
    texts += [None, "", "secret: token: abcdefghijklmno", "password=token=abcdefghijkl", "word " * 100_000 + "token=abcdefghijkl"]
    for text, got in zip(texts, scan(frame, texts)):
        assert [s for s in got if not s.startswith("random")] == plain(text)


@pytest.mark.parametrize("alphabet", [string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits])
def test_random_strings_are_found(frame, alphabet):
    pick = random.Random(9)
    keys = ["".join(pick.choice(alphabet) for _ in range(40)) for _ in range(300)]
    got = scan(frame, [f"Ü key {k} end" for k in keys])
    assert sum(any(s.startswith("random:") for s in spans) for spans in got) >= 0.95 * len(keys)


CLEAN = [
    "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "0xD41D8CD98F00B204E9800998ECF8427E",
    "123E4567-E89B-12D3-A456-426614174000", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
    "getHTTPResponseCodeForRequest", "my_very_long_variable_name", "usr/local/lib/python3/site-packages",
    "Donaudampfschifffahrtsgesellschaft", "geeinvererberlichlich", "2024-12-01T12-33-44Z", "ISBN-978-3-16-148410-0",
    "4111-1111-1111-1111", "====================", "----------------------", "application/vnd-openxmlformats",
]


def test_digests_identifiers_and_words_are_left_alone(frame):
    assert scan(frame, [f"see {c}, then" for c in CLEAN]) == [[] for _ in CLEAN]


def test_spans_of_patterns_stay_and_are_not_doubled(frame):
    text = "token = 'Zq8XvK2mPw7RtY4LbN9c' and Zq8XvK2mPw7RtY4LbN9c"
    assert scan(frame, [text]) == [["assign:0:29", "random:35:55"]]


def test_very_long_strings_and_rows_that_repeat(frame):
    pick = random.Random(2)
    long = "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(200_000))
    assert scan(frame, [long, long]) == [["random:0:200000"]] * 2


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_secrets(spark, str(tmp_path))
    assert got.count() == 0 and got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def test_vocabulary_size_is_checked(frame, monkeypatch):
    monkeypatch.setattr(secrets, "VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        secrets.find_secrets(frame([], "doc_id long, text string"))
