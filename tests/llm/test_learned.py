"""Quality and language models: held-out accuracy, and odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollgraph.llm import language_id, quality

EN = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split()


def texts(n, seed=3):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices((EN, DE)[i % 2], k=40)), ("en", "de")[i % 2], "clash") for i in range(n)]


DOCS = "doc_id long, text string, lang string, score string"


def test_language_of_held_out_rows(frame):
    odd = [(1000, None, "en", ""), (1001, "", None, ""), (1002, "12 34 !", "de", ""), (None, "the and of it is", "en", "")]
    docs = frame(texts(200) + odd, DOCS)
    field = language_id.learn_languages(docs.where(language_id.fold("doc_id", 5) != 0))
    held = language_id.fold("doc_id", 5) == 0
    found = language_id.predict_languages(docs.withColumn("held", held), field, ("doc_id", "lang", "held")).collect()
    assert len(found) == 204
    assert all(r["lang_pred"] == r["lang"] for r in found if r["doc_id"] is not None and r["doc_id"] < 200)
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found if (r["doc_id"] or 0) >= 1000} == {k: ("und", 0.0) for k in (1000, 1001, 1002)}
    assert all(0 <= r["score"] <= 1 for r in found)
    mixed = language_id.word_languages(" ".join(EN[:12] + DE[:12]), field)
    right = sum(lang == ("en" if i < 12 else "de") for i, (_, lang) in enumerate(mixed))
    assert len(mixed) == 24 and right >= 20


def test_languages_without_rows(frame):
    none = frame([], DOCS)
    assert language_id.learn_languages(none) is None
    got = language_id.predict_languages(frame(texts(2), DOCS), None).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2


def test_quality_of_held_out_rows(frame):
    rng = random.Random(4)
    good = lambda: ". ".join(" ".join(rng.choices(EN, k=9)).capitalize() for _ in range(6)) + "."
    bad = lambda: " ".join(rng.choices(["$$$", "CLICK", "win!!!", "#1", ">>"], k=50))
    rows = [(i, good() if i % 2 else bad(), "", "") for i in range(300)]
    odd = [(1000, None, "", ""), (1001, "", "", ""), (None, "the and of", "", ""), (1, rows[1][1], "", "")]
    docs = frame(rows + odd, DOCS)
    labels = frame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, quality int")
    held = language_id.fold("doc_id", 3) == 1
    model, prior = quality.learn_quality(docs, labels.where(~F.coalesce(held, F.lit(False))))
    got = quality.score_quality(docs, model, prior, held).collect()
    assert len(got) == 304 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    judged = [r["predicted"] == r["doc_id"] % 2 for r in got if r["held_out"] and r["doc_id"] < 300]
    assert judged and sum(judged) >= 0.95 * len(judged)


def test_quality_without_labels(frame):
    docs = frame(texts(3), DOCS)
    model, prior = quality.learn_quality(docs, frame([], "doc_id long, quality int"))
    assert model is None
    assert [r["score"] for r in quality.score_quality(docs, model, prior).collect()] == [prior] * 3
    assert quality.score_quality(frame([], DOCS), model, prior).count() == 0


def accuracy(frame, rows):
    field = language_id.learn_languages(frame(rows, DOCS).where("doc_id % 4 <> 0"))
    found = language_id.predict_languages(frame([r for r in rows if r[0] % 4 == 0], DOCS), field, ("doc_id", "lang")).collect()
    return field, sum(r["lang"] == r["lang_pred"] for r in found) / len(found)


def test_words_that_differ_late(frame):
    """Languages whose words agree for their first 40 bytes and their last 10."""
    rng = random.Random(6)
    made = [["q" * 40 + "".join(rng.choices(letters, k=12)) + "z" * 10 for _ in range(400)] for letters in ("abc", "def")]
    rows = [(i, " ".join(rng.choices(made[i % 2], k=30)), "xy"[i % 2], "") for i in range(160)]
    assert accuracy(frame, rows)[1] > 0.95


def test_many_languages_are_all_learned(frame):
    rng = random.Random(7)
    made = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30)] for _ in range(40)]
    rows = [(i, " ".join(rng.choices(made[i // 16], k=30)), f"l{i // 16}", "") for i in range(640)]
    field, right = accuracy(frame, rows)
    assert len(field.labels) == 40 and right > 0.9


def test_words_come_from_the_whole_text(frame):
    """The first 20,000 words of each text are the same; the language shows behind them."""
    head = "000 " * 20_000
    rows = [(i, head + " ".join(random.Random(i).choices((EN, DE)[i % 2], k=20_000)), ("en", "de")[i % 2], "") for i in range(12)]
    field = language_id.learn_languages(frame(rows, DOCS), 12)
    assert all(lang == "en" for _, lang in language_id.word_languages(" ".join(EN[:10]), field)[2:])


def test_forward_backward_equals_a_plain_loop():
    rng = np.random.default_rng(8)
    k, sizes = 3, [0, 1, 2, 33, 0, 700, 5000]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    emit = rng.random((bounds[-1], k)).astype(np.float32) + 1e-3
    moves, first = rng.random((k, k)).astype(np.float32) + 0.05, np.full(k, 1 / k, np.float32)
    got = language_id.posteriors(emit, moves, first, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        alpha, beta = np.zeros((b - a, k)), np.ones((b - a, k))
        for t in range(b - a):
            alpha[t] = emit[a + t] * (first if t == 0 else alpha[t - 1] @ moves)
            alpha[t] /= alpha[t].sum()
        for t in range(b - a - 2, -1, -1):
            beta[t] = moves @ (emit[a + t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        want = alpha * beta
        assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True), atol=1e-4)


def test_weights_equal_a_plain_sum():
    rng = np.random.default_rng(9)
    raw = bytes(rng.integers(97, 123, 3000).astype(np.uint8))
    data = np.frombuffer(raw, np.uint8)
    start = np.sort(rng.integers(0, 2900, 80))
    end = start + rng.integers(1, 90, 80)
    table = rng.random((language_id.HASHED + 1, 3)).astype(np.float32)
    table[-1] = 0
    want = np.zeros((80, 3))
    for i, (a, b) in enumerate(zip(start, end)):
        part = [np.array([c], np.uint32) for c in raw[a:b]]
        grams = [(k, part[:k]) for k in (1, 2, 3) if b - a >= k] + [(10 + k, part[::-1][:k]) for k in (1, 2, 3, 4) if b - a >= k]
        grams += [(20 + k, part[j : j + k]) for k in (2, 3) for j in range(b - a - k + 1)]
        want[i] = sum(table[int(language_id._hashed(kind, *g)[0])] for kind, g in grams)
    for cells in (1 << 20, 3072):
        language_id._CELLS, kept = cells, language_id._CELLS
        assert np.allclose(language_id._weights(data, start, end, table), want, rtol=1e-4)
        language_id._CELLS = kept


def test_language_of_odd_tables(frame):
    docs = frame(texts(60), DOCS)
    field = language_id.learn_languages(docs)
    assert language_id.predict_languages(frame([], DOCS), field).count() == 0
    again = language_id.learn_languages(docs.unionByName(docs).repartition(7))  # repeated rows, another order
    assert np.array_equal(field.hashed, again.hashed) and field.labels == again.labels
    long = " ".join(DE * 4000)
    rows = [(1, long, "x", "clash"), (1, long, "x", "clash"), (2, "the der", "x", "clash")]
    got = language_id.predict_languages(frame(rows, DOCS), field, ("doc_id", "score", "lang_pred")).collect()
    assert [r["lang_pred"] for r in got[:2]] == ["de", "de"] and got[0] == got[1] and got[0].asDict().keys() == {"doc_id", "lang_pred", "score"}
    tied = language_id.predict_languages(frame([(1, "qqq", "", "")], DOCS), language_id.Field(
        ["a", "b"], np.zeros((language_id.HASHED + 1, 2), np.float32), np.zeros(0, np.uint64), np.zeros((1, 2), np.float32),
        np.ones((2, 2), np.float32), np.full(2, 0.5, np.float32))).first()
    assert (tied["lang_pred"], tied["score"]) == ("a", 0.5)


def plain_risk(model, positive, unlabelled, prior):
    loss = lambda s, y: np.log1p(np.exp(-y * s))
    sp, su = ([float(model.inputs(x[None])[0] @ model.weights + model.bias) for x in xs] for xs in (positive, unlabelled))
    plus, minus = (sum(loss(s, y) for s in sp) / len(sp) for y in (1, -1))
    return prior * plus + max(0.0, sum(loss(s, -1) for s in su) / len(su) - prior * minus)


def test_fit_lowers_the_plain_risk_and_steps_follow_its_gradient():
    rng = np.random.default_rng(10)
    positive, negative = rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (300, 3))
    unlabelled = np.concatenate([rng.normal(1, 1, (180, 3)), negative[:120]])
    start = quality.fit_nnpu(positive, unlabelled, 0.6, steps=0)
    trained = quality.fit_nnpu(positive, unlabelled, 0.6)
    assert plain_risk(trained, positive, unlabelled, 0.6) < 0.6 * plain_risk(start, positive, unlabelled, 0.6)
    right = [(trained.scores(x) >= 0.5).mean() for x in (positive, negative)]
    assert right[0] > 0.85 and right[1] < 0.15
    # The first Adam step moves every weight by the rate, against the sign of the risk's slope.
    step, width = quality.fit_nnpu(positive, unlabelled, 0.6, steps=1), 1e-4
    for i in range(len(start.weights)):
        up, down = ([*start.weights] for _ in "ud")
        up[i] += width
        down[i] -= width
        risks = [plain_risk(quality.Classifier(start.mean, start.scale, np.array(x), start.bias), positive, unlabelled, 0.6) for x in (up, down)]
        assert np.sign(step.weights[i]) == -np.sign(risks[0] - risks[1])


@pytest.mark.parametrize("share", [0.3, 0.7])
def test_prior_from_positives_and_unlabelled_rows(share):
    rng = np.random.default_rng(11)
    positive = rng.normal(1.5, 1, (3000, 4))
    some = int(3000 * share)
    unlabelled = np.concatenate([rng.normal(1.5, 1, (some, 4)), rng.normal(-1.5, 1, (3000 - some, 4))])
    assert abs(quality.estimate_prior(positive, unlabelled) - share) < 0.08


def test_quality_ignores_negatives_and_repeated_rows(frame):
    rows = [(i, " ".join(EN[: 3 + i % 20]), "", "") for i in range(60)]
    docs = frame(rows + rows[:30], DOCS)
    positives = [(i, 1) for i in range(0, 60, 2)]
    found = [quality.learn_quality(docs, frame(positives + more, "doc_id long, quality int")) for more in ([], [(1, 0), (3, 0)], positives)]
    assert all(np.array_equal(found[0][0].weights, m.weights) and p == found[0][1] for m, p in found)
    long = frame([(1, "a b. " * 200_000, "", "clash"), (1, "a b. " * 200_000, "", "clash")], DOCS)
    scores = [r["score"] for r in quality.score_quality(long, *found[0]).collect()]
    assert scores[0] == scores[1] and 0 <= scores[0] <= 1
