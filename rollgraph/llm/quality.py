"""Quality classifier by non-negative positive-unlabelled learning (operator 1).

Trusted positives and unlabelled web text give the risk of a classifier without any
negative: pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)), where pi is the class prior.
The non-negative form steps back whenever the estimated negative risk falls below
zero, which keeps a flexible model from fitting the unlabelled rows as negatives.
The prior is estimated from positives and unlabelled rows alone (best bin estimation,
Garg et al. 2021): a classifier of the two, fitted on each half, ranks the other half; of
all top shares of the ranking the one is taken where the unlabelled share over the
positive share, with their standard errors, is least.  No label of a negative is used.

Features are about a text's shape only: lengths, character classes, repetition of
words and lines, and the frequency of every ASCII character that is no letter.

Training reads about ``SAMPLE`` positives and ``SAMPLE`` unlabelled rows, those whose id
hashes below a threshold; scoring is one pass over all whole texts without a shuffle.

Cases: null texts are empty texts and get a score, too; repeated rows are scored
each, but learned from once for each id; a null doc_id is never learned from; without
positives every score is ``PRIOR``; ties are no matter, a row's score is its own; texts of
any length are read whole; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import words as w

SAMPLE = 6000
PRIOR = 0.5
STEPS = 600
_SIGNS = np.array([c for c in range(33, 127) if not chr(c).isalpha()])
_CLASSES = ("upper", "lower", "digit", "high", "blank", "newline")
_MASKS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256),
    "blank": (9, 11, 12, 13, 32), "newline": (10,),
}


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def shape_features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    rows = len(bounds) - 1
    size = np.diff(bounds).astype(float)
    found = w.find_words(data, bounds)
    hashes = w.word_hashes(found)
    n = np.diff(found.first).astype(float)
    some, per = np.maximum(n, 1), np.maximum(size, 1)
    columns = [np.log1p(size), np.log1p(n), size / some, n == 0]
    for name in _CLASSES:
        mask = np.zeros(256, bool)
        mask[list(_MASKS[name])] = True
        columns.append(_sums(mask[data], bounds) / per)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    width = np.zeros(256, np.int64)
    width[_SIGNS] = np.arange(1, len(_SIGNS) + 1)
    sign = width[data]
    at = np.flatnonzero(sign)
    grid = np.bincount(row[at] * len(_SIGNS) + sign[at] - 1, minlength=rows * len(_SIGNS)).reshape(rows, -1)
    columns += list(np.log1p(50 * grid.T / some))
    owner = found.rows
    if len(hashes):
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((hashes, owner))
        new = w.first_of_runs(owner[order], hashes[order])
        starts = np.flatnonzero(new)
        runs = np.diff(np.append(starts, len(order)))
        most = np.zeros(rows)
        np.maximum.at(most, owner[order][starts], runs)
        distinct = np.bincount(owner[order][starts], minlength=rows)
        length = (found.end - found.start).astype(float)
        mean = np.bincount(owner, length, minlength=rows) / some
        spread = np.sqrt(np.maximum(np.bincount(owner, length * length, minlength=rows) / some - mean * mean, 0))
        first, last = data[found.start], data[found.end - 1]
        capital = np.bincount(owner, (first >= 65) & (first <= 90), minlength=rows) / some
        closed = np.bincount(owner, w.NOT_ALNUM[last], minlength=rows) / some
        repeated = np.bincount(owner, same, minlength=rows) / some
        columns += [repeated, most / some, distinct / some, distinct / np.sqrt(some), mean, spread, capital, closed]
    else:
        columns += [np.zeros(rows)] * 8
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class Classifier:
    """A logistic model over standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def inputs(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z / 6], axis=1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(features) @ self.weights + self.bias, -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, rate: float = 0.02) -> Classifier:
    """Minimise the non-negative risk with the logistic loss by Adam steps."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    model = Classifier(mean, scale, np.zeros(2 * both.shape[1]), float(np.log(prior / (1 - prior))))
    xp, xu = model.inputs(positive), model.inputs(unlabelled)
    first, second = np.zeros(len(model.weights) + 1), np.zeros(len(model.weights) + 1)
    for step in range(1, steps + 1):
        sp, su = xp @ model.weights + model.bias, xu @ model.weights + model.bias
        chance_p, chance_u = 1 / (1 + np.exp(-np.clip(sp, -30, 30))), 1 / (1 + np.exp(-np.clip(su, -30, 30)))
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        # d/ds of the losses: log(1 + exp(-s)) for positives, log(1 + exp(s)) for negatives
        up, un = (chance_p - 1) / len(xp), chance_u / len(xu)
        pn = chance_p / len(xp)
        if negative >= 0:
            g = prior * (xp.T @ up) + xu.T @ un - prior * (xp.T @ pn)
            g0 = prior * up.sum() + un.sum() - prior * pn.sum()
        else:  # step back from the fit of the negative part
            g, g0 = prior * (xp.T @ pn) - xu.T @ un, prior * pn.sum() - un.sum()
        grad = np.append(g + 1e-4 * model.weights, g0)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= move[-1]
    return model


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among ``unlabelled``, from the two samples of features."""
    if min(len(positive), len(unlabelled)) < 4:
        return PRIOR
    mixed = np.random.default_rng(5)  # rows in the order of their ids may alternate
    positive, unlabelled = mixed.permutation(positive), mixed.permutation(unlabelled)
    shares = []
    for fit, rank in ((0, 1), (1, 0)):
        model = fit_nnpu(positive[fit::2], unlabelled[fit::2], 0.5, 200)
        p, u = np.sort(model.scores(positive[rank::2])), np.sort(model.scores(unlabelled[rank::2]))
        cuts = np.unique(p)
        above_p = 1 - np.searchsorted(p, cuts) / len(p)
        above_u = 1 - np.searchsorted(u, cuts) / len(u)
        slack = 0.5 / np.sqrt(len(p)) + 0.5 / np.sqrt(len(u))  # the greatest standard errors of both shares
        best = int(((above_u + slack) / above_p).argmin())
        shares.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(shares), 0.01, 0.99))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [shape_features(data, bounds) for _, _, data, bounds in w.text_slices(batch.column(2))]
        if parts:
            rows = [x.tobytes() for part in parts for x in part]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.binary())], names=["_id", "positive", "features"])


def _score_batches(batches: Iterator[pa.RecordBatch], model: Classifier | None, prior: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = []
        for _, _, data, bounds in w.text_slices(batch.column(2)):
            scores.append(model.scores(shape_features(data, bounds)) if model else np.full(len(bounds) - 1, prior))
        scores = np.concatenate(scores) if scores else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(scores.astype(float)), pa.array((scores >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )


def learn_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Classifier | None, float]:
    """(model, prior) from (doc_id, quality) rows; pass only labels to learn from."""
    known = labels.where("doc_id IS NOT NULL AND quality = 1").select(F.col("doc_id").cast("long").alias("_id"))
    positives = known.distinct().count()
    texts = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), "text")
    rows = texts.count()
    if not positives or not rows:
        return None, PRIOR
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / (1 << 30)
    # About ``sample`` ids: a number that does not grow with the data.
    trusted = known.where(place < sample / positives).distinct()
    chosen = texts.join(F.broadcast(trusted), "_id", "left_semi").select("_id", F.lit(True).alias("positive"), "text")
    web = texts.where(place < sample / rows).select("_id", F.lit(False).alias("positive"), "text")
    found = chosen.unionByName(web).mapInArrow(_feature_batches, "_id long, positive boolean, features binary")
    found = sorted(found.groupBy("_id", "positive").agg(F.min("features").alias("features")).collect())
    grids = [np.array([np.frombuffer(r["features"], np.float32) for r in found if r["positive"] is k], float) for k in (True, False)]
    if not len(grids[0]) or not len(grids[1]):
        return None, PRIOR
    prior = estimate_prior(*grids)
    return fit_nnpu(*grids, prior), prior


def score_quality(documents: DataFrame, model: Classifier | None, prior: float, held_out=None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; score 0 to 1."""
    held = F.lit(False) if held_out is None else held_out
    given = documents.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(lambda it: _score_batches(it, model, prior), f"doc_id {kind}, held_out boolean, score double, predicted int")
