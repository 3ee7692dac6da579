"""Fellegi-Sunter weights and scores.

Model of Fellegi and Sunter (1969), estimated by expectation maximisation over
the agreement patterns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.operators.agreement import LinkSettings, agreement_groups
from rollgraph.operators.skew import heavy_from_counts, salted_join
from rollgraph.session import cut_lineage

FLOOR = 1e-6


@dataclass(frozen=True)
class Weights:
    """Share of matches and, per column, the level probabilities for matches
    (``m``) and non-matches (``u``)."""

    prior: float
    m: dict[str, tuple[float, ...]] = field(default_factory=dict)
    u: dict[str, tuple[float, ...]] = field(default_factory=dict)


def starting_weights(settings: LinkSettings) -> Weights:
    """Agreement likely for matches, unlikely for others."""
    m, u = {}, {}
    for c in settings.comparisons:
        up = (0.1, 0.9) if c.equal == 1 else (0.1, 0.2, 0.7)
        m[c.column], u[c.column] = up, tuple(reversed(up))
    return Weights(settings.prior, m, u)


def pattern_counts(groups: DataFrame, settings: LinkSettings) -> DataFrame:
    """Pairs per agreement pattern: at most four levels per compared column."""
    gammas = [f"gamma_{c.column}" for c in settings.comparisons]
    return groups.groupBy(*gammas).agg(F.sum("n_pairs").alias("n_pairs"))


def _kept(values: np.ndarray) -> np.ndarray:
    return np.clip(values, FLOOR, 1.0 - FLOOR)


def estimate_em(patterns: DataFrame, settings: LinkSettings) -> Weights:
    """Weights after ``settings.iterations`` rounds, or once they stand still.

    ``patterns`` has a few rows whatever the number of pairs (four levels per
    column at most), so the rounds run on the driver.  Probabilities are
    clamped, so one lone pattern still gives finite weights.
    """
    columns = [c.column for c in settings.comparisons]
    gammas = [f"gamma_{c}" for c in columns]
    bound = 4 ** len(columns)
    patterns = patterns.groupBy(*gammas).agg(F.sum("n_pairs").cast("double").alias("n_pairs"))
    if patterns.count() > bound:
        raise ValueError(f"more than {bound} patterns: a level outside 0 to 2 or null")
    rows = patterns.collect()
    weights = starting_weights(settings)
    if not rows:
        return weights
    seen = np.array([[r[g] for g in gammas] for r in rows], dtype=int)
    n = np.array([r["n_pairs"] for r in rows], dtype=float)
    prior = weights.prior
    m = {c: np.array(weights.m[c]) for c in columns}
    u = {c: np.array(weights.u[c]) for c in columns}
    for _ in range(settings.iterations):
        log_m, log_u = np.log(prior), np.log(1.0 - prior)
        for i, c in enumerate(columns):
            level, known = seen[:, i], seen[:, i] >= 0
            log_m = log_m + np.where(known, np.log(m[c][level]), 0.0)
            log_u = log_u + np.where(known, np.log(u[c][level]), 0.0)
        match = 1.0 / (1.0 + np.exp(np.clip(log_u - log_m, -700, 700)))
        before = prior
        prior = float(_kept(np.array((match * n).sum() / n.sum())))
        moved = abs(prior - before)
        for i, c in enumerate(columns):
            known = seen[:, i] >= 0
            if not known.any():
                continue
            for table, share in ((m, match), (u, 1.0 - match)):
                mass = np.bincount(
                    seen[known, i], weights=(share * n)[known], minlength=len(table[c])
                )
                total = mass.sum()
                if total > 0:
                    new = _kept(mass / total)
                    moved = max(moved, float(np.abs(new - table[c]).max()))
                    table[c] = new
        if moved < settings.tolerance:
            break
    return Weights(
        prior,
        {c: tuple(map(float, m[c])) for c in columns},
        {c: tuple(map(float, u[c])) for c in columns},
    )


def weights_table(patterns: DataFrame, settings: LinkSettings, weights: Weights) -> DataFrame:
    """Estimated weights with the number of pairs seen at each level."""
    narrow = F.explode(
        F.array(
            *[
                F.struct(F.lit(c.column).alias("column"), F.col(f"gamma_{c.column}").alias("level"))
                for c in settings.comparisons
            ]
        )
    ).alias("l")
    seen = patterns.select("n_pairs", narrow).select("n_pairs", "l.column", "l.level")
    seen = seen.where("level >= 0").groupBy("column", "level").agg(F.sum("n_pairs").alias("n_pairs"))

    def pick(table: dict[str, tuple[float, ...]]) -> Column:
        out = F.lit(None).cast("double")
        for c, probabilities in table.items():
            for at, p in enumerate(probabilities):
                out = F.when((F.col("column") == c) & (F.col("level") == at), F.lit(p)).otherwise(out)
        return out

    return seen.select(
        "column",
        "level",
        "n_pairs",
        F.lit(weights.prior).alias("prior"),
        pick(weights.m).alias("m"),
        pick(weights.u).alias("u"),
    )


def _log_odds(settings: LinkSettings, weights: Weights) -> Column:
    total = F.lit(float(np.log(weights.prior) - np.log(1.0 - weights.prior)))
    for c in settings.comparisons:
        gamma, part = F.col(f"gamma_{c.column}"), F.lit(0.0)
        for at in c.levels:
            bayes = float(np.log(weights.m[c.column][at]) - np.log(weights.u[c.column][at]))
            part = F.when(gamma == at, F.lit(bayes)).otherwise(part)
        total = total + part
    return total


def _probability(log_odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds))


def score(groups: DataFrame, settings: LinkSettings, weights: Weights) -> DataFrame:
    """Add ``match_probability``; a missing value neither helps nor hurts."""
    return groups.withColumn("match_probability", _probability(_log_odds(settings, weights)))


def term_frequencies(records: DataFrame, column: str) -> DataFrame:
    """Share of each value among the records that have one."""
    present = records.where(F.col(column).isNotNull()).select(column)
    total = present.agg(F.count(F.lit(1))).scalar()
    counts = present.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("tf", F.col("n") / total)


def tf_adjust(
    scored: DataFrame, records: DataFrame, settings: LinkSettings, weights: Weights
) -> DataFrame:
    """Add ``tf_match_probability``: equal rare values count for more.

    Where a pair agrees on a value, the chance of that among non-matches is the
    frequency of the value instead of the average ``u``.
    """
    adjusted = [c for c in settings.comparisons if c.term_frequency]
    out, shift = scored, F.lit(0.0)
    for c in adjusted:
        # Common values are split by their counts; rows that agree on none have nothing
        # to meet and are dealt out over many tasks.
        tf = term_frequencies(records, c.column).withColumnRenamed(c.column, "_a")
        agreed = F.when(F.col(f"gamma_{c.column}") == c.equal, F.col(c.column))
        share = tf.select("_a", F.col("tf").alias(f"_tf_{c.column}"))
        heavy = heavy_from_counts(tf, ["_a"], "n")
        out = salted_join(out.withColumn("_a", agreed), share, ["_a"], heavy, scored.columns, "left").drop("_a")
        gain = F.lit(float(np.log(weights.u[c.column][c.equal]))) - F.log(f"_tf_{c.column}")
        shift = shift + F.coalesce(gain, F.lit(0.0))
    return out.withColumn(
        "tf_match_probability", _probability(_log_odds(settings, weights) + shift)
    ).drop(*[f"_tf_{c.column}" for c in adjusted])


def scored_comparisons(
    records: DataFrame, settings: LinkSettings, weights: Weights | None = None
) -> DataFrame:
    """Blocking, comparison, estimation, scores and term frequencies in one go.

    Without ``weights`` they are estimated from the pattern counts first.
    """
    groups = agreement_groups(records, settings)
    if weights is None:
        groups = cut_lineage(groups)
        weights = estimate_em(pattern_counts(groups, settings), settings)
    return tf_adjust(score(groups, settings, weights), records, settings, weights)
