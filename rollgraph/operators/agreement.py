"""Candidate pairs and their agreement levels without listing the pairs (L2, L3).

Blocking rules such as "same zip or same city" describe a set of record pairs
that grows with the square of a block.  A score depends on a pair only through
its agreement pattern and the values agreed on, so pairs are kept in groups:
one row per pattern and agreed values, with the exact number of pairs.

Levels of a column: -1 one side is missing, 0 the values differ, then, if the
column has a similarity threshold, 1 similar and 2 equal, else 1 equal.

The counts need no pairs.  n records with equal values form n (n - 1) / 2 of
them, so grouping by every subset of columns counts the pairs that agree on
*at least* these columns; inclusion and exclusion over the columns turns this
into the pairs that agree on *exactly* these.  Similar values come from
``similar_values`` and enter with the product of the two record counts.  All
of it is partial aggregation: a block or a group of copies of any size costs
one row per distinct value combination.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.operators.similar import similar_values
from rollgraph.operators.skew import ROW_TAG, heavy_from_counts, row_tag, salted_join
from rollgraph.session import cut_lineage

MISSING, DIFFERENT = -1, 0
COUNT = "decimal(38,0)"


@dataclass(frozen=True)
class Comparison:
    """A compared column; ``similarity`` is the Jaro-Winkler level, if any."""

    column: str
    term_frequency: bool = False
    similarity: float | None = None

    @property
    def equal(self) -> int:
        return 1 if self.similarity is None else 2

    @property
    def levels(self) -> range:
        return range(self.equal + 1)


@dataclass(frozen=True)
class LinkSettings:
    """One deduplication run: what is compared and which pairs are candidates.

    ``rules`` are tuples of columns; a pair is a candidate if all columns of
    one of them are equal.
    """

    comparisons: tuple[Comparison, ...]
    rules: tuple[tuple[str, ...], ...]
    id_column: str = "unique_id"
    retain: tuple[str, ...] = ("filing_num",)
    iterations: int = 20
    tolerance: float = 0.0
    prior: float = 0.3

    @property
    def fixed(self) -> tuple[str, ...]:
        """Columns that every rule asks for: equal in all candidate pairs."""
        return tuple(c for c in self.rules[0] if all(c in rule for rule in self.rules[1:]))

    @property
    def free(self) -> tuple[str, ...]:
        """The other columns that are compared or named by a rule."""
        named = [c.column for c in self.comparisons] + [c for r in self.rules for c in r]
        return tuple(dict.fromkeys(c for c in named if c not in self.fixed))

    def comparison(self, column: str) -> Comparison:
        return next((c for c in self.comparisons if c.column == column), Comparison(column))


def level(column: Comparison, left: Column, right: Column, similarity: Column | None = None) -> Column:
    """Agreement level of one pair of values."""
    out = F.when(left.isNull() | right.isNull(), F.lit(MISSING)).when(
        left == right, F.lit(column.equal)
    )
    if column.similarity is not None:
        out = out.when(similarity >= column.similarity, F.lit(1))
    return out.otherwise(F.lit(DIFFERENT))


def block_members(records: DataFrame, settings: LinkSettings) -> DataFrame:
    """Every record once per rule it has values for, with the size of its block.

    The members of a block are its pairs in linear space: any two records with
    equal ``rule`` and ``block`` are candidates.
    """
    blocks = F.array(
        *[
            F.struct(
                F.lit(i).alias("rule"),
                F.when(
                    reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule]),
                    F.to_json(F.array(*[F.col(c).cast("string") for c in rule])),
                ).alias("block"),
            )
            for i, rule in enumerate(settings.rules)
        ]
    )
    member = (
        records.select(settings.id_column, *settings.retain, F.explode(blocks).alias("b"))
        .select("b.rule", "b.block", settings.id_column, *settings.retain)
        .where(F.col("block").isNotNull())
    )
    sizes = member.groupBy("rule", "block").agg(F.count(F.lit(1)).alias("size"))
    heavy = heavy_from_counts(sizes, ["rule", "block"], "size")
    sized = salted_join(row_tag(member), sizes, ["rule", "block"], heavy, [ROW_TAG]).drop(ROW_TAG)
    return sized.withColumn(
        "pairs", (F.col("size").cast(COUNT) * (F.col("size") - 1) / 2).cast(COUNT)
    )


# How a free column may be constrained while counting.
_EQUAL, _SIMILAR, _BOTH, _ANY = "equal", "similar", "both", "any"


def _allowed(settings: LinkSettings, equal) -> Column:
    """True where some rule has all its free columns equal."""
    rules = [[equal(c) for c in rule if c not in settings.fixed] for rule in settings.rules]
    if any(not rule for rule in rules):
        return F.lit(True)
    every = [reduce(lambda a, b: a & b, rule) for rule in rules]
    return reduce(lambda a, b: a | b, every)


def _at_least(records: DataFrame, settings: LinkSettings) -> DataFrame:
    """Records counted by every choice of constraint for the free columns."""
    fixed, free = settings.fixed, settings.free
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fixed], F.lit(True))
    rows = records.where(known).groupBy(*fixed, *free).agg(F.count(F.lit(1)).alias("_n"))
    for c in free:
        value = F.col(c)
        nothing = F.when(F.lit(False), value)

        def option(name: str, key: Column) -> Column:
            return F.struct(F.lit(name).alias("q"), key.alias("k"))

        present = F.array(option(_EQUAL, value), option(_BOTH, nothing), option(_ANY, nothing))
        options = F.when(value.isNotNull(), present).otherwise(F.array(option(_ANY, nothing)))
        rows = rows.withColumn("_o", F.explode(options)).withColumns(
            {f"_q_{c}": F.col("_o.q"), f"_k_{c}": F.col("_o.k")}
        ).drop("_o")
    keys = [f"_q_{c}" for c in free] + [f"_k_{c}" for c in free]
    return rows.groupBy(*fixed, *keys).agg(F.sum("_n").alias("_n"))


def _similar_counts(counted: DataFrame, records: DataFrame, settings: LinkSettings) -> DataFrame | None:
    """Ordered pairs that are similar on some columns, for every such set of columns."""
    fuzzy = [c for c in settings.free if settings.comparison(c).similarity is not None]
    fixed = list(settings.fixed)
    found = {}
    for c in fuzzy:
        near = similar_values(records, fixed, c, settings.comparison(c).similarity)
        both_ways = F.array(
            F.struct(F.col("value_l").alias("a"), F.col("value_r").alias("b")),
            F.struct(F.col("value_r").alias("a"), F.col("value_l").alias("b")),
        )
        found[c] = near.select(*fixed, F.explode(both_ways).alias("_w")).select(
            *fixed, F.col("_w.a").alias(f"_k_{c}"), F.col("_w.b").alias(f"_m_{c}")
        )
    parts = []
    for size in range(1, len(fuzzy) + 1):
        for chosen in combinations(fuzzy, size):
            parts.append(_similar_on(counted, settings, chosen, found))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _similar_on(counted: DataFrame, settings: LinkSettings, chosen: Sequence[str], found: dict) -> DataFrame:
    fixed, free = list(settings.fixed), settings.free
    side = counted.where(reduce(lambda a, b: a & b, [F.col(f"_q_{c}") == _EQUAL for c in chosen]))
    others = [c for c in free if c not in chosen]
    left = side
    for c in chosen:
        left = left.join(found[c], [*fixed, f"_k_{c}"])
    right = side.select(
        *[F.col(c).alias(f"_r_{c}") for c in fixed],
        *[F.col(f"_q_{c}").alias(f"_rq_{c}") for c in others],
        *[F.col(f"_k_{c}").alias(f"_rk_{c}") for c in free],
        F.col("_n").alias("_n_r"),
    )
    on = [F.col(c) == F.col(f"_r_{c}") for c in fixed]
    on += [F.col(f"_m_{c}") == F.col(f"_rk_{c}") for c in chosen]
    for c in others:
        on += [F.col(f"_q_{c}") == F.col(f"_rq_{c}")]
        on += [F.col(f"_k_{c}").eqNullSafe(F.col(f"_rk_{c}"))]
    met = left.join(right, on)
    columns = [F.col(c) for c in fixed]
    for c in free:
        if c in chosen:
            columns += [
                F.lit(_SIMILAR).alias(f"_q_{c}"),
                F.least(f"_k_{c}", f"_m_{c}").alias(f"_k_{c}"),
                F.greatest(f"_k_{c}", f"_m_{c}").alias(f"_k2_{c}"),
            ]
        else:
            columns += [F.col(f"_q_{c}"), F.col(f"_k_{c}"), F.lit(None).cast("string").alias(f"_k2_{c}")]
    product = F.col("_n").cast("decimal(19,0)") * F.col("_n_r").cast("decimal(19,0)")
    return met.select(*columns, product.cast(COUNT).alias("_pairs2"))


def agreement_groups(records: DataFrame, settings: LinkSettings) -> DataFrame:
    """All candidate pairs, grouped by agreement pattern and agreed values.

    Columns: the columns every rule asks for; per free column ``gamma_<c>`` and
    ``<c>`` (the value agreed on, else null), for columns with a similarity
    level also ``<c>_l`` and ``<c>_r`` (the two similar values); ``n_pairs``.
    Pairs are unordered and each is counted in exactly one row.
    """
    fixed, free = settings.fixed, settings.free
    counted = _at_least(records, settings)
    if any(settings.comparison(c).similarity is not None for c in free):
        counted = cut_lineage(counted)  # read three times from here on
    n = F.col("_n").cast("decimal(19,0)")
    base = counted.where(_allowed(settings, lambda c: F.col(f"_q_{c}") == _EQUAL)).where("_n > 1")
    columns = [F.col(c) for c in fixed]
    for c in free:
        columns += [F.col(f"_q_{c}"), F.col(f"_k_{c}"), F.lit(None).cast("string").alias(f"_k2_{c}")]
    rows = base.select(*columns, (n * (n - 1)).cast(COUNT).alias("_pairs2"))
    similar = _similar_counts(counted, records, settings)
    if similar is not None:
        similar = similar.where(_allowed(settings, lambda c: F.col(f"_q_{c}") == _EQUAL))
        rows = rows.unionByName(similar)
    for c in free:
        top = settings.comparison(c).equal
        key, key2 = F.col(f"_k_{c}"), F.col(f"_k2_{c}")
        no_key, no_key2 = F.when(F.lit(False), key), F.when(F.lit(False), key2)

        def term(gamma: int, sign: int, k: Column, k2: Column) -> Column:
            return F.struct(
                F.lit(gamma).alias("g"), F.lit(sign).alias("s"), k.alias("k"), k2.alias("k2")
            )

        terms = (
            F.when(
                F.col(f"_q_{c}") == _EQUAL,
                F.array(term(top, 1, key, no_key2), term(DIFFERENT, -1, no_key, no_key2)),
            )
            .when(
                F.col(f"_q_{c}") == _SIMILAR,
                F.array(term(1, 1, key, key2), term(DIFFERENT, -1, no_key, no_key2)),
            )
            .when(
                F.col(f"_q_{c}") == _BOTH,
                F.array(
                    term(DIFFERENT, 1, no_key, no_key2), term(MISSING, -1, no_key, no_key2)
                ),
            )
            .otherwise(F.array(term(MISSING, 1, no_key, no_key2)))
        )
        rows = (
            rows.withColumn("_t", F.explode(terms))
            .withColumns(
                {
                    f"_q_{c}": F.col("_t.g"),
                    f"_k_{c}": F.col("_t.k"),
                    f"_k2_{c}": F.col("_t.k2"),
                    "_pairs2": (F.col("_pairs2") * F.col("_t.s")).cast(COUNT),
                }
            )
            .drop("_t")
        )
    rows = rows.where(
        _allowed(settings, lambda c: F.col(f"_q_{c}") == settings.comparison(c).equal)
    )
    keys = [f"{p}_{c}" for c in free for p in ("_q", "_k", "_k2")]
    exact = (
        rows.groupBy(*fixed, *keys)
        .agg((F.sum("_pairs2") / 2).cast(COUNT).alias("n_pairs"))
        .where(F.col("n_pairs") > 0)
    )
    shown = [F.col(c) for c in fixed]
    for c in fixed:
        if any(c == comparison.column for comparison in settings.comparisons):
            shown.append(F.lit(settings.comparison(c).equal).alias(f"gamma_{c}"))
    for c in free:
        gamma = F.col(f"_q_{c}")
        shown.append(gamma.alias(f"gamma_{c}"))
        if settings.comparison(c).similarity is None:
            shown.append(F.col(f"_k_{c}").alias(c))
        else:
            shown += [
                F.when(gamma == 2, F.col(f"_k_{c}")).alias(c),
                F.when(gamma == 1, F.col(f"_k_{c}")).alias(f"{c}_l"),
                F.when(gamma == 1, F.col(f"_k2_{c}")).alias(f"{c}_r"),
            ]
    return exact.select(*shown, "n_pairs")
