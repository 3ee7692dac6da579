"""Record pairs of chosen agreement groups."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollgraph.functions.similarity import jaro_winkler
from rollgraph.operators.agreement import LinkSettings, level
from rollgraph.operators.skew import pairs_between, pairs_in_runs
from rollgraph.session import cut_lineage

ROWS_PER_CELL = 2_000  # records on each side of a cell: at most four million pairs a task


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _key(columns, present) -> Column:
    """Values of the agreed columns as one text; a hole where not agreed."""
    return F.to_json(F.array(*[F.when(present(c), _text(c)) for c in columns]))


def list_pairs(scored: DataFrame, records: DataFrame, settings: LinkSettings) -> DataFrame:
    """The record pairs behind rows of ``scored_comparisons``, one row each.

    Pass the groups to look at, e.g. those above a match probability; the
    result is as long as the sum of their ``n_pairs``, which tells beforehand
    what to expect.  Big groups are listed in bounded cells over many tasks.
    Columns: ``<id>_l`` < ``<id>_r``, the retained and compared columns of both
    sides, the levels, and the scores of the group.

    Records meet under the values their group agrees on; where a group has two
    similar values, records with the one meet records with the other.  The scores
    travel with the records, so the pairs themselves are not shuffled.
    """
    free = list(settings.free)
    fuzzy = [c for c in free if settings.comparison(c).similarity is not None]
    scores = [c for c in ("match_probability", "tf_match_probability") if c in scored.columns]
    groups = cut_lineage(
        scored.select(
            *settings.fixed,
            *[n for c in free for n in (f"gamma_{c}", c, f"{c}_l", f"{c}_r") if n in scored.columns],
            *scores,
            "n_pairs",
        )
    )
    gammas = [f"gamma_{c}" for c in free]
    # A few patterns: at most four levels a column.
    seen = [tuple(r) for r in groups.select(*gammas).distinct().collect()] if free else [()]
    patterns = [dict(zip(free, r)) for r in sorted(seen)] or [{c: settings.comparison(c).equal for c in free}]
    parts: dict[tuple[str, ...], list[dict]] = {}
    for pattern in patterns:
        similar = tuple(c for c in fuzzy if pattern[c] == 1)
        parts.setdefault(similar, []).append(pattern)
    return reduce(
        DataFrame.unionByName,
        [_listed(groups, records, settings, similar, chosen, scores) for similar, chosen in parts.items()],
    )


def _keyed(records: DataFrame, settings: LinkSettings, payload: list[str], sets: list[tuple[str, ...]]) -> DataFrame:
    """Each record under every one of the ``sets`` of free columns to agree on."""
    fixed, free = list(settings.fixed), list(settings.free)
    options = F.array(
        *[
            F.when(
                reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*fixed, *s]], F.lit(True)),
                _key(fixed + free, lambda c, s=s: F.lit(c in fixed or c in s)),
            )
            for s in sets
        ]
    )
    return records.select(settings.id_column, *payload, F.explode(options).alias("_key")).where(
        F.col("_key").isNotNull()
    )


def _joined(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of the wanted keys.

    Merged: the size of compressed files would tell the planner that all records,
    each under several keys, are small enough to pass through the driver.
    """
    return keyed.join(wanted.hint("merge"), "_key")


def _in_order(met: DataFrame, id_column: str, cols: list[str]) -> DataFrame:
    """Pairs with the smaller id on the left, and the scores of the left one."""
    ordered = F.col(f"{id_column}_l") < F.col(f"{id_column}_r")
    sides = [
        column
        for c in cols
        for column in (
            F.when(ordered, F.col(f"{c}_l")).otherwise(F.col(f"{c}_r")).alias(f"{c}_l"),
            F.when(ordered, F.col(f"{c}_r")).otherwise(F.col(f"{c}_l")).alias(f"{c}_r"),
        )
    ]
    return met.select(*sides, F.col("_s_l").alias("_s"))


def _listed(
    groups: DataFrame, records: DataFrame, settings: LinkSettings, similar: tuple[str, ...], patterns: list[dict], scores: list[str]
) -> DataFrame:
    """Pairs of the groups with these ``patterns``, all of them similar on ``similar``."""
    fixed, free = list(settings.fixed), list(settings.free)
    used = fixed + free
    payload = [c for c in dict.fromkeys([*settings.retain, *used]) if c != settings.id_column]

    code = reduce(lambda n, c: n * 4 + F.col(f"gamma_{c}") + 1, free, F.lit(0).cast("bigint"))
    codes = [reduce(lambda n, c: n * 4 + p[c] + 1, free, 0) for p in patterns]

    def equal(c: str) -> Column:
        return F.lit(True) if c in fixed else F.col(f"gamma_{c}") == settings.comparison(c).equal

    # One row per agreed values, with the scores under each pattern.
    ends = [f"{c}_{s}" for c in similar for s in "lr"]
    found = F.struct(F.lit(True).alias("there"), *scores)
    by_code = F.map_from_entries(F.collect_list(F.struct(code, found)))
    wanted = (
        groups.where(code.isin(codes))
        .groupBy(_key(used, equal).alias("_key"), *ends)
        .agg((F.first(found) if len(codes) == 1 else by_code).alias("_s"))
    )
    # Only the columns that the wanted groups agree on, or are similar on, make keys.
    sets = {tuple(c for c in free if c in similar or p[c] == settings.comparison(c).equal) for p in patterns}
    keyed = _keyed(records, settings, payload, sorted(sets))
    cols = [settings.id_column, *payload]
    if similar:
        met = _between(wanted, keyed, settings, similar, ends, [*payload, "_s"])
        met = _in_order(met, settings.id_column, cols)
    else:
        expected = int(groups.where(code.isin(codes)).agg(F.sum("n_pairs")).first()[0] or 0)
        met = pairs_in_runs(
            _joined(keyed, wanted), ["_key"], settings.id_column, payload, ["_s"], expected, ROWS_PER_CELL
        )
    its = F.when(code == codes[0], F.col("_s")) if len(codes) == 1 else F.try_element_at("_s", code)

    far = [c for c in free if settings.comparison(c).similarity is not None and any(p[c] == 0 for p in patterns)]
    for c in free:
        agreed = F.lit(1) if c in similar else level(settings.comparison(c), F.col(f"{c}_l"), F.col(f"{c}_r"), F.lit(0.0))
        met = met.withColumn(f"gamma_{c}", agreed)
    met = met.where(its["there"])
    if far:  # values that differ may be similar, which is another group
        for c in far:
            left, right = F.col(f"{c}_l"), F.col(f"{c}_r")
            met = met.withColumn(f"gamma_{c}", level(settings.comparison(c), left, right, jaro_winkler(left, right)))
        met = met.where(its["there"])
    out = [f"{c}_{s}" for c in cols for s in "lr"] + [f"gamma_{c}" for c in free]
    return met.select(*out, *[its[c].alias(c) for c in scores])


def _between(
    wanted: DataFrame, keyed: DataFrame, settings: LinkSettings, similar: tuple[str, ...], ends: list[str], payload: list[str]
) -> DataFrame:
    """Records with one of two similar values meet those with the other.

    With several similar columns the first one tells the sides, and every way to
    deal the values of the others is met.
    """
    used = [*settings.fixed, *settings.free]
    at = {c: used.index(c) for c in similar}
    agreed = F.from_json("_key", "array<string>")

    def key(taken: dict[str, str]) -> Column:
        """The key of records that have these of the similar values."""
        named = {at[c]: F.col(f"{c}_{side}") for c, side in taken.items()}
        return F.to_json(F.array(*[named.get(i, F.get("_agreed", F.lit(i))) for i in range(len(used))]))

    ways = []
    for rest in product("lr", repeat=len(similar) - 1):
        first = dict(zip(similar, ("l", *rest)))
        other = {c: "r" if side == "l" else "l" for c, side in first.items()}
        for taken, left in ((first, True), (other, False)):
            ways.append(
                F.struct(key(taken).alias("k"), F.lit("".join(first.values())).alias("way"), F.lit(left).alias("left"))
            )
    group = ["_group", *ends, "_way"]
    sides = (
        wanted.withColumn("_agreed", agreed)
        .withColumn("_w", F.explode(F.array(*ways)))
        .select(
            F.col("_key").alias("_group"), *ends, F.col("_w.way").alias("_way"), F.col("_w.left").alias("_left"),
            F.col("_w.k").alias("_key"), "_s",
        )
    )
    # The ends of a group have the names of columns of pairs.
    named = {c: f"_e_{c}" for c in ends}
    both = _joined(keyed, sides.withColumnsRenamed(named))
    met = pairs_between(
        both, [named.get(c, c) for c in group], "_left", settings.id_column, payload, ROWS_PER_CELL
    )
    return met.where(F.col(f"{settings.id_column}_l") != F.col(f"{settings.id_column}_r"))
