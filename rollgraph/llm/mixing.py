"""Mixing sources to target weights by Sainte-Lague apportionment (operator 7).

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share all
words; no target goes above ``REPEATS`` times its source's words, and what is cut
off is shared anew by weight.  The mix is made of blocks of ``BLOCK`` words, which go to
the sources by the highest quotients target / (2 * blocks so far + 1).  A source's
blocks go to its shards in proportion to their words, by rounding the cumulated share.  A
shard's documents stand in a seeded order; its quota is whole rounds over all of its
blocks and, for the rest, blocks spread evenly from a seeded start, so that a document's
share is arithmetic on its place and no block is ever a row.

Nothing needs all sources or all shards in one task: the level to which sources are
filled and the least quotient that wins are found by sums over all sources at ``GRID``
points at once, a few rounds each; places come from range partitions; cumulated words
from sums of ``GROUP`` shards.  A shard has about ``SHARD_WORDS`` words, so a source with
a third of all rows is dealt over many windows.

Cases: a null text has no words; a null source is one source, the last; documents
without words take nothing; repeated rows have places of their own; ties of
quotients go to the source first in order; texts of any length are counted whole; an
empty table gives no rows.  Input columns named like a result column are replaced, others
carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollgraph.llm.store import materialise, ranked

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 32
SHARD_WORDS = 1 << 18
GROUP = 1024  # shards whose words are cumulated in one window
GRID = 32
CLOSE = 4096  # quotients that are listed and ranked
RESULT = ("size", "source_size", "target", "taken")


def word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def fill_level(parties: DataFrame, total: int) -> float:
    """The level x at which the sum of least(limit, weight * x) is ``total``.

    Each round sums at ``GRID`` levels at once and goes on between the two around the
    total, until no party reaches its limit in between: there the sum is linear.
    """
    full_at = F.col("limit") / F.col("weight")
    low, high = 0.0, float(parties.agg(F.max(full_at)).first()[0] or 0.0)
    if not high:
        return 0.0
    while True:
        grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        sums = []
        for x in grid:
            sums += [F.sum(F.when(full_at <= x, F.col("limit")).otherwise(0.0)), F.sum(F.when(full_at <= x, 0.0).otherwise(F.col("weight")))]
        found = parties.agg(*[c.alias(f"s{i}") for i, c in enumerate(sums)]).first()
        filled = [(x, found[2 * i], found[2 * i + 1]) for i, x in enumerate(grid)]
        below = [f for f in filled if f[1] + f[2] * f[0] <= total] or filled[:1]
        at, limits, weights = below[-1]
        above = [x for x in grid if x > at]
        if not above or not weights:
            return at
        inside = parties.where((full_at > at) & (full_at < above[0])).limit(1).count()
        if not inside or (at, above[0]) == (low, high):
            return (total - limits) / weights
        low, high = at, above[0]


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) with ``rank`` in code point order and ``target``."""
    placed = ranked(sizes, [F.col("source").asc_nulls_last()], "rank").withColumn("rank", F.col("rank") - 1)
    chosen = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    parties = materialise(placed.withColumns({"weight": chosen, "limit": (repeats * F.col("source_size")).cast("double")}), "mix-parties")
    total = parties.agg(F.sum("source_size")).first()[0] or 0
    target = F.least(F.col("limit"), F.col("weight") * fill_level(parties, total))
    return parties.select("source", "rank", "source_size", target.alias("target"))


def apportion(parties: DataFrame, key: str, votes: str, limit: str, seats: int) -> DataFrame:
    """``parties`` with ``quota``: ``seats`` by the highest Sainte-Lague quotients votes /
    (2 * seats so far + 1), none beyond a party's ``limit``; ties by ``key``.

    Between two quotients, found like ``fill_level``, at most ``CLOSE`` or only equal ones
    lie around the last seat; those are listed and ranked, the ones above are certain.
    """
    count = lambda q: F.least(F.col(limit), F.floor(F.col(votes) / (2 * q) + 0.5)).cast("long")
    most, able, everyone = parties.where(F.col(votes) > 0).agg(F.max(votes), F.sum(limit), F.sum(votes)).first()
    seats = min(seats, able or 0)
    if seats <= 0:
        return parties.withColumn("quota", F.lit(0).cast("long"))
    low, high, held = everyone / (2 * seats), 2.0 * most, {}
    low = min(low, most)

    def won(grid: list[float]) -> list[int]:
        new = [q for q in grid if q not in held]
        if new:
            found = parties.where(F.col(votes) > 0).agg(*[F.sum(count(q)).alias(f"s{i}") for i, q in enumerate(new)]).first()
            held.update(zip(new, found))
        return [held[q] for q in grid]

    while won([low])[0] < seats:
        low /= 4
    held[high] = 0
    while held[low] - held[high] > CLOSE:
        grid = [low * (high / low) ** (i / GRID) for i in range(1, GRID)]
        grid = [low, *[q for q in grid if low < q < high], high]
        counts = won(grid)
        at = max(i for i, n in enumerate(counts) if n >= seats)
        if (grid[at], grid[at + 1]) == (low, high):
            break  # only equal quotients are left
        low, high = grid[at], grid[at + 1]
    sure, top = (count(high) if held[high] else F.lit(0).cast("long")), count(low)
    sized = parties.withColumns({"_sure": F.when(F.col(votes) > 0, sure).otherwise(0), "_top": F.when(F.col(votes) > 0, top).otherwise(0)})
    tried = sized.where("_top > _sure").select(key, votes, F.explode(F.sequence("_sure", F.col("_top") - 1)).alias("_j"))
    tried = tried.withColumn("_q", F.col(votes) / (2 * F.col("_j") + 1))
    rest = seats - held[high]
    best = ranked(tried, [F.desc("_q"), F.asc(key), F.asc("_j")], "_place").where(F.col("_place") <= rest)
    extra = best.groupBy(key).agg(F.count(F.lit(1)).alias("_extra"))
    quota = (F.col("_sure") + F.coalesce("_extra", F.lit(0))).cast("long")
    return sized.join(extra, key, "left").withColumn("quota", quota).select(*parties.columns, "quota")


def deal_to_shards(totals: DataFrame, seats: DataFrame) -> DataFrame:
    """``totals`` (rank, _shard, words, limit) with ``quota``: each source's ``seats`` by
    its shards' words, by rounding down the cumulated share."""
    grouped = totals.withColumn("_group", F.floor(F.col("_shard") / GROUP))
    sums = grouped.groupBy("rank", "_group").agg(F.sum("words").alias("_words"))
    above = Window.partitionBy("rank").orderBy("_group")
    sums = sums.withColumns({"_base": F.sum("_words").over(above) - F.col("_words"), "_all": F.sum("_words").over(Window.partitionBy("rank"))})
    within = Window.partitionBy("rank", "_group").orderBy("_shard")
    placed = grouped.join(sums.drop("_words"), ["rank", "_group"]).withColumn("_end", F.col("_base") + F.sum("words").over(within))
    seat = lambda x: F.floor(F.col("seats") * (x / F.nullif(F.col("_all"), F.lit(0))))
    quota = F.coalesce(seat(F.col("_end")) - seat(F.col("_end") - F.col("words")), F.lit(0))
    return placed.join(seats, "rank").withColumn("quota", F.least(F.col("limit"), quota).cast("long")).select(*totals.columns, "quota")


def mix_sources(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """``documents`` with size, source_size, target and taken: the words of each
    document that the mix takes, repeats counted."""
    held = {c: f"_in_{c}" for c in documents.columns if c not in RESULT}
    sized = documents.select(
        *[F.col(c).alias(n) for c, n in held.items()],
        word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("_hash"),
    )
    source = held["source"]
    # Words are counted here and once more for the result; what lies between reads sizes.
    counted = materialise(sized.groupBy(F.col(source).alias("source"), "_hash").agg(F.sum("size").alias("size")), "mix-sizes")
    sources = counted.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialise(source_targets(sources, weights, repeats), "mix-sources")

    named = sources.withColumnRenamed("source", "_source")
    shard = F.pmod(F.col("_hash"), F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))).alias("_shard")
    totals = counted.join(named, F.col("source").eqNullSafe(F.col("_source"))).groupBy("rank", shard).agg(F.sum("size").alias("words"))
    totals = totals.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / block)))
    totals = materialise(totals.withColumn("limit", repeats * F.col("blocks")), "mix-shards")

    limits = totals.groupBy("rank").agg(F.sum("limit").alias("limit"))
    parties = materialise(sources.join(limits, "rank"), "mix-limits")
    seats = round((parties.agg(F.sum("target")).first()[0] or 0) / block)
    by_source = apportion(parties, "rank", "target", "limit", seats).select("rank", F.col("quota").alias("seats"))
    by_shard = materialise(deal_to_shards(totals, by_source).select("rank", "_shard", "blocks", "quota"), "mix-quotas")

    dealt = sized.join(named, F.col(source).eqNullSafe(F.col("_source"))).select("*", shard)
    order = Window.partitionBy("rank", "_shard").orderBy("_hash", held["doc_id"], "size")
    placed = dealt.join(by_shard, ["rank", "_shard"]).withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rest = F.expr("quota % blocks")
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("rank"), F.col("_shard")), F.col("blocks"))
    placed = placed.withColumns({"_rest": rest, "_offset": offset})

    def chosen_before(x):
        """Chosen words before word ``x`` of the shard."""
        b = F.floor(x / block)
        spread = lambda y: F.floor((y * F.col("_rest") + F.col("_offset")) / F.col("blocks"))
        return spread(b) * block + F.pmod(x, F.lit(block)) * (spread(b + 1) - spread(b))

    rounds = F.expr("quota div blocks")
    taken = rounds * F.col("size") + chosen_before(F.col("_end")) - chosen_before(F.col("_end") - F.col("size"))
    return placed.withColumn("taken", F.when(F.col("size") > 0, taken).otherwise(0).cast("long")).select(
        *[F.col(n).alias(c) for c, n in held.items()], *RESULT
    )
