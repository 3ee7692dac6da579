"""N-gram Jaccard join over prefix trees (operator 4).

A document is the set of its word shingles.  Equal sets are one set, so any number of
copies costs one row each.  The join reads the texts once:

1. Shingles of a block of texts are sent to ranges of hashes, one entry for each
   shingle and block.  A shingle that only one set has can be in no overlap: it does not
   come back.  What comes back is, for each set, its shared shingles in the global
   order, rare ones first (by doublings of their number, then by hash).  A set whose
   shared shingles are fewer than the threshold of its size has no partner and is done.
2. The order makes a trie of the sets; a partner at the threshold shares a shingle in
   the first ``n - ceil(t * n) + 1``, of which the unshared ones come first and need no
   row.  The subtrees that hold a shingle of these prefixes are grouped by it.
3. Each set meets two centres: of its rarest group and of its most common one, each
   group's centre of a size band being the set with the fewest shingles of its own, which
   is what near copies are copies of.  Met pairs are counted in tries (below), links
   make components.
4. Pairs of *different* components that share any prefix shingle are listed
   completely, pruned by the shared shingles that remain on both sides and by both
   sets' overlaps with their common centre, and verified.  What is not listed is in one component already or cannot reach the
   threshold, so the components are those of all links.

Verification walks one trie for each centre: the sets that meet it arrive in
lexicographic order, which is depth first.  A set reuses the overlap counted along the
path it shares with the one before, and a path is left for good once the overlap so far
plus the rest of the shorter set cannot reach the threshold.

Hot groups: copies collapse, a shingle of a third of all sets is one entry a block, near
copies meet around a star, and sets that meet one centre are dealt over several tries.

Cases: null and empty texts have no shingles and no links; a null doc_id never names a
component, but links its neighbours; repeated rows are returned each; ties between
centres go to the smaller set id, which changes no component; texts of any length are
read whole; an empty table gives no rows; other columns are ignored, whatever their names.
A set is known by 64 bits of hash and its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import words as w
from rollgraph.llm.store import materialise
from rollgraph.operators.components import cluster_pairs

WORDS = 5
PERCENT = 80
BLOCK = 1 << 21  # shingles of a block
SPAN = 1 << 22  # shingles of a range, about
TRIE_SETS = 4096  # sets that one centre meets in one trie
_HASH_BITS = 58
_MASK = np.uint64((1 << _HASH_BITS) - 1)
_MANY = 0xFFFF  # stands for the sets of a block that have a shingle, when there are several
_SPREAD = 4096

# What tasks send: shingles of a range, a block's sets, its shingles of several sets,
# shared shingles on the way back, documents.
_RANGE, _SETS, _LOCAL, _BACK, _DOCUMENT = range(5)
ROW_SCHEMA = "kind int, span int, block long, toks binary, idx binary, more binary, doc_id long, n long, sid long"
ROW = pa.schema(
    [("kind", pa.int32()), ("span", pa.int32()), ("block", pa.int64()), ("toks", pa.binary()), ("idx", pa.binary()),
     ("more", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.int64())]
)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int, breaks: np.ndarray = w.BLANK) -> list[np.ndarray]:
    """Per row the sorted distinct shingle hashes (58 bits); fewer words than ``k``
    make one shingle of all words."""
    found = w.find_words(data, bounds, breaks)
    hashes = w.word_hashes(found)
    g = w.grams(hashes, k) >> np.uint64(64 - _HASH_BITS)
    sizes = np.diff(found.first)
    few = np.flatnonzero((sizes > 0) & (sizes < k))
    short = {}
    if len(few):
        whole = w.span_hashes(hashes, found.first[few], found.first[few + 1])
        short = dict(zip(few.tolist(), whole >> np.uint64(64 - _HASH_BITS)))
    sets = []
    for r, (a, n) in enumerate(zip(found.first[:-1].tolist(), sizes.tolist())):
        if n >= k:
            s = np.sort(g[a : a + n - k + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            sets.append(s[keep])
        elif n:
            sets.append(np.array([short[r]], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit id per set, from its elements and size; 0 for empty sets."""
    sizes = np.array([len(s) for s in sets])
    ids = np.zeros(len(sets), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        flat = w.mix(np.concatenate([sets[i] for i in some]))
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        ids[some] = w.mix(np.add.reduceat(flat, starts) + sizes[some].astype(np.uint64))
    return w.signed(ids)


def span_bits(text_bytes: int) -> int:
    """Leading bits of a hash that make its range."""
    return min(22, max(10, (text_bytes // (6 * SPAN)).bit_length()))


def _rows(**columns: list) -> pa.RecordBatch:
    size = max(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in ROW], schema=ROW
    )


class _Block:
    """Sets of a task until there are many, then the rows that carry them."""

    def __init__(self, task: int, bits: int, most: tuple[int, int]):
        self.low = np.uint64(_HASH_BITS - bits)
        self.task, self.number, self.most = task, 0, most
        self.clear()

    def clear(self) -> None:
        self.sets: list[np.ndarray] = []
        self.sids: dict[int, int] = {}
        self.size = 0

    def add(self, tokens: np.ndarray, sid: int) -> Iterator[pa.RecordBatch]:
        if sid in self.sids:
            return
        self.sids[sid] = len(self.sets)
        self.sets.append(tokens)
        self.size += len(tokens)
        if self.size >= self.most[0] or len(self.sets) >= self.most[1]:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.sets:
            return
        block = (self.task << 32) + self.number
        self.number += 1
        sizes = np.array([len(s) for s in self.sets])
        tokens = np.concatenate(self.sets)
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        start = np.flatnonzero(w.first_of_runs(tokens))
        count = np.diff(np.append(start, len(tokens)))
        beside = -1 - block % _SPREAD
        yield _rows(kind=[_SETS], span=[beside], block=[block], toks=[np.array(list(self.sids), np.int64).tobytes()], more=[sizes.astype(np.int64).tobytes()])
        several = np.repeat(count > 1, count)
        if several.any():
            yield _rows(kind=[_LOCAL], span=[beside], block=[block], toks=[tokens[several].tobytes()], idx=[owner[several].tobytes()])
        one, own = tokens[start], np.where(count > 1, np.uint16(_MANY), owner[start])
        span = (one >> self.low).astype(np.int32)
        at = np.flatnonzero(w.first_of_runs(span))
        stop = np.append(at[1:], len(one))
        low = one & ((np.uint64(1) << self.low) - np.uint64(1))
        bytes_of = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        heavy = [count[a:b][count[a:b] > 1].astype(np.uint32).tobytes() for a, b in zip(at, stop)]
        yield _rows(
            kind=[_RANGE] * len(at), span=span[at], block=[block] * len(at), more=heavy,
            toks=[bytes_of[a:b].tobytes() for a, b in zip(at, stop)], idx=[own[a:b].tobytes() for a, b in zip(at, stop)],
        )
        self.clear()


def _send(batches: Iterator[pa.RecordBatch], k: int, bits: int, most: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Documents with size and id of their set, and the blocks of sets."""
    context = TaskContext.get()
    block = _Block(context.partitionId() if context else 0, bits, most)
    for batch in batches:
        for low, high, data, bounds in w.text_slices(batch.column(1)):
            sets = shingle_sets(data, bounds, k)
            sids = set_ids(sets)
            n = high - low
            yield _rows(
                kind=[_DOCUMENT] * n, span=-1 - np.arange(low, high, dtype=np.int32) % _SPREAD, sid=sids, block=batch.column(2)[low:high],
                doc_id=batch.column(0)[low:high].cast(pa.int64()), n=[len(s) for s in sets],
            )
            for i in np.flatnonzero([len(s) for s in sets]):
                yield from block.add(sets[i], int(sids[i]))
    yield from block.flush()


def _share(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by span: of each range the shingles that several sets have, for
    each block, with their level on top.  Other rows pass through."""
    low = np.uint64(_HASH_BITS - bits)
    span, held = None, []

    def back() -> pa.RecordBatch | None:
        blocks = np.repeat([b for b, *_ in held], [len(t) for _, t, *_ in held])
        tokens, owner, weight = (np.concatenate(c) for c in list(zip(*held))[1:])
        order = np.argsort(tokens, kind="stable")
        start = np.flatnonzero(w.first_of_runs(tokens[order]))
        total = np.add.reduceat(weight[order], start)
        level = np.zeros(len(tokens), np.uint64)
        level[order] = np.repeat(np.where(total > 1, np.minimum(np.floor(np.log2(total)), 31), 0).astype(np.uint64), np.diff(np.append(start, len(order))))
        kept = np.flatnonzero(level)
        if not len(kept):
            return None
        keys = level[kept] << np.uint64(_HASH_BITS) | np.uint64(span) << low | tokens[kept]
        at = np.flatnonzero(w.first_of_runs(blocks[kept]))
        stop = np.append(at[1:], len(kept))
        return _rows(
            kind=[_BACK] * len(at), block=blocks[kept][at],
            toks=[keys[a:b].tobytes() for a, b in zip(at, stop)], idx=[owner[kept][a:b].tobytes() for a, b in zip(at, stop)],
        )

    for batch in batches:
        kinds = np.asarray(batch.column(0))
        yield batch.filter(pa.array(kinds != _RANGE))
        rows = batch.filter(pa.array(kinds == _RANGE))
        for at, block, toks, idx, heavy in zip(*(rows.column(i).to_pylist() for i in range(1, 6))):
            if at != span and held:
                found = back()
                if found is not None:
                    yield found
                held = []
            span = at
            own = np.frombuffer(idx, np.uint16)
            wide = np.zeros((len(own), 8), np.uint8)
            wide[:, :6] = np.frombuffer(toks, np.uint8).reshape(-1, 6)
            weight = np.ones(len(own), np.int64)
            weight[own == _MANY] = np.frombuffer(heavy, np.uint32)
            held.append((block, wide.view("<u8").ravel().astype(np.uint64), own, weight))
    if held:
        found = back()
        if found is not None:
            yield found


def _gather(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: each set with its shared shingles, if they are enough.
    Big-endian bytes sort like the shingles."""
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("toks", pa.binary())])
    block, held = None, {}

    def sets() -> pa.RecordBatch:
        sids, sizes = np.frombuffer(held[_SETS][0][0], np.int64), np.frombuffer(held[_SETS][0][2], np.int64)
        none = [(b"", b"", None)]
        keys = np.concatenate([np.frombuffer(t, np.uint64) for t, _, _ in held.get(_BACK, none)])
        owner = np.concatenate([np.frombuffer(i, np.uint16) for _, i, _ in held.get(_BACK, none)])
        tokens, local = (np.frombuffer(held.get(_LOCAL, none)[0][j], kind) for j, kind in ((0, np.uint64), (1, np.uint16)))
        # Shingles of several sets of the block: their level came back once.
        many = np.sort(keys[owner == _MANY] & _MASK), keys[owner == _MANY][np.argsort(keys[owner == _MANY] & _MASK)]
        known = many[1][np.searchsorted(many[0], tokens)] if len(tokens) else tokens
        keys, owner = np.concatenate([keys[owner != _MANY], known]), np.concatenate([owner[owner != _MANY], local]).astype(np.int64)
        order = np.lexsort((keys, owner))
        keys, bounds = keys[order].astype(">u8"), np.searchsorted(owner[order], np.arange(len(sids) + 1))
        common = np.diff(bounds)
        some = np.flatnonzero(common * 100 >= sizes * percent)
        toks = [keys[bounds[i] : bounds[i + 1]].tobytes() for i in some]
        return pa.RecordBatch.from_arrays([pa.array(sids[some]), pa.array(sizes[some]), pa.array(toks, pa.binary())], schema=schema)

    for batch in batches:
        for at, kind, toks, idx, more in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if at != block and held:
                yield sets()
                held = {}
            block = at
            held.setdefault(kind, []).append((toks, idx, more))
    if held:
        yield sets()


def prefix_length(n, percent: int):
    """Shingles of which a partner at ``percent`` must share one."""
    return n - (n * percent + 99) // 100 + 1


def band_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Sizes by powers of 100 / percent: partners are at most one band apart."""
    return np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64) if percent < 100 else n


POSTING = pa.schema([(c, pa.int64()) for c in ("tok", "band", "own", "sid", "n", "c", "i")])
POSTING_SCHEMA = ", ".join(f"{c} long" for c in POSTING.names)
MET = pa.schema([(c, pa.int64()) for c in ("tok", "sid", "n", "c", "i", "first", "fn", "fc", "fi")])
MET_SCHEMA = ", ".join(f"{c} long" for c in MET.names)


def _postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The shared shingles of each set's prefix, with its place ``i`` among its ``c``
    shared ones; ``own`` counts those that no other set has."""
    for batch in batches:
        sids, sizes = (np.asarray(batch.column(i)) for i in range(2))
        columns = []
        for sid, n, raw in zip(sids.tolist(), sizes.tolist(), batch.column(2).to_pylist()):
            toks = np.frombuffer(raw, ">u8").astype(np.uint64)
            c = len(toks)
            p = max(0, prefix_length(n, percent) - (n - c))
            band = int(band_of(np.array(n), percent))
            columns.append(np.stack([w.signed(toks[:p]), *(np.full(p, x) for x in (band, n - c, sid, n, c)), np.arange(p)]))
        if columns:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(columns, axis=1)], schema=POSTING)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tok, band, own, sid), of shingles with several sets only, each
    with the first set of its shingle and band.

    Streams: the last row is held back until the next one shows whether it is alone.
    """
    held = first = None
    seen = False  # whether the held row has one of its shingle before it
    for batch in batches:
        columns = np.stack([np.asarray(c) for c in batch.columns])
        if held is not None:
            columns = np.concatenate([held, columns], axis=1)
        columns = columns[:, w.first_of_runs(columns[0], columns[3])]
        if columns.shape[1] == 0:
            continue
        tok, band = columns[:2]
        start = w.first_of_runs(tok, band)
        lead = np.maximum.accumulate(np.where(start, np.arange(len(tok)), 0))
        centre = columns[3:, lead]
        if first is not None:
            centre = np.where(lead == 0, first, centre)
        before = ~w.first_of_runs(tok)
        before[0] = seen
        out = np.flatnonzero((before | np.append(before[1:], False))[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (tok, *columns[3:], *centre)], schema=MET)
        held, first, seen = columns[:, -1:], centre[:, -1:], bool(before[-1])
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (held[0], *held[3:], *first)], schema=MET)


def _possible(percent: int):
    """Sizes that allow the threshold, and a place of the shared shingle that allows it to
    be the first one: what two sets share lies from their first shared shingle on."""
    na, nb = F.col("na"), F.col("nb")
    behind = F.least(F.col("ca") - F.col("ia"), F.col("cb") - F.col("ib"))
    return (na * 100 >= nb * percent) & (nb * 100 >= na * percent) & (behind * (100 + percent) >= percent * (na + nb))


def _past_pivot(percent: int):
    """Whether two sets of one pivot can reach the threshold: they share at most the
    lesser overlap with it, and the lesser number of shared shingles besides."""
    inside = F.least("overlap", "xoverlap")
    beside = F.least(F.col("ca") - F.col("xoverlap"), F.col("cb") - F.col("overlap"))
    enough = (inside + beside) * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    return (F.col("pivot") != F.col("xpivot")) | enough


def _sides(a: str, b: str) -> dict:
    """Columns n, c and i of two sides under the names of a pair."""
    return {f"{x}{side}": F.col(f"{prefix}{x}") for side, prefix in (("a", a), ("b", b)) for x in "nci"}


def _shared_path(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common start of two ordered sets."""
    n = min(len(x), len(y))
    step, at = 16, 0
    while at < n:
        differ = np.flatnonzero(x[at : at + step] != y[at : at + step][: len(x[at : at + step])]) if at + step <= n else np.flatnonzero(x[at:n] != y[at:n])
        if len(differ):
            return at + int(differ[0])
        at += step
        step *= 4
    return n


def _walk_tries(batches: Iterator[pa.RecordBatch], percent: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows (a, salt, b, n, toks) sorted by (a, salt, b is null first, toks): a centre,
    then the sets it meets in trie order.  Links come out, or all pairs if ``whole``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("overlap", pa.int64()), ("linked", pa.bool_())])
    centre = tree = None
    for batch in batches:
        out = []
        for a, salt, b, n, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
            toks = np.frombuffer(raw, ">u8").astype(np.uint64)
            if b is None:
                centre, tree = (a, salt, n, toks), None
                continue
            if centre is None or centre[:2] != (a, salt):
                raise ValueError(f"set {a} has no tokens")
            need = -(-percent * (centre[2] + n) // (100 + percent))
            tree = _Path(centre[3], toks, 0 if whole else need, tree)
            found = int(tree.overlap[-1])  # counts to the end, unless the bound cut the path
            linked = tree.known == len(toks) and found >= need
            if whole or linked:
                out.append((a, b, found, linked))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * 4, schema)], schema=schema)


class _Path:
    """A root-to-leaf path of the trie, with the overlap at every depth.

    ``overlap[d]`` counts the first d shingles that the centre has, too.  The part
    shared with the path before is taken over; ``known`` is the depth up to which it was
    counted before the bound cut the path.
    """

    STEP = 64

    def __init__(self, centre: np.ndarray, toks: np.ndarray, need: int, before: _Path | None):
        na, nb = len(centre), len(toks)
        self.toks = toks
        depth = 0
        overlap = np.zeros(nb + 1, np.int64)
        if before is not None:
            depth = min(_shared_path(before.toks, toks), before.known)
            overlap[: depth + 1] = before.overlap[: depth + 1]
        while depth < nb:
            # Shingles come in the global order: the centre's part before this depth is used up.
            used = int(np.searchsorted(centre, toks[depth]))
            if overlap[depth] + min(nb - depth, na - used) < need:
                break
            stop = min(nb, depth + self.STEP)
            part = toks[depth:stop]
            at = np.minimum(np.searchsorted(centre, part), na - 1)
            overlap[depth + 1 : stop + 1] = overlap[depth] + np.cumsum(centre[at] == part)
            depth = stop
        self.overlap, self.known = overlap, depth


def _verified(sets: DataFrame, pairs: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """(a, b, overlap, linked) of the pairs of set ids that reach the threshold, or of
    all pairs if ``whole``."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A centre with many partners gets several tries.
    degrees = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TRIE_SETS).alias("tries"))
    centres = degrees.join(sets, degrees["a"] == sets["sid"]).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tries") - 1)).alias("salt"),
        F.lit(None).cast("long").alias("b"), "n", "toks",
    )
    met = pairs.join(degrees, "a").join(sets, F.col("b") == F.col("sid"))
    met = met.select("a", F.pmod(F.xxhash64("b"), F.col("tries")).alias("salt"), "b", "n", "toks")
    tries = centres.unionByName(met).repartition(parts, "a", "salt")
    tries = tries.sortWithinPartitions("a", "salt", F.col("b").isNotNull(), "toks")
    return tries.mapInArrow(lambda it: _walk_tries(it, percent, whole), "a long, b long, overlap long, linked boolean")


def shared_sets(documents: DataFrame, k: int, percent: int, most: tuple[int, int] = (BLOCK, _MANY)) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sid, body) of every row, and (sid, n, toks) of the sets that can have a
    partner: their size and their shared shingles in the global order.  A block has
    at most about ``most`` shingles and sets."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = span_bits(documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    sent = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("body"))
    sent = sent.mapInArrow(lambda it: _send(it, k, bits, most), ROW_SCHEMA)
    shared = sent.repartition(parts, "span").sortWithinPartitions("span")
    rows = materialise(shared.mapInArrow(lambda it: _share(it, bits), ROW_SCHEMA), "jaccard-shared")
    blocks = rows.where(F.col("kind") != _DOCUMENT).select("block", "kind", "toks", "idx", "more")
    sets = blocks.repartition(parts, "block").sortWithinPartitions("block")
    sets = sets.mapInArrow(lambda it: _gather(it, percent), "sid long, n long, toks binary")
    sets = sets.dropDuplicates(["sid", "n"])  # copies in several blocks
    return rows.where(F.col("kind") == _DOCUMENT).select("doc_id", "n", "sid", F.col("block").alias("body")), materialise(sets, "jaccard-sets")


def link_components(documents: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, body, label) of every row; documents link when
    100 * intersection >= ``percent`` * union of their sets of ``k``-word shingles.  ``body``
    hashes the text; ``label`` names the component, also where doc_ids repeat."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    profiles, sets = shared_sets(documents, k, percent)
    postings = sets.mapInArrow(lambda it: _postings(it, percent), POSTING_SCHEMA)
    met = postings.repartition(parts, "tok").sortWithinPartitions("tok", "band", "own", "sid")
    met = materialise(met.mapInArrow(_meet, MET_SCHEMA), "jaccard-met")
    # Two centres for each set: of its rarest shingle that others have, if they can link, and
    # of its most common one, the pivot, whose overlap with the set bounds other overlaps.
    level = F.shiftright("tok", _HASH_BITS)
    able = met.where("sid <> first").withColumns(_sides("", "f")).where(_possible(percent))
    rarest = able.groupBy("sid").agg(F.min_by("first", "tok").alias("x"))
    common = met.groupBy("sid").agg(F.max_by("first", F.struct(level, -F.col("tok"))).alias("pivot"), F.max("c").alias("c"))
    common = materialise(common.join(rarest, "sid", "left"), "jaccard-centres")
    near = common.select(F.explode(F.array_distinct(F.array("x", "pivot"))).alias("a"), F.col("sid").alias("b")).where("a <> b")
    near = materialise(_verified(sets, materialise(near, "jaccard-near"), percent, True), "jaccard-stars")
    groups = materialise(cluster_pairs(near.where("linked"), "a", "b"), "jaccard-groups")
    pivots = common.join(near.select(F.col("b").alias("sid"), F.col("a").alias("pivot"), "overlap"), ["sid", "pivot"], "left")
    pivots = pivots.select("sid", "pivot", F.coalesce("overlap", "c").alias("overlap"))  # a pivot is its own

    # Pairs of different components that share a prefix shingle, all of them.
    rows = met.select("tok", "sid", "n", "c", "i").join(pivots, "sid").join(groups.withColumnRenamed("id", "sid"), "sid", "left")
    rows = rows.withColumn("cluster", F.coalesce("cluster", "sid"))
    sizes = rows.groupBy("tok", "cluster").agg(F.count(F.lit(1)).alias("m"))
    mixed = sizes.groupBy("tok").agg(F.count(F.lit(1)).alias("k"), F.max_by("cluster", F.struct("m", "cluster")).alias("major"))
    rows = materialise(rows.join(mixed.where("k > 1").select("tok", "major"), "tok"), "jaccard-mixed")
    minor = rows.where("cluster <> major").select("tok", *[F.col(c).alias(f"x{c}") for c in ("sid", "n", "c", "i", "cluster", "pivot", "overlap")])
    across = minor.join(rows, "tok").where("xcluster <> cluster AND (cluster = major OR xsid < sid)")
    across = across.withColumns(_sides("x", "")).where(_possible(percent) & _past_pivot(percent))
    wide = across.select(F.least("xsid", "sid").alias("a"), F.greatest("xsid", "sid").alias("b")).distinct()
    more = materialise(_verified(sets, materialise(wide, "jaccard-across"), percent), "jaccard-more")
    name = lambda side: groups.select(F.col("id").alias(side), F.col("cluster").alias(f"c{side}"))
    joined = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
    )
    over = cluster_pairs(joined, "a", "b").select(F.col("id").alias("cluster"), F.col("cluster").alias("top"))
    labels = groups.unionByName(
        joined.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        .join(groups, "id", "left_anti").withColumn("cluster", F.col("id"))
    )
    labels = labels.join(over, "cluster", "left").select(F.col("id").alias("sid"), F.coalesce("top", "cluster").alias("label"))

    named = profiles.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    named = materialise(named, "jaccard-labels")
    # Written, so that the join below has a shuffle of its own, which skew handling can split.
    least = materialise(named.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "jaccard-least")
    joined = named.join(least, "label", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "body", "label")


def keep_one_of_each(documents: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one row of each component: the one of the smallest doc_id (nulls
    last), of equal doc_ids the one whose text hashes least.  Rows without words stay."""
    linked = materialise(link_components(documents, k, percent).where("n_shingles > 0"), "jaccard-linked")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")
    first = materialise(linked.groupBy("label").agg(F.min(own).alias("first")), "jaccard-first")
    lost = linked.join(first, "label").where(~own.eqNullSafe(F.col("first"))).select("doc_id", "body").distinct()
    again = linked.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    held = documents.select(*[F.col(c).alias(f"_j_{c}") for c in documents.columns], F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_body"))
    same = lambda keys: F.col("_id").eqNullSafe(keys["doc_id"]) & (F.col("_body") == keys["body"])
    kept = held.join(lost, same(lost), "left_anti")
    # Equal rows are copies, too.
    twice = kept.join(again, same(again), "left_semi").dropDuplicates(["_id", "_body"])
    rows = kept.join(again, same(again), "left_anti").unionByName(twice)
    return rows.select(*[F.col(f"_j_{c}").alias(c) for c in documents.columns])
