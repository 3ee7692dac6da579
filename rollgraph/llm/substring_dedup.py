"""Substring dedup by seed and extend (operator 10).

Seeds are winnowed anchors: of the ``window - anchor + 1`` runs of ``anchor``
words in a window of ``window`` words, the one with the least hash (the last of
equal ones).  Equal windows choose the same anchor at the same place, so two
documents that share a window meet on it.  An anchor's block is the run of
windows that choose it.  Where whole blocks are equal the match extends over
both of them at once; where they differ, it is extended window by window, which
finds the maximal repeats without comparing occurrences in pairs.

Plan: one Arrow pass makes anchors (about two of ``window - anchor + 2`` words)
and settles repeats inside a slice, so that a passage held by a third of all
rows arrives once per slice.  One shuffle by anchor hash with a streamed sorted
group settles equal blocks.  Anchors whose blocks differ go back to their texts
by document, give their windows, and one small shuffle settles those.  Texts
are shuffled by document only.

Cases: null or empty texts have no words; a null doc_id is after all others;
repeated rows (same doc_id and text) are one document; rows with the same doc_id
and other text are told apart by a hash of the text.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import words as w
from rollgraph.llm.store import materialise

WINDOW = 20
ANCHOR = 13
LAST = np.iinfo(np.int64).max


def _text_key(column):
    return F.xxhash64(column).bitwiseAND(F.lit(0x7FFFFFFF))


def _keyed(documents: DataFrame) -> DataFrame:
    """doc (null last), text and a hash of the text that parts equal ids."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.coalesce(F.col("doc_id"), F.lit(LAST)).cast("long").alias("doc"),
        _text_key(text).alias("tk"),
        text.alias("text"),
    )


def _winnow(g: np.ndarray, room: int) -> np.ndarray:
    """Position of the least of each ``room`` grams in a row, the last of equal ones."""
    n = len(g) - room + 1
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, room):
        other = g[j : j + n]
        less = other <= best
        best[less] = other[less]
        at[less] = j
    return at + np.arange(n)


def _blocks(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """(anchor hash, anchor position, first window, last window, row) of a slice."""
    if len(hashes) < window:
        return None
    g = w.grams(hashes, anchor)
    at = _winnow(g, window - anchor + 1)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.flatnonzero(row[: len(at)] == row[window - 1 :])
    if len(start) == 0:
        return None
    new = w.first_of_runs(at[start], row[start])
    low = start[new]
    high = start[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]
    return g[at[low]], at[low], low, high, row[low]


def _emit(columns: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(t.to_pandas_dtype(), copy=False)) for c, t in zip(columns, schema.types)],
        schema=schema,
    )


SEEDS = pa.schema(
    [("h", pa.int64()), ("ctx", pa.int64()), ("doc", pa.int64()), ("loc", pa.int64()),
     ("back", pa.int32()), ("fore", pa.int32()), ("covered", pa.bool_())]
)
SPANS = pa.schema([("doc", pa.int64()), ("loc", pa.int64()), ("back", pa.int32()), ("fore", pa.int32()), ("open", pa.bool_())])
SEED_SCHEMA = "h long, ctx long, doc long, loc long, back int, fore int, covered boolean"
SPAN_SCHEMA = "doc long, loc long, back int, fore int, open boolean"
RESULT_SCHEMA = "doc long, n_words long, n_removed long, kept string"


def _settled_in_slice(h, ctx, doc, loc, back, fore) -> pa.RecordBatch:
    """Sorted rows of a slice: one leader for each (h, ctx), and what it covers.

    Covered rows need no key any more and get one that spreads them.  Repeated
    rows have the leader's own place and are not covered.
    """
    order = np.lexsort((loc, doc, ctx, h))
    h, ctx, doc, loc, back, fore = (c[order] for c in (h, ctx, doc, loc, back, fore))
    new = w.first_of_runs(h, ctx)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    later = (doc != doc[lead]) | (loc != loc[lead])
    h = np.where(later, w.signed(w.mix(loc.view(np.uint64) + w.mix(doc.view(np.uint64)))), h)
    keep = new | later
    return _emit([c[keep] for c in (h, ctx, doc, loc, back, fore, later)], SEEDS)


def _seed_batches(batches: Iterator[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Anchors of whole texts.  ``loc`` is the position, then the text's key;
    ``back`` and ``fore`` lead to the block's first and past its last word."""
    for batch in batches:
        docs, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        for low, high, data, bounds in w.text_slices(batch.column(2)):
            found = w.find_words(data, bounds)
            hashes = w.word_hashes(found, lower=False)
            blocks = _blocks(hashes, found.first, window, anchor)
            if blocks is None:
                continue
            h, at, first, last, row = blocks
            ctx = w.span_hashes(hashes, first, last + window)
            ctx = w.signed(w.mix(ctx + ((at - first) * 64 + (last - first)).astype(np.uint64)))
            h = w.signed(h)
            doc = docs[low:high][row]
            loc = ((at - found.first[row]) << 31) | keys[low:high][row]
            yield _settled_in_slice(h, ctx, doc, loc, at - first, last + window - at)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h, ctx, doc, loc: later rows of a (h, ctx) are covered, and
    the first ones are open where an anchor hash has several blocks.

    Streams: only the last leader and the last (h, ctx) are carried along.
    """
    held = None  # the first leader of the current hash, not known to be open yet
    last = None  # (h, ctx, doc, loc) of the current leader
    several = False
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        done = columns.pop()
        if done.any():
            yield _emit([c[done] for c in columns[2:]] + [np.zeros(done.sum(), bool)], SPANS)
            columns = [c[~done] for c in columns]
        n = len(columns[0])
        if n == 0:
            continue
        h, ctx, doc, loc, back, fore = columns
        new_h = w.first_of_runs(h)
        new = w.first_of_runs(h, ctx)
        if last is not None:
            new_h[0] = h[0] != last[0]
            new[0] = new_h[0] or ctx[0] != last[1]
        lead = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        lead_doc = np.where(lead >= 0, doc[lead], last[2] if last else 0)
        lead_loc = np.where(lead >= 0, loc[lead], last[3] if last else 0)
        covered = (doc != lead_doc) | (loc != lead_loc)
        # A leader is open if it is not its hash's first, or if another one follows.
        second = new & ~new_h
        group = np.cumsum(new_h)
        has_second = np.zeros(group[-1] + 1, bool)
        has_second[group[second]] = True
        open_ = second | (new_h & has_second[group])
        out = [(doc[covered], loc[covered], back[covered], fore[covered], np.zeros(covered.sum(), bool))]
        out.append((doc[open_], loc[open_], back[open_], fore[open_], np.ones(open_.sum(), bool)))
        if not new_h[0] and held is not None and not several and has_second[0]:
            out.append(tuple(np.array([x]) for x in held) + (np.ones(1, bool),))
            several = True
        if new_h.any():
            k = int(np.flatnonzero(new_h)[-1])
            held = (doc[k], loc[k], back[k], fore[k])
            several = bool(has_second[group[k]])
        j = lead[-1]
        last = (h[-1], ctx[-1], doc[j], loc[j]) if j >= 0 else (h[-1], ctx[-1], last[2], last[3])
        yield _emit([np.concatenate(c) for c in zip(*out)], SPANS)


def _window_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """All windows of the open blocks, later ones of a slice already settled."""
    for batch in batches:
        docs, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        places = batch.column(3)
        at, back, fore = (np.asarray(places.values.field(i)) for i in range(3))
        owner = np.asarray(places.offsets)
        for low, high, data, bounds in w.text_slices(batch.column(2)):
            found = w.find_words(data, bounds)
            hashes = w.word_hashes(found, lower=False)
            own = slice(owner[low], owner[high])
            row = np.repeat(np.arange(high - low), np.diff(owner[low : high + 1]))
            first = found.first[row] + at[own] - back[own]
            count = back[own].astype(np.int64) + fore[own] - window + 1
            start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            row = np.repeat(row, count)
            if len(start) == 0:
                continue
            h = w.signed(w.span_hashes(hashes, start, start + window))
            ctx = w.signed(w.mix(w.grams(hashes, window)[start] + np.uint64(1)))
            doc = docs[low:high][row]
            loc = ((start - found.first[row]) << 31) | keys[low:high][row]
            zeros = np.zeros(len(h), np.int32)
            yield _settled_in_slice(h, ctx, doc, loc, zeros, zeros + window)


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept words of each text; the covered places are lists of (from, to)."""
    out_type = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        places = batch.column(3)
        begin, stop = (np.asarray(places.values.field(i)) for i in range(2))
        owner = np.asarray(places.offsets)
        blob = batch.column(2)
        for low, high, data, bounds in w.text_slices(blob):
            found = w.find_words(data, bounds)
            total = len(found.start)
            change = np.zeros(total + 1, np.int64)
            row = np.repeat(np.arange(high - low), np.diff(owner[low : high + 1]))
            own = slice(owner[low], owner[high])
            np.add.at(change, found.first[row] + begin[own], 1)
            np.add.at(change, found.first[row] + stop[own], -1)
            stay = np.cumsum(change)[:total] == 0
            raw = data.tobytes()
            for r in range(high - low):
                a, b = found.first[r], found.first[r + 1]
                mine = stay[a:b]
                s, e = found.start[a:b], found.end[a:b]
                if not mine.all():
                    s, e = s[mine], e[mine]
                n_words.append(b - a)
                n_removed.append(b - a - len(s))
                kept.append(b" ".join(raw[i:j] for i, j in zip(s.tolist(), e.tolist())).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            schema=out_type,
        )


def remove_repeats(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every document without the words of
    windows of ``window`` words that also start earlier (a smaller doc_id, or the
    same document before).  ``kept`` holds the other words joined by one space.
    """
    docs = _keyed(documents)
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def settle(rows: DataFrame) -> DataFrame:
        keyed = rows.repartition(parts, "h").sortWithinPartitions("h", "ctx", "doc", "loc")
        spans = keyed.mapInArrow(_settle, SPAN_SCHEMA)
        place = F.shiftright("loc", 31).cast("int")
        key = F.col("loc").bitwiseAND(F.lit(0x7FFFFFFF))
        return spans.select("doc", key.alias("tk"), place.alias("at"), "back", "fore", "open")

    def by_text(spans: DataFrame, *fields) -> DataFrame:
        rows = spans.groupBy("doc", "tk").agg(F.collect_list(F.struct(*fields)).alias("places"))
        joined = docs.join(rows, ["doc", "tk"], "left")
        kind = rows.schema["places"].dataType
        return joined.select("doc", "tk", "text", F.coalesce("places", F.array().cast(kind)).alias("places"))

    seeds = docs.mapInArrow(lambda it: _seed_batches(it, window, anchor), SEED_SCHEMA)
    spans = materialise(settle(seeds), "repeat-spans")
    opened = by_text(spans.where("open"), "at", "back", "fore").where(F.size("places") > 0)
    edges = settle(opened.mapInArrow(lambda it: _window_batches(it, window), SEED_SCHEMA))
    covered = spans.where("not open").unionByName(edges.where("not open"))
    begin, stop = F.col("at") - F.col("back"), F.col("at") + F.col("fore")
    result = by_text(covered, begin.alias("begin"), stop.alias("stop")).mapInArrow(
        _result_batches, RESULT_SCHEMA
    )
    doc_id = F.when(F.col("doc") != LAST, F.col("doc"))
    return result.select(doc_id.alias("doc_id"), "n_words", "n_removed", "kept")
