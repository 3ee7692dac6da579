"""Benchmark decontamination with a BM25 index and block-max WAND (operator 6).

Terms are runs of five words (ASCII letters lower-cased, words are letters,
digits and other characters, so case and punctuation do not matter).  The test
items are the indexed documents and every passage of every training document is
a query.  Items are indexed in classes by doublings of their length; the passages of a
class are twice as long as its longest possible item and overlap by half, so each copy
of an item lies in one passage, and no item's passages depend on another item.  Scores
are BM25 divided by the score an item has against itself, with term frequencies and
lengths over all items.  The retrieval threshold is the least score of any item that
has ``share`` of its terms in a passage, so nothing that the verification accepts is
lost.  A retrieved item is a leak if the passage holds at least ``share`` of the
distinct terms of its question and of its answer; the answer is the part behind the
last line break (else the last sentence end) that leaves both parts a term, and an
item without such a place is one part.

Plan: one pass over the texts without any shuffle.  The index goes to the tasks in
blocks of items with at most ``INDEX_BYTES`` of text each; a larger test set takes one
more pass for each block, and changes no score.

Cases: null and empty texts hold nothing; items with fewer words than a term, and
null items, match nothing; a null doc_id or item_id is returned as null; repeated
rows and items are reported each, also items of one item_id with other texts; ties
between passages go to the greater overlaps; texts of any length are searched whole; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import words as w
from rollgraph.llm.store import materialise

TERM = 5
SHARE = 0.8
K1, B = 1.2, 0.75
BLOCK = 32
INDEX_BYTES = 64 << 20
HIT_SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, body long"
_FIELDS = [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("body", pa.int64())]


def _terms(text: str, k: int) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    found = w.find_words(data, np.array([0, len(data)]), w.NOT_ALNUM)
    return w.grams(w.word_hashes(found), k)


def question_and_answer(text: str, k: int) -> list[np.ndarray]:
    """Distinct terms of the question and of the answer, or of the whole item."""
    for pattern in ("\n", r"[.!?](?=\s)"):
        for cut in reversed([m.end() for m in re.finditer(pattern, text)]):
            parts = [np.unique(_terms(text[:cut], k)), np.unique(_terms(text[cut:], k))]
            if len(parts[0]) and len(parts[1]):
                return parts
    return [np.unique(_terms(text, k))]


@dataclass
class Statistics:
    """Of all items: in how many each term is, their number and their mean length."""

    terms: np.ndarray  # sorted
    df: np.ndarray
    count: int
    mean: float


class ItemIndex:
    """An inverted index of items: postings by term, with a bound for each block."""

    def __init__(
        self, items: list[tuple[int | None, str | None]], k: int = TERM, share: float = SHARE,
        known_of: Statistics | None = None, stride: int | None = None,
    ):
        self.k, self.share = k, share
        known = [(i, _terms(t or "", k), t) for i, t in items]
        known = [(i, t, text) for i, t, text in known if len(t)]
        self.ids = [i for i, _, _ in known]
        self.parts = [question_and_answer(text, k) for _, _, text in known]
        self.longest = stride or max((len(t) + k - 1 for _, t, _ in known), default=k)
        counted = [np.unique(t, return_counts=True) for _, t, _ in known]
        lengths = np.array([len(t) for _, t, _ in known], float)
        flat = np.concatenate([c[0] for c in counted]) if counted else np.zeros(0, np.uint64)
        self.terms, where, df = np.unique(flat, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(known)), [len(c[0]) for c in counted]) if counted else np.zeros(0, int)
        tf = np.concatenate([c[1] for c in counted]) if counted else np.zeros(0)
        every = known_of or Statistics(self.terms, df, len(known), lengths.mean() if len(known) else 1.0)
        df = every.df[np.searchsorted(every.terms, self.terms)]
        idf = np.log1p((every.count - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths[owner] / max(every.mean, 1))
        impact = idf[where] * tf * (K1 + 1) / (tf + norm)
        whole = np.bincount(owner, impact, minlength=len(known))
        impact = impact / whole[owner]
        # The least an item with ``share`` of one passage's distinct terms can score.
        least = []
        for d in range(len(known)):
            own = np.sort(impact[owner == d]) if len(known) < 64 else None
            least.append(own)
        if len(known) >= 64:
            order = np.lexsort((impact, owner))
            least = np.split(impact[order], np.cumsum(np.bincount(owner, minlength=len(known)))[:-1])
        needed = [self._needed(d) for d in range(len(known))]
        self.threshold = min((float(v[:n].sum()) for v, n in zip(least, needed)), default=1.0) * (1 - 1e-9)
        order = np.lexsort((owner, where))
        self.doc, self.impact = owner[order], impact[order]
        self.begin = np.searchsorted(where[order], np.arange(len(self.terms) + 1))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def _needed(self, d: int) -> int:
        """Distinct terms that the parts of item d need together, at least."""
        counts = [int(np.ceil(self.share * len(p) - 1e-9)) for p in self.parts[d]]
        return max(counts)

    def lookup(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, term numbers) of the grams that are terms."""
        place = np.flatnonzero(self.filter[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, grams[place]), len(self.terms) - 1)
        same = self.terms[at] == grams[place]
        return place[same], at[same]

    def retrieve(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Items that score at least the threshold for distinct ``terms``, by
        block-max WAND: postings are in item order, and items are skipped as long
        as the bounds of the lists (then of their current blocks) cannot add up."""
        lists = []
        for t in terms.tolist():
            lo, hi = int(self.begin[t]), int(self.begin[t + 1])
            docs, impacts = self.doc[lo:hi], self.impact[lo:hi]
            bounds = np.maximum.reduceat(impacts, np.arange(0, hi - lo, BLOCK))
            lists.append([docs, impacts, bounds, float(bounds.max()), 0])
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[4]])
            total, pivot = 0.0, None
            for i, entry in enumerate(lists):
                total += entry[3]
                if total >= self.threshold:
                    pivot = i
                    break
            if pivot is None:
                break
            doc = lists[pivot][0][lists[pivot][4]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][4]] == doc:
                pivot += 1
            block_bound = 0.0
            for entry in lists[: pivot + 1]:
                at = entry[4] + int(np.searchsorted(entry[0][entry[4] :], doc))
                if at < len(entry[0]):
                    block_bound += float(entry[2][at // BLOCK])
            if block_bound >= self.threshold:
                if lists[0][0][lists[0][4]] == doc:
                    score = sum(float(e[1][e[4]]) for e in lists[: pivot + 1] if e[0][e[4]] == doc)
                    if score >= self.threshold:
                        found.append((int(doc), score))
                    target = doc + 1
                else:
                    target = doc
            else:
                # No item up to the end of the nearest block can reach it either.
                ends = [doc + 1]
                for entry in lists[: pivot + 1]:
                    at = entry[4] + int(np.searchsorted(entry[0][entry[4] :], doc))
                    if at < len(entry[0]):
                        ends.append(int(entry[0][min((at // BLOCK + 1) * BLOCK, len(entry[0])) - 1]) + 1)
                limit = min(ends[1:]) if len(ends) > 1 else doc + 1
                after = lists[pivot + 1][0][lists[pivot + 1][4]] if pivot + 1 < len(lists) else limit
                target = max(doc + 1, min(limit, int(after)))
            for entry in lists[: pivot + 1]:
                entry[4] += int(np.searchsorted(entry[0][entry[4] :], target))
            lists = [e for e in lists if e[4] < len(e[0])]
        return found

    def verify(self, d: int, grams: np.ndarray) -> tuple[float, float] | None:
        """Overlap of question and answer, if both reach the share."""
        overlaps = [float(np.isin(p, grams).mean()) for p in self.parts[d]]
        if min(overlaps) < self.share - 1e-9:
            return None
        return overlaps[0], overlaps[-1]


def stride_of(words: int) -> int:
    """Half a passage's words for items of so many words: the next power of two."""
    return 1 << max(0, words - 1).bit_length()


def _best_passages(index: ItemIndex, found: w.Words, g: np.ndarray) -> dict[tuple[int, int], tuple]:
    """(score, overlaps) of the best passage for each row and item that it leaks."""
    best: dict[tuple[int, int], tuple] = {}
    if len(index.terms) == 0:
        return best
    stride = index.longest
    place, term = index.lookup(g)
    row = np.searchsorted(found.first, place, side="right") - 1
    whole = place + index.k <= found.first[row + 1]
    place, term, row = place[whole], term[whole], row[whole]
    inside = place - found.first[row]
    # A term lies in the passage that starts before it and in the one before that.
    passage = np.concatenate([inside // stride, inside // stride - 1])
    row, place, term = np.tile(row, 2), np.tile(place, 2), np.tile(term, 2)
    ends = inside + index.k <= (inside // stride + 1) * stride
    keep = (passage >= 0) & np.concatenate([np.ones(len(ends), bool), ends])
    row, place, term, passage = row[keep], place[keep], term[keep], passage[keep]
    order = np.lexsort((place, passage, row))
    row, place, term, passage = row[order], place[order], term[order], passage[order]
    starts = np.append(np.flatnonzero(w.first_of_runs(row, passage)), len(row)) if len(row) else [0]
    for a, b in zip(starts[:-1], starts[1:]):
        for d, score in index.retrieve(np.unique(term[a:b])):
            shares = index.verify(d, g[place[a:b]])
            if shares:
                key = (int(row[a]), d)
                best[key] = max(best.get(key, (-1.0,)), (score, *shares))
    return best


def _search(batches: Iterator[pa.RecordBatch], indexes: list[ItemIndex], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, bodies = (batch.column(i).to_pylist() for i in (0, 2))
        out = []
        for low, _, data, bounds in w.text_slices(batch.column(1)):
            found = w.find_words(data, bounds, w.NOT_ALNUM)
            g = w.grams(w.word_hashes(found), k)
            if len(g):
                for index in indexes:
                    out += [(docs[low + r], index.ids[d], *v, bodies[low + r]) for (r, d), v in _best_passages(index, found, g).items()]
        columns = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], schema=pa.schema(_FIELDS))


def find_leaks(documents: DataFrame, benchmark: DataFrame, k: int = TERM, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, body), one row per
    document and test item that it leaks, with the best passage's figures; ``body``
    hashes the text."""
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    spark = documents.sparkSession

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*r, _terms(r[1] or "", k)) for r in zip(*(c.to_pylist() for c in batch.columns))]
            rows = [r for r in rows if len(r[2])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([len(r[2]) for r in rows], pa.int64()),
                 pa.array([w.signed(np.unique(r[2])) for r in rows], pa.list_(pa.int64()))], names=["item_id", "text", "n", "terms"],
            )

    known = materialise(items.mapInArrow(terms, "item_id long, text string, n long, terms array<long>"), "items")
    counts = materialise(known.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "item-terms")
    size, count, mean = known.agg(F.sum(F.octet_length("text")), F.count(F.lit(1)), F.avg("n")).first()
    blocks = int((size or 0) // INDEX_BYTES) + 1
    docs = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("body"))
    hits = []
    for block in range(blocks):
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        own = part.select(F.explode("terms").alias("term")).distinct()
        found = counts.join(own, "term", "left_semi").toArrow()  # terms of one block
        term, df = (np.asarray(found.column(i)) for i in range(2))
        order = np.argsort(term.view(np.uint64))
        figures = Statistics(term.view(np.uint64)[order], df[order], count, float(mean or 1))
        classes: dict[int, list] = {}
        for r in part.orderBy("item_id", "text").select("item_id", "text", "n").toLocalIterator():
            classes.setdefault(stride_of(r["n"] + k - 1), []).append((r["item_id"], r["text"]))
        indexes = [ItemIndex(own, k, share, figures, stride) for stride, own in sorted(classes.items())]
        shared = spark.sparkContext.broadcast(indexes)  # of at most INDEX_BYTES of text
        found = docs.mapInArrow(lambda it, shared=shared: _search(it, shared.value, k), HIT_SCHEMA)
        hits.append(materialise(found, "leaks") if blocks > 1 else found)
    return reduce(DataFrame.unionByName, hits)


def remove_leaks(documents: DataFrame, benchmark: DataFrame, k: int = TERM, share: float = SHARE) -> DataFrame:
    """``documents`` without those that leak a test item."""
    leaks = find_leaks(documents, benchmark, k, share).select("doc_id", "body").distinct()
    held = documents.select(*[F.col(c).alias(f"_d_{c}") for c in documents.columns])
    same = F.col("_d_doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64("_d_text") == F.col("body"))
    return held.join(leaks, same, "left_anti").select(*[F.col(f"_d_{c}").alias(c) for c in documents.columns])
