"""Language ID of words by a linear-chain conditional random field (operator 9).

Every word has features: its first and last bytes (affixes), all of its byte n-grams,
and its entry in a lexicon of training words.  The field adds learned transitions
between the languages of neighbouring words; forward-backward gives each word's language
in code-switched text, and a document's language is the one with the largest share of
its words.

Training: of each language the documents whose id hashes below a threshold, about
``SAMPLE_DOCS`` of them, and of each of these the ``SAMPLE_WORDS`` words of least hash of
their place, over the whole text (words above ``LONG_WORD`` bytes are predicted but not
learned from).  They are mixed into code-switched sequences; log likelihood by batched
forward-backward on the driver.  Every language of the documents is learned.

Prediction: one pass over whole texts and whole words, no shuffle.  Texts are cut into
blocks of words whose transfer matrices are multiplied and scanned, so a long text costs
no long loop and the result is the exact forward-backward of the whole text.

Cases: ``und`` with score 0 for null texts and texts without a letter, or if there is
nothing to learn from; a null doc_id is not learned from and not held out; rows of one
doc_id and language are learned from once; ties go to the language first in code point
order; repeated rows are predicted each; an empty table gives no rows; of the columns
kept, ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.llm import words as w

SAMPLE_DOCS = 300
SAMPLE_WORDS = 300
LONG_WORD = 256
HASHED = 1 << 15
SEQUENCES = 12_000  # training sequences a round
BLOCK = 32
_CELLS = 1 << 18  # numbers of n-gram weights in memory at once
_SLICE = 1 << 20  # bytes of text whose words are in memory at once
RESULT_SCHEMA = "lang_pred string, score double"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _hashed(kind: int, *parts: np.ndarray) -> np.ndarray:
    x = np.full(len(parts[0]), kind * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for part in parts:
        x = (x ^ part) * np.uint32(0x01000193)
        x ^= x >> np.uint32(15)
    return (x * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)


def _affixes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashed first and last bytes of words, one row each; absent ones are HASHED."""
    size = end - start
    last = max(len(data) - 1, 0)
    head = [w.LOWER[data[np.minimum(start + j, last)]].astype(np.uint32) for j in range(3)]
    tail = [w.LOWER[data[np.maximum(end - 1 - j, 0)]].astype(np.uint32) for j in range(4)]
    out = [np.where(size >= k, _hashed(k, *head[:k]), HASHED) for k in (1, 2, 3)]
    out += [np.where(size >= k, _hashed(10 + k, *tail[:k]), HASHED) for k in (1, 2, 3, 4)]
    return np.stack(out, axis=1).astype(np.int64)


def _grams(data: np.ndarray, start: np.ndarray, end: np.ndarray, piece: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, hashed n-gram) for all n-grams of all words, ``piece`` at a time."""
    for k in (2, 3):
        counts = np.maximum(end - start - k + 1, 0)
        ends = np.cumsum(counts)
        for low in range(0, int(ends[-1]) if len(ends) else 0, piece):
            flat = np.arange(low, min(low + piece, int(ends[-1])))
            word = np.searchsorted(ends, flat, side="right")
            at = start[word] + flat - (ends[word] - counts[word])
            yield word, _hashed(20 + k, *(w.LOWER[data[at + j]].astype(np.uint32) for j in range(k))).astype(np.int64)


def _weights(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over the features of each word."""
    out = np.zeros((len(start), table.shape[1]), np.float32)
    if not len(start):
        return out
    for column in _affixes(data, start, end).T:
        out += table[column]
    for word, gram in _grams(data, start, end, max(1024, _CELLS // table.shape[1])):
        runs = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[runs]] += np.add.reduceat(table[gram], runs, axis=0)
    return out


@dataclass
class Field:
    """Weights of a trained field; ``labels`` are in code point order."""

    labels: list[str]
    hashed: np.ndarray  # (HASHED + 1, labels); the last row is zero
    lexicon: np.ndarray  # sorted word hashes
    known: np.ndarray  # (lexicon + 1, labels); the last row is zero
    moves: np.ndarray  # transition probabilities, up to a factor per row
    first: np.ndarray

    def entries(self, hashes: np.ndarray) -> np.ndarray:
        if len(self.lexicon) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def emissions(self, found: w.Words) -> tuple[np.ndarray, np.ndarray]:
        """exp(score) of each word and label, and whether the word has a letter."""
        hashes = w.word_hashes(found)
        kinds, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        start, end = found.start[one], found.end[one]
        scores = self.known[self.entries(kinds)] + _weights(found.data, start, end, self.hashed)
        letters = np.zeros(len(found.data) + 1, np.int64)
        np.cumsum(_LETTER[found.data], out=letters[1:])
        worded = letters[end] > letters[start]
        scores[~worded] = 0
        scores -= scores.max(axis=1, keepdims=True)
        return np.exp(np.maximum(scores, -30))[which], worded[which]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)


def _messages(emit: np.ndarray, moves: np.ndarray, first: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Scaled forward messages over concatenated texts that start at ``begin``.

    A block's transfer matrix is the product of its words'; messages enter the blocks
    by the same scan over the matrices, and then run inside all blocks at once.
    """
    n, k = emit.shape
    if n == 0:
        return emit
    blocks = -(-n // BLOCK)
    padded = np.ones((blocks * BLOCK, k), np.float32)
    padded[:n] = emit
    fresh = np.zeros(blocks * BLOCK, bool)
    fresh[begin] = True
    padded, fresh = padded.reshape(blocks, BLOCK, k), fresh.reshape(blocks, BLOCK)
    product = np.broadcast_to(np.eye(k, dtype=np.float32), (blocks, k, k)).copy()
    for t in range(BLOCK):
        step = product @ moves
        new = fresh[:, t]
        if new.any():
            step[new] = first
        product = _scaled(step * padded[:, t, None, :])
    entering = np.empty((blocks, k), np.float32)
    message = first.copy()
    if blocks <= 4 * BLOCK:
        for b in range(blocks):
            entering[b] = message
            message = message @ product[b]
            message /= message.sum()
    else:
        entering = _scan(product, first)
    out = np.empty((blocks, BLOCK, k), np.float32)
    message = entering
    for t in range(BLOCK):
        message = message @ moves
        message[fresh[:, t]] = first
        message = _scaled(message * padded[:, t])
        out[:, t] = message
    return out.reshape(-1, k)[:n]


def _scan(matrices: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The message that enters each of the matrices, in order."""
    n, k, _ = matrices.shape
    if n <= 4 * BLOCK:
        out = np.empty((n, k), np.float32)
        message = first.copy()
        for i in range(n):
            out[i] = message
            message = message @ matrices[i]
            message /= message.sum()
        return out
    blocks = -(-n // BLOCK)
    padded = np.broadcast_to(np.eye(k, dtype=np.float32), (blocks * BLOCK, k, k)).copy()
    padded[:n] = matrices
    padded = padded.reshape(blocks, BLOCK, k, k)
    product = padded[:, 0]
    for t in range(1, BLOCK):
        product = _scaled(product @ padded[:, t])
    message = _scan(product, first)
    out = np.empty((blocks, BLOCK, k), np.float32)
    for t in range(BLOCK):
        out[:, t] = message
        message = _scaled((message[:, None, :] @ padded[:, t])[:, 0])
    return out.reshape(-1, k)[:n]


def posteriors(emit: np.ndarray, moves: np.ndarray, first: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each word's label probabilities by forward-backward; ``bounds`` delimit texts."""
    n, k = emit.shape
    begin = bounds[:-1][np.diff(bounds) > 0]
    stop = bounds[1:][np.diff(bounds) > 0]
    forward = _messages(emit, moves, first, begin)
    # The backward message of a word, times its emission, runs over the reversed texts.
    ones = np.full(k, 1 / k, np.float32)
    back = _messages(emit[::-1], np.ascontiguousarray(moves.T), ones, n - stop)[::-1]
    return _scaled(forward * back / np.maximum(emit, 1e-30))


def _train(texts: list[tuple[str, str]], labels: list[str], rounds: int = 10, length: int = 32, seed: int = 11) -> Field:
    """Fit on (words, label) pairs by gradient steps on mixed sequences."""
    rng = np.random.default_rng(seed)
    place = {name: c for c, name in enumerate(labels)}
    raws = [np.frombuffer(text.encode("utf-8"), np.uint8) for text, _ in texts]
    found = w.find_words(np.concatenate(raws), np.concatenate([[0], np.cumsum([len(r) for r in raws])]))
    label = np.array([place[lang] for _, lang in texts])[found.rows]
    k = len(labels)
    # From here on words are distinct ones, with their features side by side.
    hashes, one, kind, counts = np.unique(w.word_hashes(found), return_index=True, return_inverse=True, return_counts=True)
    start, end = found.start[one], found.end[one]
    owners, ids = [np.repeat(np.arange(len(one)), 7)], [_affixes(found.data, start, end).ravel()]
    for word, gram in _grams(found.data, start, end, _CELLS):
        owners.append(word)
        ids.append(gram)
    owners, ids = np.concatenate(owners), np.concatenate(ids)
    order = np.argsort(owners, kind="stable")
    ids, bounds = ids[order], np.searchsorted(owners[order], np.arange(len(one) + 1))
    lexicon = hashes[counts > 2]
    field = Field(labels, np.zeros((HASHED + 1, k), np.float32), lexicon, np.zeros((len(lexicon) + 1, k), np.float32), np.ones((k, k), np.float32), np.full(k, 1 / k, np.float32))
    entry = field.entries(hashes)
    runs = [np.flatnonzero(label == c) for c in range(k)]
    runs = [r for r in runs if len(r)]
    steps = np.zeros((k, k))
    sums = [np.full(x.shape, 1e-2) for x in (field.hashed, field.known, steps)]
    sequences = min(SEQUENCES, max(64, len(label) // length))
    for _ in range(rounds):
        # Sequences of one to four runs of neighbouring words, each of one language.
        rows, size = [], length
        for _ in range(sequences):
            parts = rng.integers(1, 5)
            pick = [runs[c] for c in rng.integers(0, len(runs), parts)]
            cuts = np.diff(np.concatenate([[0], np.sort(rng.integers(0, size + 1, parts - 1)), [size]]))
            rows.append(np.concatenate([np.take(r, rng.integers(0, len(r)) + np.arange(c), mode="wrap") for r, c in zip(pick, cuts)]))
        for some in np.array_split(np.stack(rows), max(1, len(rows) // 256)):
            flat = some.ravel()
            used, where = np.unique(kind[flat], return_inverse=True)
            width = bounds[used + 1] - bounds[used]
            at = np.repeat(bounds[used] - np.cumsum(width) + width, width) + np.arange(int(width.sum()))
            feature = ids[at]
            scores = np.add.reduceat(field.hashed[feature], np.cumsum(width) - width, axis=0) + field.known[entry[used]]
            emit = np.exp(scores - scores.max(axis=1, keepdims=True)).clip(1e-13)[where].reshape(*some.shape, k)
            moves = np.exp(steps)
            alpha, beta = np.empty(emit.shape), np.empty(emit.shape)
            alpha[:, 0] = _scaled(emit[:, 0])
            for t in range(1, size):
                alpha[:, t] = _scaled((alpha[:, t - 1] @ moves) * emit[:, t])
            beta[:, -1] = 1
            for t in range(size - 2, -1, -1):
                beta[:, t] = _scaled((beta[:, t + 1] * emit[:, t + 1]) @ moves.T)
            gamma = alpha * beta
            gamma /= gamma.sum(axis=2, keepdims=True)
            # Expected transitions: each neighbouring pair's chances sum to one.
            front, behind = alpha[:, :-1].reshape(-1, k), (beta[:, 1:] * emit[:, 1:]).reshape(-1, k)
            pairs = moves * ((front / ((front @ moves) * behind).sum(axis=1, keepdims=True)).T @ behind)
            truth = np.eye(k)[label[flat]]
            miss = (gamma.reshape(-1, k) - truth) / len(some)
            seen = truth.reshape(*some.shape, k)
            taken = seen[:, :-1].reshape(-1, k).T @ seen[:, 1:].reshape(-1, k)
            grads = [np.zeros(field.hashed.shape), np.zeros(field.known.shape), (pairs - taken) / len(some)]
            for c in range(k):
                own = np.bincount(where, miss[:, c], minlength=len(used))
                grads[0][:, c] = np.bincount(feature, np.repeat(own, width), minlength=HASHED + 1)
                grads[1][:, c] = np.bincount(entry[used], own, minlength=len(lexicon) + 1)
            grads[0][-1] = 0
            grads[1][-1] = 0
            for x, g, s, rate in zip((field.hashed, field.known, steps), grads, sums, (0.1, 0.1, 0.2)):
                s += g * g
                x -= (rate * g / np.sqrt(s)).astype(x.dtype)
    field.moves = np.exp(steps - steps.max()).astype(np.float32)
    return field


def _sampled_words(batches: Iterator[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, lang, words): of each text the ``number`` words whose places hash least."""
    for batch in batches:
        ids, langs = (batch.column(i).to_pylist() for i in range(2))
        for low, _, data, bounds in w.text_slices(batch.column(2)):
            found = w.find_words(data, bounds)
            short = np.flatnonzero(found.end - found.start <= LONG_WORD)
            row = found.rows[short]
            place = w.mix((short - found.first[row]).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            order = np.lexsort((place, row))
            nth = np.arange(len(order)) - np.searchsorted(row, row)[order]  # rows ascend in ``order``, too
            kept = short[np.sort(order[nth < number])]
            out: dict[int, list[str]] = {}
            for r, s, e in zip(found.rows[kept].tolist(), found.start[kept].tolist(), found.end[kept].tolist()):
                out.setdefault(r, []).append(data[s:e].tobytes().decode("utf-8", "replace"))
            some = sorted(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[low + r] for r in some], pa.string()), pa.array([langs[low + r] for r in some], pa.string()),
                 pa.array([" ".join(out[r]) for r in some], pa.string())], names=["doc_id", "lang", "text"],
            )


def learn_languages(documents: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """A field learned from (doc_id, text, lang) rows with a language and a text."""
    rows = documents.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    )
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.join(F.broadcast(counts), "lang").where(place * F.col("n") < sample_docs)  # a row per language
    chosen = chosen.select("doc_id", "lang", "text").mapInArrow(lambda it: _sampled_words(it, SAMPLE_WORDS), "doc_id string, lang string, text string")
    found = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()  # about sample_docs a language
    labels = sorted({r["lang"] for r in counts.collect()}, key=lambda x: x.encode("utf-8"))
    texts = [(r["text"], r["lang"]) for r in sorted(found)]
    return _train(texts, labels) if texts else None


def _predict(batches: Iterator[pa.RecordBatch], field: Field | None, at: int, kept: int) -> Iterator[pa.RecordBatch]:
    """The first ``kept`` columns of each batch, with label and score of the texts ``at``."""
    limit = _SLICE // max(1, len(field.labels) // 8) if field else _SLICE
    for batch in batches:
        text = batch.column(at)
        names, scores = [], []
        for _, _, data, bounds in w.text_slices(text, limit):
            rows = len(bounds) - 1
            found = w.find_words(data, bounds)
            letters = np.zeros(len(data) + 1, np.int64)
            np.cumsum(_LETTER[data] & (data < 128), out=letters[1:])
            lettered = letters[bounds[1:]] > letters[bounds[:-1]]
            for r in np.flatnonzero(~lettered & (np.diff(bounds) > 0)):
                raw = data[bounds[r] : bounds[r + 1]].tobytes().decode("utf-8", "replace")
                lettered[r] = any(c.isalpha() for c in raw)
            if field is None:
                names += ["und"] * rows
                scores += [0.0] * rows
                continue
            emit, worded = field.emissions(found)
            chances = posteriors(emit, field.moves, field.first, found.first) * worded[:, None]
            sums = np.zeros((len(chances) + 1, len(field.labels)))
            np.cumsum(chances, axis=0, out=sums[1:])
            total = np.round(sums[found.first[1:]] - sums[found.first[:-1]], 6)
            whole = total.sum(axis=1)
            best = total.argmax(axis=1)
            share = total[np.arange(rows), best] / np.maximum(whole, 1e-9)
            known = lettered & (whole > 0)
            names += [field.labels[b] if ok else "und" for b, ok in zip(best, known)]
            scores += np.where(known, np.clip(share, 0, 1), 0.0).tolist()
        columns = [*batch.columns[:kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], "lang_pred", "score"])


def predict_languages(documents: DataFrame, field: Field | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with lang_pred and score of every row."""
    names = [c for c in keep if c not in ("lang_pred", "score")]
    # A text that is kept goes to the worker once.
    given = documents.select(*names) if "text" in names else documents.select(*names, F.col("text").alias("_text"))
    at = names.index("text") if "text" in names else len(names)
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in names)
    return given.mapInArrow(lambda it: _predict(it, field, at, len(names)), f"{kinds}, {RESULT_SCHEMA}")


def word_languages(text: str, field: Field) -> list[tuple[str, str]]:
    """(word, language) of a code-switched text."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    found = w.find_words(raw, np.array([0, len(raw)]))
    emit, _ = field.emissions(found)
    best = posteriors(emit, field.moves, field.first, found.first).argmax(axis=1)
    return [(raw[s:e].tobytes().decode("utf-8"), field.labels[b]) for s, e, b in zip(found.start, found.end, best)]


def fold(column, n: int):
    """crc32 of an id as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))
