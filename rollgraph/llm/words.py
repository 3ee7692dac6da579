"""Words, word hashes and shingles of whole Arrow columns, without a loop over words.

Texts are cut into slices of a few megabytes (one text is never cut), so memory
follows the longest text and not the batch.  Hashes have 64 bits: a polynomial
over random byte weights, modulo 2**64, and a final mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Bytes of words that are compared without punctuation: letters, digits, not ASCII.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_WEIGHTS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@dataclass
class Words:
    """Words of consecutive rows: byte bounds in ``data``, first word of each row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more than rows

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64 if wide else np.int32) if bounds else np.zeros(1, np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, row bounds in them); null texts are empty."""
    raw, offsets = _buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(rows, max(stop, row + 1))
        low, high = offsets[row], offsets[stop]
        yield row, stop, raw[low:high], offsets[row : stop + 1] - low
        row = stop


def find_words(data: np.ndarray, bounds: np.ndarray, breaks: np.ndarray = BLANK) -> Words:
    """Maximal runs of bytes that are no ``breaks``; a row's end ends a word, too."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(bounds), np.int64))
    gap = breaks[data]
    filled = np.flatnonzero(np.diff(bounds) > 0)
    edge = np.empty(len(data), bool)
    edge[0] = True
    edge[1:] = gap[:-1]
    edge[bounds[filled]] = True
    start = np.flatnonzero(edge & ~gap)
    edge[-1] = True
    edge[:-1] = gap[1:]
    edge[bounds[filled + 1] - 1] = True
    end = np.flatnonzero(edge & ~gap) + 1
    return Words(data, start, end, np.searchsorted(start, bounds).astype(np.int64))


def word_hashes(words: Words, lower: bool = True) -> np.ndarray:
    """One 64-bit hash per word."""
    n = len(words.start)
    out = np.zeros(n, _U)
    weights = _WEIGHTS[LOWER] if lower else _WEIGHTS
    done = 0
    while done < n:
        low = words.start[done]
        stop = int(np.searchsorted(words.end, low + _CHUNK, side="right"))
        if stop <= done:  # one word longer than a chunk
            out[done] = _long_word(words.data[low : words.end[done]], weights)
            done += 1
            continue
        high = words.end[stop - 1]
        up, down = powers(int(high - low))
        sums = np.zeros(high - low + 1, _U)
        np.cumsum(weights[words.data[low:high]] * up, out=sums[1:])
        s, e = words.start[done:stop] - low, words.end[done:stop] - low
        out[done:stop] = (sums[e] - sums[s]) * down[s]
        done = stop
    return mix(out)


def _long_word(data: np.ndarray, weights: np.ndarray) -> np.uint64:
    up, _ = powers(_CHUNK)
    total = 0
    for k in range(0, len(data), _CHUNK):
        part = weights[data[k : k + _CHUNK]]
        total += int((part * up[: len(part)]).sum(dtype=_U)) * pow(_BASE, k, 1 << 64)
    return _U(total % (1 << 64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, rows ignored; empty with fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    factor = 1
    for j in range(k):
        total += hashes[j : j + n] * _U(factor)
        factor = factor * _BASE % (1 << 64)
    return mix(total)


def span_hashes(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words from ``low`` up to ``high``."""
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[high] - sums[low]) * down[low] + (high - low).astype(_U))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the row before."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
    return new
