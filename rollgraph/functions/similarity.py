"""Jaro-Winkler similarity as an Arrow column function (L4)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_FROM = 0.7


def _codes(texts: pd.Series, width: int) -> np.ndarray:
    """Characters as a padded matrix of code points; padding is -1."""
    out = np.full((len(texts), width), -1, dtype=np.int32)
    for row, text in enumerate(texts):
        out[row, : len(text)] = np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)
    return out


def _match_flags(a, b, len_a, len_b):
    """Greedy matching of Jaro: each character of ``a`` takes the first free equal
    character of ``b`` inside the window."""
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    free = np.ones(b.shape, dtype=bool)
    used_a = np.zeros(a.shape, dtype=bool)
    at_b = np.arange(b.shape[1])[None, :]
    rows = np.arange(a.shape[0])
    for i in range(a.shape[1]):
        near = np.abs(at_b - i) <= reach[:, None]
        fits = free & near & (b == a[:, i, None]) & (i < len_a)[:, None]
        hit = fits.any(axis=1)
        first = fits.argmax(axis=1)
        free[rows[hit], first[hit]] = False
        used_a[:, i] = hit
    return used_a, ~free


def _in_order(codes: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Matched characters moved to the front, the rest set to -1."""
    order = np.argsort(~used, axis=1, kind="stable")
    return np.where(
        np.take_along_axis(used, order, axis=1), np.take_along_axis(codes, order, axis=1), -1
    )


def _batch(left: pd.Series, right: pd.Series) -> np.ndarray:
    len_a = left.str.len().to_numpy(dtype=np.int64)
    len_b = right.str.len().to_numpy(dtype=np.int64)
    width = int(max(len_a.max(), len_b.max(), 1))
    a, b = _codes(left, width), _codes(right, width)
    used_a, used_b = _match_flags(a, b, len_a, len_b)
    m = used_a.sum(axis=1).astype(float)
    swapped = (_in_order(a, used_a) != _in_order(b, used_b)).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / len_a + m / len_b + (m - swapped) / m) / 3.0, 0.0)
    head = (a[:, :PREFIX_LENGTH] == b[:, :PREFIX_LENGTH]) & (a[:, :PREFIX_LENGTH] >= 0)
    prefix = np.cumprod(head, axis=1).sum(axis=1)
    boost = prefix * PREFIX_WEIGHT * (1.0 - jaro)
    return np.where(jaro > BOOST_FROM, jaro + boost, jaro)


def jaro_winkler_batch(left: pd.Series, right: pd.Series, cells: int = 4_000_000) -> pd.Series:
    """Similarity of two text columns; null where either side is null.

    Works in slices of similar length so that one long text does not widen the
    whole batch.
    """
    out = np.full(len(left), np.nan)
    present = (left.notna() & right.notna()).to_numpy()
    if not present.any():
        return pd.Series(out)
    at = np.flatnonzero(present)
    longest = np.maximum(left.iloc[at].str.len(), right.iloc[at].str.len().to_numpy()).to_numpy()
    order = at[np.argsort(longest, kind="stable")]
    longest = np.sort(longest, kind="stable")
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and (end + 1 - start) * (int(longest[end]) + 1) <= cells:
            end += 1
        part = order[start:end]
        out[part] = _batch(
            left.iloc[part].reset_index(drop=True), right.iloc[part].reset_index(drop=True)
        )
        start = end
    return pd.Series(out)


@F.pandas_udf(DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    """Column form of ``jaro_winkler_batch``; use it on distinct value pairs."""
    sims = jaro_winkler_batch(left, right)
    return sims.astype(object).where(sims.notna(), None)
