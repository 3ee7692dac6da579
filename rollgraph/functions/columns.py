"""Column helpers for padded text, keys and canonical addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(line: Column, start: int, end: int) -> Column:
    """Half-open, zero-based slice of a line; past the end gives ``''``."""
    return F.substring(line, start + 1, end - start)


def blank_to_null(text: Column) -> Column:
    """Drop padding on the right; nothing left means null."""
    return F.nullif(F.rtrim(text), F.lit(""))


def sentinel_to_null(text: Column, sentinels: Sequence[str] = ("NAN",)) -> Column:
    """Null out placeholder words; pass ``()`` to keep an owner called NAN."""
    return F.when(~text.isin(*sentinels), text) if sentinels else text


def padded_number(text: Column) -> Column:
    """Zero-filled digits to bigint; anything else to null."""
    return F.trim(text).try_cast("bigint")


def padded_date(text: Column) -> Column:
    """``yyyyMMdd`` to date; all zeros or blanks to null."""
    return F.try_to_date(F.trim(text), "yyyyMMdd")


def as_text(value: Column) -> Column:
    """Text form in which a missing value stays missing."""
    return value.cast("string")


def joined_key(*parts: Column) -> Column:
    """Plain concatenation: null as soon as one part is null."""
    return F.concat(*[p.cast("string") for p in parts])


def stable_id(label: str, *parts: Column) -> Column:
    """128-bit node id, the same in every run; null parts keep their place."""
    shown = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(label), *shown))


def _tidy(text: Column) -> Column:
    squeezed = F.trim(F.regexp_replace(F.upper(text.cast("string")), r"\s+", " "))
    return F.nullif(squeezed, F.lit(""))


def canonical_address(
    line1: Column, line2: Column, city: Column, postal: Column, country: Column
) -> Column:
    """One text per postal address: tidied lines and the whole postal code."""
    lines = [_tidy(line1), _tidy(line2), _tidy(city), _tidy(postal), _tidy(country)]
    text = F.concat_ws("\n", *lines)
    return F.nullif(text, F.lit(""))


def phonetic_key(text: Column) -> Column:
    """Sound code of a name, for use as a blocking key."""
    return F.soundex(text)
