"""Whitespace, trimming and small array helpers shared by all functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside array lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_text(value: Column) -> Column:
    """Collapse whitespace, strip, and turn the empty string into null."""
    return F.nullif(F.trim(F.regexp_replace(value, WHITESPACE_RUN, " ")), F.lit(""))


def strip_chars(value: Column, chars: str) -> Column:
    return F.btrim(value, F.lit(chars))


def nonempty(value: Column) -> Column:
    """True for a value that is neither null nor the empty string."""
    return F.coalesce(value != "", F.lit(False))


def first_nonempty(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def contains_any(value: Column, words: Iterable[str]) -> Column:
    """True if any of the literal ``words`` occurs; one pass over the text."""
    return value.rlike("|".join(re.escape(w) for w in words))


def ends_stripped(value: Column, char: str) -> Column:
    """Drop every trailing ``char``."""
    return F.rtrim(value, F.lit(char))


def sorted_distinct(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def unique_nonempty(values: Column) -> Column:
    """Clean every element, drop empty ones, keep the first of each value in order."""
    return F.array_distinct(F.filter(F.transform(values, clean_text), lambda v: v.isNotNull()))


def word_count(value: Column) -> Column:
    cleaned = clean_text(value)
    return F.when(cleaned.isNull(), F.lit(0)).otherwise(F.size(F.split(cleaned, " ")))


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def first_of(values: Column, limit: int | None) -> Column:
    """The first ``limit`` values of an array, or all of them."""
    return values if limit is None else F.slice(values, 1, limit)
