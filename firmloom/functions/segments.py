"""Splitting a raw company field into segments and choosing the one to search for."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from firmloom.functions.constants import BOOKING_NOISE, ORG_HINTS
from firmloom.functions.text import contains_any, empty_strings, let, nonempty, strip_chars, word_count

_EDGE = " ,;:-"
_MARKER = r"(?U)(?:^|\s)\d+\)\s*"


def normalize_segment(value: Column) -> Column:
    """Collapse blanks, drop a leading ``M/s`` and bracketed booking noise."""
    tidy = strip_chars(F.regexp_replace(value, r"(?U)[\s\x1c-\x1f]+", " "), _EDGE)
    tidy = F.regexp_replace(tidy, r"(?iU)^(?:m/s|m\.s\.)\s+", "")
    noisy = "|".join(BOOKING_NOISE)
    tidy = F.regexp_replace(tidy, r"(?iU)\((?=[^)]*(?:" + noisy + r"))[^)]*\)", "")
    return strip_chars(tidy, _EDGE)


def split_numbered_companies(raw: Column) -> Column:
    """``1) A 2) B`` gives [A, B]; anything with fewer than two markers stays whole."""

    def listed(pieces: Column) -> Column:
        return F.filter(F.transform(F.slice(pieces, 2, F.size(pieces)), normalize_segment), nonempty)

    markers = F.size(F.regexp_extract_all(raw, F.lit(_MARKER), F.lit(0)))
    found = F.when(markers >= 2, let(F.split(raw, _MARKER), listed)).otherwise(empty_strings())
    return let(found, lambda parts: F.when(F.size(parts) > 0, parts).otherwise(F.array(raw)))


def split_candidate_segments(raw: Column) -> Column:
    """Numbered parts, each split further on comma, semicolon and line break."""

    def parts_of(numbered: Column) -> Column:
        pieces = F.filter(F.transform(F.split(numbered, r"[,\n;]+"), normalize_segment), nonempty)
        return let(pieces, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(normalize_segment(numbered))))

    return F.filter(F.flatten(F.transform(split_numbered_companies(raw), parts_of)), nonempty)


def score_segment(segment: Column, keyword: Column) -> Column:
    """How much a segment looks like the company that is searched for."""
    lowered = F.lower(segment)

    def points(test: Column, value: int) -> Column:
        return F.when(F.coalesce(test, F.lit(False)), value).otherwise(0)

    return (
        points((keyword != "") & lowered.contains(F.lower(keyword)), 100)
        + points(contains_any(lowered, ORG_HINTS), 25)
        + points(lowered.contains("limited"), 15)
        + points(word_count(segment) <= 1, -10)
        + points(segment.contains(".") & ~segment.contains(" "), -90)
        + points(segment.rlike(r"(?U)^[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3}\z"), -20)
    )


def derive_search_company_name(raw: Column, keyword: Column) -> Column:
    """Segment with the highest (score, length), the earliest on ties."""
    ranked = F.array_sort(
        F.transform(
            split_candidate_segments(raw),
            lambda s, i: F.struct(
                (-score_segment(s, keyword)).alias("score"), (-F.length(s)).alias("len"), i.alias("pos"), s.alias("text")
            ),
        )
    )
    return F.coalesce(F.get(ranked, F.lit(0))["text"], normalize_segment(raw))


def assign_alternating(index: Column, primary: str, fallback: str | None, rotate: bool = True) -> Column:
    """(primary, fallback) pair, swapped on odd indexes when rotation is on."""

    def pair(a: str, b: str | None) -> Column:
        return F.struct(F.lit(a).alias("primary"), F.lit(b).cast("string").alias("fallback"))

    if not fallback or not rotate:
        return pair(primary, fallback)
    return F.when(F.pmod(index, F.lit(2)) == 1, pair(fallback, primary)).otherwise(pair(primary, fallback))
