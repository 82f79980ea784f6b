"""Strict e-mail, phone, location and social-profile extraction from text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from firmloom.functions.constants import (
    EMAIL_PATTERN,
    GENERIC_SOCIAL_PATHS,
    LABELED_PHONE_PATTERNS,
    LOCATION_PATTERNS,
    NON_LOCATION_WORDS,
    PROFILE_SOCIAL_DOMAINS,
    SOCIAL_ACTION_FRAGMENTS,
    STRICT_EMAIL_PATTERN,
    TEXT_PHONE_PATTERN,
)
from firmloom.functions.text import (
    clean_text,
    contains_any,
    empty_strings,
    ends_stripped,
    let,
    strip_chars,
    unique_nonempty,
)
from firmloom.functions.urls import url_authority, url_path


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """Every match of ``pattern``; an empty array for null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), empty_strings())


def find_emails(text: Column, pattern: str = EMAIL_PATTERN) -> Column:
    """Every address-like match; texts without an ``@`` are not scanned."""
    return F.when(text.contains("@"), find_all(text, pattern)).otherwise(empty_strings())


def _or_empty(values: Column | None) -> Column:
    return empty_strings() if values is None else F.coalesce(values, empty_strings())


def extract_emails(text: Column, direct: Column | None = None) -> Column:
    """Direct addresses first, then those found in the text; lower case, checked, distinct."""
    candidates = F.concat(_or_empty(direct), find_emails(text))
    cleaned = F.transform(candidates, lambda c: strip_chars(F.lower(clean_text(c)), " .,:;"))
    return F.array_distinct(
        F.filter(cleaned, lambda e: F.coalesce(e.rlike(STRICT_EMAIL_PATTERN) & ~e.contains(".."), F.lit(False)))
    )


def normalize_phone_candidate(value: Column) -> Column:
    """Collapse blanks and drop a trailing extension."""
    bare = F.regexp_replace(clean_text(value), r"(?iU)(?:ext|extension|x)\s*\d+$", "")
    return F.nullif(strip_chars(bare, " ,;"), F.lit(""))


def is_valid_phone_candidate(value: Column) -> Column:
    def judged(groups: Column) -> Column:
        digits = F.array_join(groups, "")
        all_equal = F.regexp_replace(digits, F.substring(digits, 1, 1), "") == ""
        in_years = F.forall(groups, lambda g: F.coalesce(g.try_cast("bigint").between(1900, 2099), F.lit(False)))
        year_like = (
            (F.size(groups) >= 2)
            & (F.length(F.get(groups, F.lit(0))) == 4)
            & (F.length(F.get(groups, F.lit(1))) == 4)
            & in_years
        )
        return (
            (F.size(groups) < 5)
            & F.length(digits).between(8, 15)
            & ~all_equal
            & ~year_like
            & ~value.rlike("[A-Za-z.]")
            & ~value.rlike(r"(?U)^(?:\d\s+){4,}\d\z")
            & ~value.rlike(r"(?U)\b(?:19|20)\d{2}\s*-\s*(?:19|20)\d{2}\b")
        )

    return F.coalesce(let(F.regexp_extract_all(value, F.lit(r"(?U)\d+"), F.lit(0)), judged), F.lit(False))


def format_phone_candidate(value: Column) -> Column:
    """Keep ``+…`` and grouped numbers as written; reduce the rest to digits."""
    tidy = F.trim(F.regexp_replace(value, r"(?U)\s+", " "))
    grouped = tidy.startswith("+") | tidy.rlike("[ \\-(]")
    return F.when(grouped, tidy).otherwise(F.regexp_replace(tidy, r"(?U)\D", ""))


def labeled_phone_candidates(text: Column) -> Column:
    """Numbers written after a phone-like label.

    The labels are only searched in texts that hold such a number at all.
    """
    labeled = F.concat(*[find_all(text, p, 1) for p in LABELED_PHONE_PATTERNS])
    return F.when(text.rlike(TEXT_PHONE_PATTERN), labeled).otherwise(empty_strings())


def _accepted_phones(candidates: Column) -> Column:
    normalized = F.transform(candidates, normalize_phone_candidate)
    return F.transform(F.filter(normalized, is_valid_phone_candidate), format_phone_candidate)


def extract_phones(text: Column, tel_links: Column | None = None, blocks: Column | None = None) -> Column:
    """Telephone links, then focused blocks; labelled numbers of the body only if both gave nothing."""
    tels = F.transform(_or_empty(tel_links), lambda t: F.regexp_replace(t, "^tel:", ""))
    block_hits = F.flatten(
        F.transform(_or_empty(blocks), lambda b: F.concat(labeled_phone_candidates(b), find_all(b, TEXT_PHONE_PATTERN)))
    )
    primary = _accepted_phones(F.concat(tels, block_hits))
    chosen = let(
        primary,
        lambda found: F.when(F.size(found) > 0, found).otherwise(_accepted_phones(labeled_phone_candidates(text))),
    )
    return unique_nonempty(chosen)


def is_plausible_location(value: Column) -> Column:
    def judged(cleaned: Column) -> Column:
        commas = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(","), F.lit("")))
        return (
            F.length(cleaned).between(6, 140)
            & ~cleaned.rlike(r"(?U)^[\d\s,.\-]+$")
            & (commas <= 6)
            & ~((commas == 0) & (F.length(cleaned) > 50))
            & ~contains_any(F.lower(cleaned), NON_LOCATION_WORDS)
            & cleaned.rlike("[A-Za-z]")
        )

    return F.coalesce(let(clean_text(value), judged), F.lit(False))


def extract_location_mentions(text: Column, structured: Column | None = None) -> Column:
    """Structured places, then places named by a phrase; the first ten, then distinct."""
    mentioned = F.concat(*[find_all(text, p, 1) for p in LOCATION_PATTERNS])
    plausible = F.filter(F.concat(_or_empty(structured), mentioned), is_plausible_location)
    return unique_nonempty(F.slice(plausible, 1, 10))


def is_valid_social_profile(link: Column) -> Column:
    def judged(p: Column) -> Column:
        domain, path, segments = p["domain"], p["path"], p["segments"]
        first, second = F.get(segments, F.lit(0)), F.get(segments, F.lit(1))
        named = (F.size(segments) >= 1) & ~F.lower(first).isin(*GENERIC_SOCIAL_PATHS)
        on_linkedin = (
            (F.size(segments) >= 2) & first.isin("company", "in", "school") & ~second.isin(*GENERIC_SOCIAL_PATHS)
        )
        return (
            F.when(domain.contains("linkedin.com"), on_linkedin)
            .when(domain.contains("youtube.com"), path.startswith("/@") | first.isin("channel", "c", "user"))
            .when(contains_any(domain, ("facebook.com", "instagram.com", "x.com", "twitter.com", "tiktok.com")), named)
        )

    path = url_path(link)
    parts = F.struct(
        F.lower(url_authority(link)).alias("domain"), path.alias("path"),
        F.filter(F.split(path, "/"), lambda s: s != "").alias("segments"),
    )
    return F.coalesce(let(parts, judged), F.lit(False))


def clean_social_profiles(links: Column) -> Column:
    """Profile links of known networks; share, intent and search links dropped."""
    on_network = F.filter(
        links,
        lambda v: contains_any(F.lower(v), PROFILE_SOCIAL_DOMAINS) & ~contains_any(F.lower(v), SOCIAL_ACTION_FRAGMENTS),
    )
    bare = F.transform(on_network, lambda v: ends_stripped(F.substring_index(v, "?", 1), "/"))
    return unique_nonempty(F.filter(bare, is_valid_social_profile))
