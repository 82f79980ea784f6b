"""Company-name cleaning and ranking, and choice of summary texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from firmloom.functions.constants import GENERIC_COMPANY_NAMES, GENERIC_NAME_PHRASES, GENERIC_NAME_PREFIXES
from firmloom.functions.text import clean_text, contains_any, let, strip_chars

_EDGE = " |:-"


def normalize_company_name(candidate: Column) -> Column:
    """Strip separators, website boilerplate and a trailing " corporate"."""
    name = strip_chars(clean_text(candidate), _EDGE)
    name = strip_chars(F.regexp_replace(name, r"(?iU)\bOfficial Website\b", ""), _EDGE)
    name = strip_chars(F.regexp_replace(name, r"(?iU)\bHome Page\b", ""), _EDGE)

    def finish(n: Column) -> Column:
        shortened = strip_chars(F.substring(n, F.lit(1), F.length(n) - 10), _EDGE)
        whole = F.when(F.lower(n).endswith(" corporate"), shortened).otherwise(n)
        return F.when(whole != "", whole)

    return let(name, finish)


def title_name_candidates(title: Column) -> Column:
    """Parts of a title between spaced ``|``, ``-``, ``–`` or a bare ``|``."""
    parts = F.split(clean_text(title), r"(?U)\s+[|\-–]\s+|\|")
    named = F.transform(parts, normalize_company_name)
    return F.coalesce(F.array_distinct(F.filter(named, lambda p: p.isNotNull())), F.array().cast("array<string>"))


def is_strong_normalized_name(name: Column) -> Column:
    """The strength rules, for a name that is already normalised."""
    lowered = F.lower(name)
    shouting = (F.size(F.split(name, " ")) >= 4) & (name == F.upper(name))
    prefixed = lowered.rlike("^(?:" + "|".join(GENERIC_NAME_PREFIXES) + ")")
    return F.coalesce(
        ~lowered.isin(*GENERIC_COMPANY_NAMES)
        & ~contains_any(lowered, GENERIC_NAME_PHRASES)
        & ~shouting
        & ~prefixed
        & F.length(name).between(3, 60),
        F.lit(False),
    )


def is_strong_company_name(candidate: Column) -> Column:
    return let(normalize_company_name(candidate), is_strong_normalized_name)


def pick_company_name(candidates: Column) -> Column:
    """First strong candidate, normalised; null if none is strong."""
    named = F.transform(candidates, normalize_company_name)
    # Strength is judged on the name as it would be read back, hence normalised once more.
    return F.get(F.filter(named, is_strong_company_name), F.lit(0))


def pick_company_summary(summary: Column) -> Column:
    return let(clean_text(summary), lambda c: F.when(F.length(c) >= 40, F.left(c, F.lit(400))))


def pick_best_description(candidates: Column) -> Column:
    """Shortest candidate of 30 to 400 characters, the earliest on ties."""
    cleaned = F.filter(F.transform(candidates, clean_text), lambda c: F.length(c).between(30, 400))
    keyed = F.transform(cleaned, lambda c, i: F.struct(F.length(c).alias("n"), i.alias("pos"), c.alias("text")))
    return F.get(F.array_sort(keyed), F.lit(0))["text"]
