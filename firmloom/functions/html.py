"""Signals read from an HTML column with built-in expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

from firmloom.functions.constants import (
    ADDRESS_PATTERN,
    ASCII_ADDRESS_PATTERN,
    ASCII_EMAIL_PATTERN,
    ASCII_PAGE_PHONE_PATTERN,
    COMPANY_NODE_TYPES,
    EMAIL_PATTERN,
    JSON_LD_PATTERN,
    META_DESCRIPTION_PATTERN,
    PAGE_PHONE_PATTERN,
    PAGE_SOCIAL_DOMAINS,
    PAGE_TYPE_HINTS,
    PAGE_TYPE_PRIORITY,
    TITLE_PATTERN,
)
from firmloom.functions.contacts import find_all, find_emails
from firmloom.functions.text import (
    let,
    clean_text,
    contains_any,
    empty_strings,
    ends_stripped,
    first_nonempty,
    sorted_distinct,
    strip_chars,
)
from firmloom.functions.urls import first_matching

# Comments and script/style bodies; an unclosed one runs to the end of the text.
# Both begin after one bracket, so that other characters are passed without trying either.
_HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z))"
_ANCHOR = r"""(?is)<a(?=[\s/>])((?:"[^"]*+"|'[^']*+'|[^>"']++)*+)[^>]*>"""
ATTRIBUTE_PATTERN = r"""(?s)([^\s=/>"']++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+)"""
# A character reference: numeric, or a name that may go on for 32 characters; longer runs of letters end there.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names of the HTML standard; those without a semicolon also count as the head of a longer run.
_NAMES = {n.removesuffix(";"): c for n, c in html5.items() if n.endswith(";")}
_BARE_NAMES = {n: c for n, c in html5.items() if not n.endswith(";")}
_BARE_HEAD = "^&(" + "|".join(sorted(_BARE_NAMES, key=lambda n: (-len(n), n))) + ")"
# Numbers 80 to 9F mean the characters of the Windows code page, where it has any.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_WINDOWS = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0))


def _numeric_character(ref: Column) -> Column:
    hexed = F.regexp_extract(ref, "^&#[xX]0*([0-9a-fA-F]+);?$", 1)
    decimal = F.regexp_extract(ref, "^&#([0-9]+);?$", 1)
    code = F.when(hexed != "", hexed).otherwise(F.hex(decimal.try_cast("bigint")))
    number = F.when(F.length(code) <= 6, F.conv(code, 16, 10).cast("bigint"))
    text = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    nothing = (
        number.between(1, 8) | number.isin(0x0B, 0x7F) | number.between(0x0E, 0x1F) | number.between(0xFDD0, 0xFDEF)
        | (number % 0x10000 >= 0xFFFE)
    )
    character = F.translate(F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"), _C1, _WINDOWS)
    return F.when(text, F.when(nothing, F.lit("")).when(number == 0xFEFF, F.lit("\ufeff")).otherwise(character)).otherwise(F.lit("\ufffd"))


def _named_character(ref: Column) -> Column:
    """A whole name, else the longest name at the head that needs no semicolon, else the text as it is."""
    names, bare = (F.from_json(F.lit(json.dumps(n)), "map<string,string>") for n in (_NAMES, _BARE_NAMES))
    head = F.regexp_extract(ref, _BARE_HEAD, 1)
    whole = F.when(ref == "&amp;", F.lit("&")).when(ref.endswith(";"), F.element_at(names, F.substr(ref, F.lit(2), F.length(ref) - 2)))
    part = F.when(head != "", F.concat(F.element_at(bare, head), F.substr(ref, F.length(head) + 2)))
    return F.coalesce(whole, part, ref)


def unescape_entities(value: Column) -> Column:
    """Replace character references, in one pass from left to right: what a reference gives is not read again."""
    texts = F.split(value, _REFERENCE, -1)
    refs = F.regexp_extract_all(value, F.lit(_REFERENCE), F.lit(0))
    read = F.transform(refs, lambda r: F.when(r.startswith("&#"), _numeric_character(r)).otherwise(_named_character(r)))
    out = F.array_join(F.zip_with(texts, read, lambda t, c: F.concat(t, F.coalesce(c, F.lit("")))), "")
    return F.when(value.contains("&"), out).otherwise(value)


def page_title(html: Column) -> Column:
    return clean_text(F.regexp_extract(html, TITLE_PATTERN, 1))


def meta_description(html: Column) -> Column:
    return clean_text(F.regexp_extract(html, META_DESCRIPTION_PATTERN, 1))


def without_hidden_markup(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, " ")


def anchor_hrefs(html: Column) -> Column:
    """Non-empty ``href`` of every visible anchor, in order, entities decoded.

    Page-internal (``#…``) and ``javascript:`` references are left out.
    """
    tags = F.regexp_extract_all(without_hidden_markup(html), F.lit(_ANCHOR), F.lit(1))
    # One small transform per step, so that no regex runs twice on the same tag.
    attributes = F.transform(
        F.filter(tags, lambda t: t.rlike("(?i)href")),
        lambda t: F.filter(
            F.arrays_zip(
                F.regexp_extract_all(t, F.lit(ATTRIBUTE_PATTERN), F.lit(1)).alias("name"),
                F.regexp_extract_all(t, F.lit(ATTRIBUTE_PATTERN), F.lit(2)).alias("value"),
            ),
            lambda p: F.lower(p["name"]) == "href",
        ),
    )
    raw = F.transform(attributes, lambda hits: F.get(hits, F.size(hits) - 1)["value"])
    bare = F.transform(raw, lambda v: F.regexp_replace(v, r"""(?s)^(["'])(.*)\1\z""", "$2"))
    hrefs = F.transform(F.filter(bare, lambda h: h != ""), unescape_entities)
    return F.filter(hrefs, lambda h: ~(h.startswith("#") | h.startswith("javascript:")))


def mailto_links(hrefs: Column) -> Column:
    kept = F.filter(hrefs, lambda h: h.startswith("mailto:"))
    return F.transform(kept, lambda h: F.substring_index(F.substr(h, F.lit(8)), "?", 1))


def tel_links(hrefs: Column) -> Column:
    return F.transform(F.filter(hrefs, lambda h: h.startswith("tel:")), lambda h: F.substr(h, F.lit(5)))


def page_links(hrefs: Column) -> Column:
    return F.filter(hrefs, lambda h: ~(h.startswith("mailto:") | h.startswith("tel:")))


def page_emails(html: Column, mailtos: Column, ascii_words: bool = False) -> Column:
    """Distinct addresses of the markup and the mail links, sorted, case kept.

    Here and below, ``ascii_words`` lets a word end at a letter beyond ASCII, as SQL engines do.
    """
    return sorted_distinct(F.concat(find_emails(html, ASCII_EMAIL_PATTERN if ascii_words else EMAIL_PATTERN), mailtos))


def _page_phone_matches(html: Column, ascii_words: bool) -> Column:
    return find_all(html, ASCII_PAGE_PHONE_PATTERN if ascii_words else PAGE_PHONE_PATTERN)


def clean_phone(value: Column, ascii_words: bool = False) -> Column:
    cleaned = clean_text(value)
    return F.when(F.length(F.regexp_replace(cleaned, "[^0-9]" if ascii_words else r"(?U)\D", "")) >= 8, cleaned)


def page_phones(html: Column, tels: Column, ascii_words: bool = False) -> Column:
    """Distinct phone-like strings of at least eight digits, sorted."""
    cleaned = F.transform(F.concat(_page_phone_matches(html, ascii_words), tels), lambda p: clean_phone(p, ascii_words))
    return sorted_distinct(F.filter(cleaned, lambda p: p.isNotNull()))


def raw_page_phones(html: Column, ascii_words: bool = False) -> Column:
    """Starter form: the matches as written, sorted."""
    return sorted_distinct(_page_phone_matches(html, ascii_words))


def page_addresses(html: Column, ascii_words: bool = False) -> Column:
    found = find_all(html, ASCII_ADDRESS_PATTERN if ascii_words else ADDRESS_PATTERN)
    return sorted_distinct(F.transform(found, lambda a: strip_chars(a, " ,.")))


def classify_page_type(url: Column, title: Column) -> Column:
    seen = F.lower(F.concat_ws(" ", url, F.coalesce(title, F.lit(""))))
    return F.coalesce(first_matching(seen, PAGE_TYPE_HINTS), F.lit("generic"))


def important_page_links(links: Column) -> Column:
    """Map from page type to its first five links; a link may serve several types."""

    def first_five(words: tuple[str, ...]) -> Column:
        return F.slice(F.filter(links, lambda v: contains_any(F.lower(v), words)), 1, 5)

    entries = [c for page_type, words in PAGE_TYPE_HINTS.items() for c in (F.lit(page_type), first_five(words))]
    return F.map_filter(F.create_map(*entries), lambda _, v: F.size(v) > 0)


def important_page_candidates(grouped: Column) -> Column:
    """The grouped links as one list, best page type first, at most ten."""

    def typed(page_type: str) -> Column:
        links = F.coalesce(grouped[page_type], empty_strings())
        return F.transform(links, lambda v: F.struct(v.alias("url"), F.lit(page_type).alias("page_type")))

    by_rank = sorted(PAGE_TYPE_HINTS, key=lambda t: -PAGE_TYPE_PRIORITY[t])
    return F.slice(F.concat(*[typed(t) for t in by_rank]), 1, 10)


def extract_social_links(links: Column) -> Column:
    hits = F.filter(links, lambda v: contains_any(F.lower(v), PAGE_SOCIAL_DOMAINS))
    return sorted_distinct(F.transform(hits, lambda v: ends_stripped(F.substring_index(v, "?", 1), "/")))


def title_case(value: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower the rest."""
    runs = F.regexp_extract_all(value, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(cased, "")


def find_best_company_name(title: Column, jsonld_name: Column, domain: Column) -> Column:
    label = F.translate(F.substring_index(domain, ".", 1), "-_", "  ")
    return (
        F.when(jsonld_name != "", jsonld_name)
        .when(title.contains("|"), clean_text(F.substring_index(title, "|", 1)))
        .when(title.contains("-"), clean_text(F.substring_index(title, "-", 1)))
        .when(title != "", title)
        .otherwise(clean_text(title_case(label)))
    )


_NODE_SCHEMA = (
    "`@type` string, legalName string, name string, url string, email string, telephone string, "
    "address string, industry string, description string, sameAs string"
)
_ADDRESS_PARTS = ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")


def json_ld_nodes(html: Column) -> Column:
    """Raw JSON text of every top-level node of every structured-data script."""
    scripts = F.regexp_extract_all(html, F.lit(JSON_LD_PATTERN), F.lit(1))

    def nodes_of(script: Column) -> Column:
        text = F.trim(F.regexp_replace(script, r"^\s+|\s+$", ""))
        listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
        return F.coalesce(F.from_json(listed, "array<string>", {"allowSingleQuotes": "false"}), empty_strings())

    return F.flatten(F.transform(scripts, nodes_of))


def json_ld_company_text(html: Column) -> Column:
    """Raw text of the first company node, null if the page has none."""
    nodes = F.filter(json_ld_nodes(html), lambda n: F.get_json_object(n, "$['@type']").isin(*COMPANY_NODE_TYPES))
    return F.get(nodes, F.lit(0))


def overlaid(node: Column, given: Column) -> Column:
    """JSON text of the object ``node`` with the keys of the object ``given`` put over its own; a null node adds nothing.

    Values stay variants, so numbers, nested objects and nulls come out as they
    went in.  Of a key that a node repeats, the last value counts.
    """

    def merged(entries: Column, own: Column) -> Column:
        names = F.transform(entries, lambda e: e["key"])
        later = lambda e, i: F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"])
        last = F.when(F.size(F.array_distinct(names)) == F.size(names), entries).otherwise(F.filter(entries, lambda e, i: ~later(e, i)))
        kept = F.filter(last, lambda e: ~F.array_contains(F.map_keys(own), e["key"]))
        return F.to_json(F.map_from_entries(F.concat(kept, F.map_entries(own))))

    kind = "map<string,variant>"
    of_node = F.coalesce(F.from_json(node, kind), F.from_json(F.lit("{}"), kind))
    return let(F.map_entries(of_node), lambda e: let(F.from_json(given, kind), lambda own: merged(e, own)))


def company_from_node(node: Column) -> Column:
    """Company fields of one structured-data node; null fields for a null node."""
    n = F.from_json(node, _NODE_SCHEMA)
    address = n["address"]
    is_object = address.startswith("{")
    part = {p: F.when(is_object, F.get_json_object(address, f"$.{p}")) for p in _ADDRESS_PARTS}
    joined = F.concat_ws(", ", *[F.nullif(part[p], F.lit("")) for p in _ADDRESS_PARTS])
    # Only strings count, alone or in a list: variants keep the kind that a plain string column loses.
    same_as = F.try_variant_get(F.try_parse_json(node), "$.sameAs", "variant")
    given = F.coalesce(F.from_json(F.to_json(same_as), "array<variant>"), F.array(same_as))
    strings = F.filter(given, lambda s: F.schema_of_variant(s) == "STRING")
    socials = F.transform(strings, lambda s: F.try_variant_get(s, "$", "string"))
    return F.struct(
        clean_text(first_nonempty(n["legalName"], n["name"])).alias("company_name"),
        clean_text(n["url"]).alias("website"),
        clean_text(n["email"]).alias("email"),
        clean_text(n["telephone"]).alias("phone"),
        clean_text(F.when(is_object, joined).otherwise(address)).alias("address"),
        clean_text(part["addressLocality"]).alias("city"),
        clean_text(part["addressRegion"]).alias("state_region"),
        clean_text(part["addressCountry"]).alias("country"),
        clean_text(part["postalCode"]).alias("postal_code"),
        clean_text(n["industry"]).alias("industry"),
        clean_text(n["description"]).alias("description"),
        F.coalesce(F.filter(socials, lambda s: s.isNotNull()), empty_strings()).alias("social_links"),
    )
