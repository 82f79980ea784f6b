"""URL normalisation, hashing, classification and reference resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from firmloom.functions.constants import (
    DIRECTORY_DOMAINS,
    NETLOC_SCHEMES,
    PROFILE_PAGE_HINTS,
    RELATIVE_SCHEMES,
    TRACKING_PARAMS,
)
from firmloom.functions.text import contains_any, ends_stripped, let

_CONTROLS = "".join(map(chr, range(0x21)))
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"
_FRAGMENT = r"^[^#]*#(.*)"


def tidy_url(url: Column) -> Column:
    """Drop surrounding blanks and control characters, and line breaks inside."""
    bare = F.rtrim(F.ltrim(url, F.lit(_CONTROLS + _BLANKS)), F.lit(_BLANKS))
    return F.translate(bare, "\t\r\n", "")


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def url_authority(url: Column) -> Column:
    return F.regexp_extract(url, _AUTHORITY, 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, _QUERY, 1)


def url_fragment(url: Column) -> Column:
    return F.regexp_extract(url, "(?s)" + _FRAGMENT, 1)


def form_decode(value: Column) -> Column:
    """Form decoding that leaves broken ``%`` escapes as they are."""
    return F.url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))


def form_encode(value: Column) -> Column:
    """Form encoding with the RFC 3986 unreserved set (``~`` plain, ``*`` escaped)."""
    encoded = F.url_encode(value)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query_pairs(query: Column, keep_blank: bool) -> Column:
    fields = F.filter(F.split(query, "&"), lambda f: f != "")
    if not keep_blank:
        fields = F.filter(fields, lambda f: f.contains("=") & ~f.rlike("^[^=]*=$"))
    return F.transform(
        fields,
        lambda f: F.struct(
            form_decode(F.substring_index(f, "=", 1)).alias("k"),
            form_decode(F.when(f.contains("="), F.regexp_extract(f, "(?s)^[^=]*=(.*)", 1)).otherwise("")).alias("v"),
        ),
    )


def _join_pairs(pairs: Column) -> Column:
    encoded = F.transform(pairs, lambda p: F.concat(form_encode(p["k"]), F.lit("="), form_encode(p["v"])))
    return F.array_join(encoded, "&")


def build_url(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column | None = None) -> Column:
    """Put components back together; empty components leave no delimiter."""
    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    slashes = path.startswith("//") | (scheme.isin(*NETLOC_SCHEMES) & ((path == "") | path.startswith("/")))
    body = (
        F.when(authority != "", F.concat(F.lit("//"), authority, rooted))
        .when(slashes, F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    out = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        body,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    if fragment is not None:
        out = F.concat(out, F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))
    return out


def canonicalize_url(url: Column, tracking: Sequence[str] = TRACKING_PARAMS) -> Column:
    """One spelling per page: lower scheme and host, sorted query, no tracking, no fragment."""
    dropped = F.array(*[F.lit(p) for p in tracking])

    def parts(tidy: Column) -> Column:
        path = url_path(tidy)
        pairs = F.filter(
            _query_pairs(url_query(tidy), keep_blank=False),
            lambda p: ~F.array_contains(dropped, F.lower(p["k"])),
        )
        return F.struct(
            F.coalesce(F.nullif(url_scheme(tidy), F.lit("")), F.lit("https")).alias("scheme"),
            F.lower(url_authority(tidy)).alias("authority"),
            F.when(path.isin("", "/"), F.lit("/")).otherwise(ends_stripped(path, "/")).alias("path"),
            _join_pairs(F.array_sort(pairs)).alias("query"),
        )

    # Each step reads the one before by name, so no regex runs twice on a URL.
    return let(let(tidy_url(url), parts), lambda p: build_url(p["scheme"], p["authority"], p["path"], p["query"]))


def rooted_canonical(canonical: Column) -> Column:
    """Canonical form of an already canonical URL: only an empty path still changes, to ``/``."""
    return F.regexp_replace(canonical, r"^([^:/?#]+://[^/?#]*)(\?|\z)", "$1/$2")


def hash_canonical(canonical: Column) -> Column:
    return F.sha2(rooted_canonical(canonical), 256)


def hash_url(url: Column, tracking: Sequence[str] = TRACKING_PARAMS) -> Column:
    """Hex sha-256 of the canonical URL, the key of the frontier."""
    return hash_canonical(canonicalize_url(url, tracking))


def extract_host(url: Column) -> Column:
    """Lower-case authority, with port and user info kept."""
    return F.lower(url_authority(url))


def guess_etld1(host: Column) -> Column:
    """Last two labels of a host; no public-suffix list."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    return F.when(F.size(labels) < 2, host).otherwise(F.array_join(F.slice(labels, -2, 2), "."))


def normalize_result_url(url: Column) -> Column:
    """Search-result URL without fragment; blanks and order of the query are kept."""

    def parts(tidy: Column) -> Column:
        authority = url_authority(tidy)
        on_youtube, on_ford = authority.contains("youtube.com"), authority.contains("ford.com")
        pairs = F.filter(
            _query_pairs(url_query(tidy), keep_blank=True),
            lambda p: ~((on_youtube & (p["k"] == "t")) | (on_ford & (p["k"] == "srsltid"))),
        )
        return F.struct(
            url_scheme(tidy).alias("scheme"), authority.alias("authority"), url_path(tidy).alias("path"),
            _join_pairs(pairs).alias("query"),
        )

    tidy = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    return let(let(tidy, parts), lambda p: build_url(p["scheme"], p["authority"], p["path"], p["query"]))


def extract_unique_urls(hrefs: Column, blocked_prefixes: Sequence[str]) -> Column:
    """Non-empty, unblocked, normalised links, first of each kept in order."""

    def admissible(href: Column) -> Column:
        keep = href != ""
        for prefix in blocked_prefixes:
            keep = keep & ~href.startswith(prefix)
        return keep

    return F.array_distinct(F.transform(F.filter(hrefs, admissible), normalize_result_url))


def classify_domain(domain: Column) -> Column:
    return F.when(contains_any(F.lower(domain), DIRECTORY_DOMAINS), "aggregator_or_directory").otherwise(
        "likely_official"
    )


def is_likely_official_url(url: Column) -> Column:
    return ~contains_any(F.lower(url_authority(url)), DIRECTORY_DOMAINS)


def prioritize_urls(urls: Column) -> Column:
    """Likely official URLs first, input order otherwise kept."""
    keyed = F.transform(
        urls, lambda u, i: F.struct((~is_likely_official_url(u)).alias("late"), i.alias("pos"), u.alias("url"))
    )
    return F.transform(F.array_sort(keyed), lambda s: s["url"])


def first_matching(value: Column, hints: dict[str, Sequence[str]]) -> Column:
    """Name of the first rule one of whose words occurs in ``value``; null if none."""
    chain = None
    for name, words in hints.items():
        test = contains_any(value, words)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def classify_important_page(url: Column) -> Column:
    return first_matching(F.lower(url), PROFILE_PAGE_HINTS)


def root_hint(domain: Column) -> Column:
    return F.substring_index(domain, ".", -2)


def brand_domain_mapping(domain: Column, company_name: Column) -> Column:
    return F.struct(
        company_name.alias("company_name"),
        domain.alias("domain"),
        root_hint(domain).alias("root_hint"),
    )


def _without_dots(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` segments."""
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.array_append(acc, seg)),
    )
    ends_open = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_open, F.array_append(folded, F.lit(""))).otherwise(folded)


def _merge_paths(base_directory: Column, path: Column) -> Column:
    # Only inner empty segments of a merged path vanish; the first stays, and so does the last.
    return F.when(path.startswith("/"), path).otherwise(F.regexp_replace(F.concat(base_directory, path), "/{2,}", "/"))


def resolve_links(
    hrefs: Column, base_scheme: Column, base_authority: Column, base_path: Column, base_query: Column
) -> Column:
    """Absolute form of every ``href`` against the components of a base URL.

    The base comes in parts so that a page splits its own URL once, not once
    per link.  Links are taken apart, merged and put together in separate
    transforms, so that each piece is computed once; the common ``/path`` form
    skips all that.
    """
    directory = F.regexp_replace(base_path, "[^/]*$", "")
    directory = F.when(directory.startswith("/"), directory).otherwise(F.concat(F.lit("/"), directory))
    origin = F.concat(base_scheme, F.lit("://"), base_authority)
    plain = r"^/(?![/?#])(?:[^?#\x00-\x20.]|(?<!/)\.)*+(?:\?[^#\x00-\x20]++)?+(?:#[^\x00-\x20]++)?+\z"

    def split(href: Column) -> Column:
        ref = F.translate(F.regexp_replace(href, r"^[\x00-\x20]+", ""), "\t\r\n", "")
        own = url_scheme(ref)
        return F.struct(
            href.alias("href"),
            F.when(own == "", base_scheme).otherwise(own).alias("scheme"),
            url_authority(ref).alias("authority"),
            url_path(ref).alias("path"),
            url_query(ref).alias("query"),
            url_fragment(ref).alias("fragment"),
        )

    def merge(p: Column) -> Column:
        own = p["authority"] != ""
        merged = F.when(own | (p["path"] == ""), p["path"]).otherwise(_merge_paths(directory, p["path"]))
        return F.struct(*[p[n].alias(n) for n in ("href", "scheme", "authority", "query", "fragment", "path")], merged.alias("merged"))

    def tidy(p: Column) -> Column:
        dotted = (p["authority"] == "") & p["merged"].rlike(r"(^|/)\.{1,2}(/|$)")
        path = F.when(dotted, F.array_join(_without_dots(F.split(p["merged"], "/")), "/")).otherwise(p["merged"])
        return F.struct(*[p[n].alias(n) for n in ("href", "scheme", "authority", "query", "fragment", "path")], path.alias("merged"))

    def join(p: Column) -> Column:
        own, bare = p["authority"] != "", p["path"] == ""
        path = (
            F.when(own, p["path"])
            .when(bare, base_path)
            .when(p["merged"] == "", "/")
            .otherwise(p["merged"])
        )
        query = F.when(~own & bare & (p["query"] == ""), base_query).otherwise(p["query"])
        foreign = (p["scheme"] != base_scheme) | ~p["scheme"].isin("", *RELATIVE_SCHEMES)
        authority = F.when(own, p["authority"]).otherwise(base_authority)
        whole = let(
            F.struct(authority.alias("a"), path.alias("p"), query.alias("q")),
            lambda t: build_url(p["scheme"], t["a"], t["p"], t["q"], p["fragment"]),
        )
        return F.when(foreign, p["href"]).otherwise(whole)

    def general(href: Column) -> Column:
        return let(let(let(let(href, split), merge), tidy), join)

    simple_base = (base_authority != "") & base_scheme.isin("http", "https")
    return F.transform(hrefs, lambda h: F.when(simple_base & h.rlike(plain), F.concat(origin, h)).otherwise(general(h)))


def join_url(base: Column, href: Column) -> Column:
    """``resolve_links`` for a single pair of columns."""
    joined = resolve_links(F.array(href), url_scheme(base), url_authority(base), url_path(base), url_query(base))
    return F.when(href == "", base).when(base == "", href).otherwise(F.get(joined, F.lit(0)))
