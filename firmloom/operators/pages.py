"""From stored pages to observations, discovered links and page metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmloom.functions import html as H
from firmloom.functions.text import clean_text, empty_strings, first_nonempty, first_of, nonempty, sorted_distinct
from firmloom.functions.urls import resolve_links, url_authority, url_path, url_query, url_scheme

OBSERVATION_FIELDS = (
    "company_name", "website", "email", "phone", "address", "city", "state_region", "country", "postal_code",
    "industry", "description", "social_links", "raw_fields", "confidence", "extractor_version", "page_type",
)
METADATA_FIELDS = (
    "title", "meta_description", "emails", "phones", "addresses", "page_type", "important_page_links",
    "important_page_candidates", "link_count",
)


def page_signals(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``title``, ``meta_description``, ``hrefs``, ``links``, ``mailtos``, ``tels`` and ``jsonld_raw``.

    The steps are separate projections: each array is computed once and then
    read by the columns built on it.
    """
    base = F.col(url)
    read = pages.withColumns(
        {
            "title": H.page_title(F.col(html)),
            "meta_description": H.meta_description(F.col(html)),
            "hrefs": H.anchor_hrefs(F.col(html)),
            "jsonld_raw": H.json_ld_company_text(F.col(html)),
            "_scheme": url_scheme(base),
            "_authority": url_authority(base),
            "_path": url_path(base),
            "_query": url_query(base),
        }
    )
    parts = [F.col(c) for c in ("_scheme", "_authority", "_path", "_query")]
    split = read.withColumns(
        {
            "links": resolve_links(H.page_links(F.col("hrefs")), *parts),
            "mailtos": H.mailto_links(F.col("hrefs")),
            "tels": H.tel_links(F.col("hrefs")),
        }
    )
    return split.drop("_scheme", "_path", "_query").withColumnRenamed("_authority", "authority")


def parse_pages(
    pages: DataFrame, url: str = "url", html: str = "html", max_links: int | None = 50, variant: str = "staged",
    max_emails: int | None = 10, max_phones: int | None = 10, max_addresses: int | None = 5,
    ascii_words: bool = False,
) -> DataFrame:
    """One row per page: observation columns, metadata columns, ``discovered_links``.

    The limits may be None, which keeps everything.  One narrow stage; ``html`` does not leave it.  ``variant="starter"`` gives
    the simpler rules: the title is the name, structured data is not back-filled,
    no addresses, page types or social links are read off the page.  E-mails, phones and
    addresses end at the edge of a word of any script; ``ascii_words`` takes SQL engines' ASCII words.
    """
    signals = page_signals(pages, url, html)
    starter = variant == "starter"
    text = F.col(html)
    found = signals.withColumns(
        {
            "emails": H.page_emails(text, empty_strings() if starter else F.col("mailtos"), ascii_words),
            "phones": H.raw_page_phones(text, ascii_words) if starter else H.page_phones(text, F.col("tels"), ascii_words),
            "addresses": empty_strings() if starter else H.page_addresses(text, ascii_words),
            "page_type": F.lit(None).cast("string") if starter else H.classify_page_type(F.col(url), F.col("title")),
            "important_page_links": H.important_page_links(empty_strings() if starter else F.col("links")),
            "page_socials": empty_strings() if starter else H.extract_social_links(F.col("links")),
            "ld": H.company_from_node(F.col("jsonld_raw")),
            "link_count": F.size("links"),
            "discovered_links": first_of(F.col("links"), max_links),
        }
    ).drop(html, "hrefs", "links", "mailtos", "tels")
    observed = _starter_observation(found, url) if starter else _staged_observation(found, url)
    out = observed.withColumns(
        {
            "important_page_candidates": H.important_page_candidates(F.col("important_page_links")),
            "emails": first_of(F.col("emails"), max_emails),
            "phones": first_of(F.col("phones"), max_phones),
            "addresses": first_of(F.col("addresses"), max_addresses),
        }
    ).withColumn("raw_fields", _raw_fields(starter))
    kept = [c for c in pages.columns if c != html]
    names = dict.fromkeys([*kept, *OBSERVATION_FIELDS, *METADATA_FIELDS, "jsonld_raw", "discovered_links"])
    return out.select(*names)


def _first(values: str):
    return F.get(F.col(values), F.lit(0))


def _raw_fields(starter: bool) -> Column:
    """What the observation was read from, as JSON: the structured node, and what the page itself says."""
    node = F.col("jsonld_raw")
    said = [F.col("title"), F.col("meta_description").alias("description"), F.col("emails"), F.col("phones")]
    if starter:
        return F.coalesce(node, F.to_json(F.struct(*said), {"ignoreNullFields": "false"}))
    more = ("addresses", "important_page_links", "important_page_candidates", "page_type")
    return H.overlaid(node, F.to_json(F.struct(*said, *more), {"ignoreNullFields": "false"}))


def _staged_observation(found: DataFrame, url: str) -> DataFrame:
    has_node = F.col("jsonld_raw").isNotNull()
    reachable = (F.size("emails") > 0) | (F.size("phones") > 0)
    evident = F.col("page_type").isin("about", "contact") & (reachable | (F.size("addresses") > 0))
    guessed = F.when(evident, 0.68).when(F.col("title").isNotNull() | reachable, 0.50).otherwise(0.15)
    socials = F.when(has_node, sorted_distinct(F.concat("ld.social_links", "page_socials"))).otherwise(F.col("page_socials"))
    return found.withColumns(
        {
            "company_name": H.find_best_company_name(F.col("title"), F.col("ld.company_name"), F.col("authority")),
            "website": first_nonempty(F.col("ld.website"), F.col(url)),
            "email": F.coalesce("ld.email", _first("emails")),
            "phone": F.coalesce("ld.phone", _first("phones")),
            "address": F.coalesce("ld.address", _first("addresses")),
            **{c: F.col(f"ld.{c}") for c in ("city", "state_region", "country", "postal_code", "industry")},
            "description": F.when(has_node, F.col("ld.description")).otherwise(F.col("meta_description")),
            "social_links": socials,
            "confidence": F.when(has_node, 0.92).otherwise(guessed),
            "extractor_version": F.when(has_node, "jsonld-v1").otherwise("heuristic-v1"),
        }
    )


def _starter_observation(found: DataFrame, url: str) -> DataFrame:
    has_node = F.col("jsonld_raw").isNotNull()
    guessed = {
        "company_name": F.col("title"),
        "website": F.col(url),
        "email": _first("emails"),
        "phone": clean_text(_first("phones")),
        "description": F.col("meta_description"),
    }
    names = (
        "company_name", "website", "email", "phone", "address", "city", "state_region", "country", "postal_code",
        "industry", "description",
    )
    none = F.lit(None).cast("string")
    columns = {n: F.when(has_node, F.col(f"ld.{n}")).otherwise(guessed.get(n, none)) for n in names}
    columns["social_links"] = F.when(has_node, F.col("ld.social_links")).otherwise(empty_strings())
    columns["confidence"] = F.when(has_node, 0.9).when(F.col("title").isNotNull(), 0.45).otherwise(0.2)
    columns["extractor_version"] = F.when(has_node, "starter-jsonld-v1").otherwise("starter-heuristic-v1")
    return found.withColumns(columns)


def admitted(parsed: DataFrame, variant: str = "staged") -> DataFrame:
    """Pages worth an observation: all, or for the starter those with a name, e-mail or phone."""
    if variant == "starter":
        return parsed.where(nonempty(F.col("company_name")) | nonempty(F.col("email")) | nonempty(F.col("phone")))
    return parsed
