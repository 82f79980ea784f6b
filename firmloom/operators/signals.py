"""Richer page signals, and the business record built from them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firmloom.functions.contacts import (
    clean_social_profiles,
    extract_emails,
    extract_location_mentions,
    extract_phones,
    find_all,
)
from firmloom.functions.html import ATTRIBUTE_PATTERN, json_ld_nodes, unescape_entities, without_hidden_markup
from firmloom.functions.names import pick_best_description, pick_company_name, title_name_candidates
from firmloom.functions.text import clean_text, empty_strings, first_nonempty, unique_nonempty
from firmloom.functions.urls import brand_domain_mapping, classify_domain, join_url, url_authority
from firmloom.operators.pages import page_signals
from firmloom.session import map_batches

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK_TAGS = "p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|section|article|header|footer|nav|address|main|aside|form|title"
_COMPANY_TYPES = "(?i)organization|corporation|brand|localbusiness"
#: Pages whose blocks a Python worker hands back together.
SLICE_PAGES = 128


# --- built-in expressions ----------------------------------------------------
def tag_attributes(html: Column, tag: str) -> Column:
    """Per tag of that name, an array of (lower-case name, unquoted value) attribute pairs."""
    bodies = find_all(html, rf"(?is)<{tag}(?=[\s/>])((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)[^>]*>", 1)
    pairs = F.transform(
        bodies,
        lambda b: F.arrays_zip(
            F.regexp_extract_all(b, F.lit(ATTRIBUTE_PATTERN), F.lit(1)).alias("name"),
            F.regexp_extract_all(b, F.lit(ATTRIBUTE_PATTERN), F.lit(2)).alias("value"),
        ),
    )
    unquoted = r"""(?s)^(["'])(.*)\1\z"""
    return F.transform(
        pairs,
        lambda attrs: F.transform(
            attrs,
            lambda a: F.struct(
                F.lower(a["name"]).alias("name"), F.regexp_replace(a["value"], unquoted, "$2").alias("value")
            ),
        ),
    )


def attribute(attrs: Column, name: str) -> Column:
    """First value of that attribute, as written in the markup."""
    return F.get(F.filter(attrs, lambda a: a["name"] == name), F.lit(0))["value"]


def meta_tags(html: Column) -> Column:
    """(name, property, content) of every meta tag."""
    return F.transform(
        tag_attributes(html, "meta"),
        lambda m: F.struct(*[attribute(m, n).alias(n) for n in ("name", "property", "content")]),
    )


def meta_content(metas: Column, name: str) -> Column:
    """Content of the first meta tag with that name or property."""
    hits = F.filter(
        metas, lambda m: F.coalesce(m["name"] == name, F.lit(False)) | F.coalesce(m["property"] == name, F.lit(False))
    )
    return F.get(hits, F.lit(0))["content"]


def visible_text(html: Column) -> Column:
    """Text a reader sees: hidden markup gone, block tags as line breaks, other tags dropped."""
    body = F.regexp_replace(without_hidden_markup(html), r"(?is)<(head|noscript|template)(?=[\s/>]).*?</\1\s*>", " ")
    broken = F.regexp_replace(body, rf"(?i)</?(?:{_BLOCK_TAGS})(?=[\s/>])[^>]*>", "\n")
    return F.trim(unescape_entities(F.regexp_replace(broken, "<[^>]*>", "")))


def element_texts(html: Column, tag: str) -> Column:
    """Clean text of every element of that name."""
    inner = find_all(html, rf"(?is)<{tag}(?=[\s/>])[^>]*>(.*?)</{tag}\s*>", 1)
    return F.transform(inner, lambda t: clean_text(unescape_entities(F.regexp_replace(t, "<[^>]*>", ""))))


def _as_json_list(value: Column) -> Column:
    listed = F.when(value.startswith("["), value).otherwise(F.concat(F.lit("["), value, F.lit("]")))
    return F.coalesce(F.from_json(listed, "array<string>", {"allowSingleQuotes": "false"}), empty_strings())


def company_nodes(nodes: Column) -> Column:
    """The company-like ones among JSON nodes, with ``@graph`` lists opened however deep they lie.

    A level is opened as often as the nodes speak of a graph (or escape what
    could be one): no graph can lie deeper.  Nodes come level by level.
    """

    def opened(nodes: Column) -> Column:
        inner = F.flatten(F.transform(nodes, lambda n: _as_json_list(F.get_json_object(n, "$['@graph']"))))
        return F.filter(inner, lambda n: n.isNotNull())

    def step(seen: Column, _: Column) -> Column:
        level = F.when(F.size(seen["level"]) > 0, opened(seen["level"])).otherwise(empty_strings())
        return F.struct(level.alias("level"), F.concat(seen["every"], level).alias("every"))

    deepest = F.aggregate(nodes, F.lit(0), lambda n, node: n + F.coalesce(F.regexp_count(node, F.lit(r"graph|\\u")), F.lit(0)))
    turns = F.when(deepest > 0, F.sequence(F.lit(1), deepest)).otherwise(F.array().cast("array<int>"))
    start = F.struct(nodes.cast("array<string>").alias("level"), nodes.cast("array<string>").alias("every"))
    every = F.aggregate(turns, start, step, lambda seen: seen["every"])
    return F.filter(every, lambda n: F.coalesce(F.get_json_object(n, "$['@type']").rlike(_COMPANY_TYPES), F.lit(False)))


def node_values(nodes: Column, field: str) -> Column:
    """A field of every node and of its contact points, distinct."""
    own_and_contacts = F.transform(
        nodes,
        lambda n: F.concat(
            F.array(F.get_json_object(n, f"$.{field}")),
            F.transform(
                _as_json_list(F.get_json_object(n, "$.contactPoint")), lambda p: F.get_json_object(p, f"$.{field}")
            ),
        ),
    )
    return unique_nonempty(F.flatten(own_and_contacts))


def node_addresses(nodes: Column) -> Column:
    def text(node: Column) -> Column:
        address = F.get_json_object(node, "$.address")
        parts = [
            F.nullif(F.get_json_object(address, f"$.{p}"), F.lit(""))
            for p in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")
        ]
        return F.when(address.startswith("{"), F.concat_ws(", ", *parts)).otherwise(address)

    return unique_nonempty(F.transform(nodes, text))


# --- blocks chosen by class or id --------------------------------------------
class _BlockReader(HTMLParser):
    """Collects the text of contact-like blocks and of the brand in the page head."""

    def __init__(self) -> None:
        super().__init__()
        self.open: list[tuple[str, int | None, bool]] = []  # (tag, focused block, is brand)
        self.blocks: list[list[str]] = []
        self.brand: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        values = {k: (v or "") for k, v in reversed(attrs)}
        style, ident, prop = values.get("class", "").lower(), values.get("id", "").lower(), values.get("itemprop", "")
        focused = (
            tag in ("address", "footer") or "contact" in style or "contact" in ident or "footer" in style
            or prop in ("address", "telephone")
        )
        block = None
        if focused:
            block = len(self.blocks)
            self.blocks.append([])
        in_head = any(t in ("header", "nav") for t, _, _ in self.open)
        branded = "navbar-brand" in style.split() or (in_head and ("logo" in style or "brand" in style))
        if branded and self.brand is None:
            self.brand = []
        else:
            branded = False
        self.open.append((tag, block, branded))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        for _, block, branded in self.open:
            if block is not None:
                self.blocks[block].append(data)
            if branded:
                self.brand.append(data)


def _read_blocks(pages: pa.Array, max_blocks: int | None) -> tuple[list[list[str]], list[str | None]]:
    blocks, brands = [], []
    for html in pages:
        reader = _BlockReader()
        reader.feed(html.as_py() or "")
        texts = [" ".join("".join(b).split()) for b in reader.blocks]
        blocks.append([t for t in texts if t][:max_blocks])
        brands.append(" ".join("".join(reader.brand or []).split()) or None)
    return blocks, brands


def _with_blocks(batches: Iterator[pa.RecordBatch], html: str, max_blocks: int | None) -> Iterator[pa.RecordBatch]:
    """The columns of a batch go back as the buffers they came in; one page at a time becomes a string."""
    for batch in batches:
        names = [*batch.schema.names, "focused_text_blocks", "nav_brand"]
        for start in range(0, batch.num_rows, SLICE_PAGES):
            part = batch.slice(start, SLICE_PAGES)
            blocks, brands = _read_blocks(part.column(batch.schema.get_field_index(html)), max_blocks)
            read = [pa.array(blocks, pa.list_(pa.string())), pa.array(brands, pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns, *read], names)


def selected_blocks(pages: DataFrame, html: str = "html", max_blocks: int | None = 20) -> DataFrame:
    """Add focused_text_blocks (the first ``max_blocks``, or all) and nav_brand.

    They depend on the element tree, which regular expressions cannot follow;
    one Arrow pass over the markup reads both, without a join afterwards.
    """
    fields = ", ".join(f"`{n}` {t}" for n, t in pages.dtypes)
    run = partial(_with_blocks, html=html, max_blocks=max_blocks)
    return map_batches(pages, run, f"{fields}, focused_text_blocks array<string>, nav_brand string")


def rich_signals(
    pages: DataFrame, url: str = "url", html: str = "html", text_limit: int | None = None
) -> DataFrame:
    """Meta tags, structured data, headings, contact blocks and body text of every page.

    The whole body text is read; ``text_limit`` cuts it where a shorter sample
    is wanted.
    """
    read = page_signals(selected_blocks(pages, html), url, html)
    h = F.col(html)
    tagged = read.withColumns(
        {
            "_metas": F.transform(
                meta_tags(h),
                lambda m: F.struct(
                    m["name"].alias("name"), m["property"].alias("property"), unescape_entities(m["content"]).alias("content")
                ),
            ),
            "_canonical": F.get(
                F.filter(tag_attributes(h, "link"), lambda a: F.lower(attribute(a, "rel")) == "canonical"), F.lit(0)
            ),
            "_logo": F.get(
                F.filter(
                    tag_attributes(h, "img"),
                    lambda a: attribute(a, "alt").isNotNull()
                    & F.coalesce(
                        F.lower(F.concat_ws(" ", attribute(a, "src"), attribute(a, "alt"))).contains("logo"), F.lit(False)
                    ),
                ),
                F.lit(0),
            ),
            "_nodes": json_ld_nodes(h),
            "_footers": element_texts(h, "footer"),
            "_h1": F.get(element_texts(h, "h1"), F.lit(0)),
            "body_text": visible_text(h),
        }
    ).drop(html).withColumn("_nodes", company_nodes(F.col("_nodes")))
    metas, nodes = F.col("_metas"), F.col("_nodes")
    site_name = first_nonempty(*[meta_content(metas, n) for n in ("og:site_name", "application-name", "apple-mobile-web-app-title")])
    schema_name = F.get(
        F.filter(
            F.transform(
                nodes,
                lambda n: clean_text(first_nonempty(F.get_json_object(n, "$.legalName"), F.get_json_object(n, "$.name"))),
            ),
            lambda v: v.isNotNull(),
        ),
        F.lit(0),
    )
    footer = F.get(F.filter("_footers", lambda t: t.rlike("(?i)copyright|all rights reserved|©")), F.lit(0))
    href = unescape_entities(attribute(F.col("_canonical"), "href"))
    body = F.col("body_text") if text_limit is None else F.left("body_text", F.lit(text_limit))
    out = tagged.withColumns(
        {
            "description_candidates": F.array(*[meta_content(metas, n) for n in ("description", "og:description", "twitter:description")]),
            "keywords": meta_content(metas, "keywords"),
            "canonical_url": F.when(href != "", join_url(F.col(url), href)),
            "company_name_candidates": F.array(
                schema_name, clean_text(site_name), clean_text(unescape_entities(attribute(F.col("_logo"), "alt"))), F.col("nav_brand"), footer, F.col("_h1")
            ),
            "schema_addresses": node_addresses(nodes),
            "schema_telephones": node_values(nodes, "telephone"),
            "schema_emails": node_values(nodes, "email"),
            "social_links": F.filter("links", lambda v: v.rlike(r"(?i)linkedin|facebook|instagram|twitter|x\.com|youtube|tiktok")),
            "body_text": body,
        }
    )
    return out.drop("_metas", "_canonical", "_logo", "_nodes", "_footers", "_h1", "hrefs", "links", "jsonld_raw", "authority")


def business_metadata(
    domain: Column, company_name: Column, page_text: Column, social_links: Column, structured_locations: Column,
    direct_emails: Column, tel_links: Column, blocks: Column,
) -> Column:
    """The nested business struct of a result."""
    block_text = F.array_join(F.coalesce(blocks, empty_strings()), " ")
    return F.struct(
        company_name.alias("company_name"),
        extract_location_mentions(block_text, structured_locations).alias("headquarters_or_location_mentions"),
        extract_emails(page_text, direct_emails).alias("emails"),
        extract_phones(page_text, tel_links, blocks).alias("phones"),
        clean_social_profiles(F.coalesce(social_links, empty_strings())).alias("social_profiles"),
        brand_domain_mapping(domain, company_name).alias("brand_domain_mapping"),
        classify_domain(domain).alias("classification"),
    )


def result_items(signals: DataFrame, url: str = "url", final_url: str = "final_url", ok: Column | None = None) -> DataFrame:
    """Result structs from :func:`rich_signals`; rows that are not ``ok`` get the failed-page form.

    ``signals`` needs ``url`` and ``final_url`` next to the signal columns.
    """
    good = F.lit(True) if ok is None else F.coalesce(ok, F.lit(False))
    none, empty = F.lit(None).cast("string"), empty_strings()

    def if_good(value: Column, otherwise: Column) -> Column:
        return F.when(good, value).otherwise(otherwise)

    staged = signals.withColumns(
        {
            "_final": if_good(F.coalesce(F.col(final_url), F.col(url)), F.col(url)),
            "_name": if_good(
                pick_company_name(F.concat("company_name_candidates", title_name_candidates(F.col("title")))), none
            ),
            "_description": if_good(pick_best_description(F.col("description_candidates")), none),
        }
    ).withColumn("_domain", url_authority(F.col("_final")))
    business = business_metadata(
        F.col("_domain"), F.col("_name"),
        if_good(F.col("body_text"), F.lit("")),
        if_good(F.col("social_links"), empty),
        if_good(F.col("schema_addresses"), empty),
        if_good(F.concat("mailtos", "schema_emails"), empty),
        if_good(F.concat("tels", "schema_telephones"), empty),
        if_good(F.col("focused_text_blocks"), empty),
    )
    item = F.struct(
        F.col(url).alias("url"),
        F.trim(if_good(first_nonempty(F.col("title"), F.col(url)), F.col(url))).alias("title"),
        F.struct(
            F.col("_final").alias("final_url"),
            F.col("_domain").alias("domain"),
            F.col("_description").alias("description"),
            if_good(clean_text(F.col("keywords")), none).alias("keywords"),
            if_good(F.col("canonical_url"), none).alias("canonical_url"),
            business.alias("business"),
        ).alias("metadata"),
    )
    return staged.withColumn("item", item).drop("_final", "_name", "_description", "_domain")
