"""Main text of web pages by differencing with the nearest page of the same host.

Every page is cut into lines of text, one per block element.  Within a host the
pages are ordered by URL path, and each is paired with the nearer of its two
neighbours.  The lines of both are aligned by longest common subsequence, and a
line that both share is template text and goes, be it inside or outside an
article or main element.  Lines of elements that say themselves what they are
(menus, footers, forms, adverts ...) go in any case.  Only where no page of the
host differs, a main element that holds most of the text stands in for the
alignment.

Only hashes of lines travel between pages, not the pages.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmloom.llm.common import hinted, same, stored, table, text_key
from firmloom.llm.url_filter import host_of, path_of
from firmloom.session import map_frames
from firmloom.skew import lookup_join, previous_value

# Element names by what they hold.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "noembed", "noframes", "xmp"}
FURNITURE = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "object", "canvas", "audio", "video", "label", "fieldset"}
CONTENT = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Words in class, id, role or aria-label that mark furniture.
MARKED = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed|s)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|alert|side-?bar|menu|nav|navbar|navigation"
    r"|bread-?crumbs?|footer|masthead|site-?header|share|sharing|social|related|recommended|comments?|disqus|respond|newsletter|subscribe|sign-?up|login|search|popup|modal|widget|pagination"
    r"|complementary|contentinfo)(?:$|[^a-z])"
)
#: Elements that an end tag doesn't reach beyond, but for those of a table's parts.
SCOPE = ("table", "td", "th", "caption", "object")
#: Blocks that an inline element's end tag doesn't reach beyond.
HOLDERS = (*SCOPE, "div", "section", "article", "main", "aside", "nav", "header", "footer", "form", "blockquote", "figure", "ul", "ol", "dl", "body")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
TABLE_PARTS = ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption")
#: What a start tag ends where end tags are left out, and the elements it doesn't reach beyond.
ENDS = dict.fromkeys(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup hr main menu nav ol p pre search section summary table ul".split() + [*HEADINGS],
    (("p",), SCOPE),
) | {
    "li": (("p", "li"), ("ul", "ol", "menu", "dir", *SCOPE)),
    "dd": (("p", "dd", "dt"), ("dl", *SCOPE)),
    "dt": (("p", "dd", "dt"), ("dl", *SCOPE)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tr": (("td", "th", "tr", "caption"), ("table",)),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("td", "th", "tr", "caption", "thead", "tbody", "tfoot"), ("table",))),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select", "datalist")),
}
#: Elements, besides raw ones, that may stand in a head whose end tag is left out.
IN_HEAD = {"head", "base", "link", "meta"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
ROLE_MAIN = re.compile(r"role\s*=\s*[\"']?main\b", re.IGNORECASE)
#: Pages that share more of their text than this are copies of one page and say nothing about its template.
COPY_SHARE = 0.9


@dataclass
class Line:
    text: str
    furniture: bool
    main: bool


def lines_of(page: str | None) -> list[Line]:
    """Lines of text in page order, with white space made single and character references decoded."""
    page = page or ""
    out: list[Line] = []
    held: list[str] = []
    opened: list[tuple[str, bool]] = []  # open elements and whether each is a main element; inline ones only where they begin a skip or stand in one
    places: dict[str, list[int]] = {}  # places of each name in it
    skip = -1  # place of the element that is being left out
    mains = at = 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append(Line(text, skip >= 0, mains > 0))

    def last(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def cut(place: int) -> None:
        nonlocal skip, mains
        if place <= skip:
            flush()
            skip = -1
        while len(opened) > place:
            name, holds = opened.pop()
            places[name].pop()
            mains -= holds

    def end(names: tuple[str, ...], barriers: tuple[str, ...]) -> None:
        """End the open elements of these names, and all inside them, that stand above the last barrier."""
        bound = last(barriers)
        while (place := last(names)) > bound:
            cut(place)

    def end_one(name: str) -> None:
        """An end tag: the last open element of the name, or of any heading."""
        names = HEADINGS if name in HEADINGS else (name,)
        if name in INLINE:
            barriers = HOLDERS
        elif name in TABLE_PARTS:
            barriers = () if name == "table" else ("table",)
        else:
            barriers = () if name in ("body", "html") else (*SCOPE, "ul", "ol", "menu", "dir") if name == "li" else (*SCOPE, "dl") if name in ("dd", "dt") else SCOPE
        place = last(names)
        if place > last(tuple(b for b in barriers if b != name)):
            cut(place)

    while True:
        m = TOKEN.search(page, at)
        held.append(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in RAW and not m["close"]:
            if not m["rest"].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
            continue
        if name not in INLINE:
            flush()
        if m["close"]:
            if places.get(name) or name in HEADINGS:
                end_one(name)
            continue
        if places.get("head") and name not in IN_HEAD:
            end(("head",), ())
        if name in ENDS:
            end(*ENDS[name])
        if name in VOID:
            continue
        begins = holds = False
        if skip < 0:
            words = " ".join(next(filter(None, a), "") for a in ATTRIBUTE.findall(m["rest"])).lower() if m["rest"] else ""
            begins = name in FURNITURE or bool(words and name not in ("html", "body", *CONTENT) and MARKED.search(words))
            holds = not begins and (name == "main" or bool(words and ROLE_MAIN.search(m["rest"])))
        if begins:
            flush()
            skip = len(opened)
        if begins or holds or name not in INLINE or (skip >= 0 and name == opened[skip][0]):
            places.setdefault(name, []).append(len(opened))
            opened.append((name, holds))
            mains += holds
    flush()
    return out


def common_lines(left: list[int], right: list[int]) -> set[int]:
    """Places in ``left`` that a longest common subsequence with ``right`` takes.

    Row by row on whole-number bit vectors: a cleared bit is a step of the
    table.  Lines that only one side has are left out first.
    """
    both = set(left) & set(right)
    places = [i for i, x in enumerate(left) if x in both]
    other = [x for x in right if x in both]
    if not both:
        return set()
    masks: dict[int, int] = {}
    for j, x in enumerate(other):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    row, rows = full, []
    for i in places:
        hit = row & masks[left[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    taken, i, j = set(), len(places), len(other)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if i and not rows[i - 1] >> (j - 1) & 1:
                continue
            taken.add(places[i])
            j -= 1
    return taken


def nearness(path: str, other: str) -> tuple[int, int]:
    """Leading path segments that two URLs share, then leading characters."""
    a, b = path.split("/"), other.split("/")
    segments = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    characters = next((i for i, (x, y) in enumerate(zip(path, other, strict=False)) if x != y), min(len(path), len(other)))
    return segments, characters


def template_lines(own: list[int], sizes: list[int], path: str, neighbours: list[tuple[str, list[int], int]]) -> list[int] | None:
    """Places of the lines that the nearest neighbour which isn't a copy shares; None if there is no such neighbour.

    Neighbours are (path, lines, characters).  Copies share more than
    COPY_SHARE of the longer of both pages.
    """
    whole = sum(sizes)
    for _, lines, size in sorted(neighbours, key=lambda n: nearness(path, n[0]), reverse=True):
        shared = common_lines(own, lines)
        if sum(sizes[i] for i in shared) <= COPY_SHARE * max(whole, size):
            return sorted(shared)
    return None


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def page_lines(page: str | None) -> list[Line]:
    """The lines that aren't furniture."""
    return [x for x in lines_of(page) if not x.furniture]


def shared_lines(pages: DataFrame) -> DataFrame:
    """id, _key and template (places, among a page's lines that aren't furniture, to delete) for the pages of (id, url, html) that have such lines.

    Pages of a host with equal lines are one page here: the neighbours of the
    group are the nearest pages that differ, and their template holds for all
    its members.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for host, page in zip(f["host"], f["html"], strict=True):
                lines = page_lines(page)
                hashes = [_hash(x.text) for x in lines]
                copy = hashlib.blake2b("\0".join([host, *map(str, hashes)]).encode(), digest_size=16).hexdigest()
                sizes = [len(x.text) for x in lines]
                most = 2 * sum(n for x, n in zip(lines, sizes, strict=True) if x.main) > sum(sizes)
                rows.append((copy, hashes, sizes, [i for i, x in enumerate(lines) if most and not x.main]))
            f = f[["id", "_key", "host", "path"]]
            yield f.assign(**{name: [r[i] for r in rows] for i, name in enumerate(("copy", "lines", "sizes", "outside"))})

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = []
            for own, sizes, path, before, after in zip(f["lines"], f["sizes"], f["path"], f["before"], f["after"], strict=True):
                near = [(n["path"], list(n["lines"]), n["size"]) for n in (before, after) if n is not None]
                found.append(template_lines(list(own), list(sizes), path, near))
            f = f[["copy"]].assign(shared=found)
            yield f[[t is None or bool(t) for t in found]]

    kind = pages.schema["id"].dataType.simpleString()
    keyed = pages.withColumns({"_key": page_key(), "host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    schema = f"id {kind}, _key long, host string, path string, copy string, lines array<long>, sizes array<int>, outside array<int>"
    read_rows = stored(map_frames(keyed.select("id", "_key", "host", "path", "html"), read, schema).where(F.size("lines") > 0))
    first = F.min_by(F.struct("host", "path", "lines", "sizes"), F.struct("path", "id", "_key"))
    groups = read_rows.groupBy("copy").agg(first.alias("page")).select("copy", "page.*")
    ordered = stored(groups).repartitionByRange("host", "path", "copy").sortWithinPartitions("host", "path", "copy")
    ranked = stored(ordered.withColumn("rank", F.monotonically_increasing_id())).withColumn("back", -F.col("rank"))
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    ranked = ranked.withColumn("page", F.struct("path", "lines", size.alias("size")))
    both = previous_value(previous_value(ranked, "host", "rank", "page", "before"), "host", "back", "page", "after")
    shared = stored(map_frames(both.select("copy", "path", "lines", "sizes", "before", "after"), align, "copy string, shared array<int>").withColumn("found", F.lit(True)))
    marks = read_rows.select("id", "_key", "copy", "outside")
    met = lookup_join(marks, shared, "copy", F.col("_key"))
    template = F.when(F.col("found") & F.col("shared").isNull(), F.col("outside")).otherwise(F.col("shared"))
    return stored(met.select("id", "_key", template.alias("template")).where(F.size("template") > 0).dropDuplicates(["id", "_key"]))


def page_key():
    return text_key(F.concat_ws("\u0000", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))


def main_text(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    A null or empty html, or one without text, gives an empty text.  A page
    whose host has no page that differs keeps all its lines that aren't
    furniture, or those of its main element if that holds most of the text.  URLs without a host are one host of their
    own.  Repeated rows give repeated rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = []
            for page, template in zip(f["html"], f["template"], strict=True):
                gone = set() if template is None else set(template)
                texts.append(" ".join(x.text for i, x in enumerate(page_lines(page)) if i not in gone))
            yield pd.DataFrame({"id": f["id"], "url": f["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(page_id).alias("id"), "url", "html")
    gone = hinted(shared_lines(rows), 200_000)
    keyed = rows.withColumn("_key", page_key())
    met = keyed.join(gone, same(keyed, gone, "id", "_key"), "left").select(keyed["id"], "url", "html", "template")
    kind = rows.schema["id"].dataType.simpleString()
    return map_frames(met, run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", page_id)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
