"""Page extraction on literal pages."""

import json
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from firmloom.functions import html as H
from firmloom.operators import pages as PG, signals as SG

LD = '<script type="application/ld+json">{}</script>'


def page(*nodes, title="Acme Foods - Home", body=""):
    scripts = "".join(LD.format(n if isinstance(n, str) else json.dumps(n)) for n in nodes)
    return f"<html><head><title>{title}</title>{scripts}</head><body>{body}</body></html>"


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(attrs).get("href")
            if href and not href.startswith(("#", "javascript:")):
                self.found.append(href)


def test_hrefs_agree_with_an_html_parser(evaluate):
    rnd = random.Random(3)
    parts = [
        '<a href="/a?x=1&amp;y=2">t</a>', "<A HREF='/b' class=c>t</A>", "<a class=x href=/c/d?e=f>t</a>", "<a href>t</a>",
        '<!-- <a href="/hidden"> -->', "<script>var a = '<a href=\"/no\">';</script>", "<style>a{}</style>", "<abbr href='/no'>x</abbr>",
        '<a data-href="/no" href="/yes">', '<a title="a > b" href="/gt">x</a>', '<a href="#top">x</a>', '<a href="javascript:x()">',
        '<a\n href = "/spaced" >', '<a href="mailto:a@b.c?subject=x">', '<a href="tel:+1 2">', '<a href="/&#233;&#x41;&lt;">', "plain < text",
        '<a href="/one" href="/two">', '<a href="">', "<p>é</p>", '<a href="https://x.com/&nbsp;">',
    ]
    texts = [("".join(rnd.choices(parts, k=12)),) for _ in range(60)]
    got = evaluate(texts, "v string", out=H.anchor_hrefs(F.col("v")))
    for (text,), hrefs in zip(texts, got):
        reader = Reader()
        reader.feed(text)
        assert hrefs == reader.found, text


def test_unclosed_markup_does_not_overflow(evaluate):
    long = "<a " + "x='1' " * 20000 + 'href="/end">' + "<!-- never closed <a href='/no'>" + "y" * 100000
    assert evaluate([(long,)], "v string", out=H.anchor_hrefs(F.col("v"))) == [["/end"]]


def test_signals(evaluate):
    text = (
        '<title> A\n B </title><meta name="description" content=" about  us ">12 Long Acre Road, Pune. call +91 22 1234 5678 or 1234-567 '
        "x@Y.com X@y.com"
    )
    v = F.col("v")
    none = F.array().cast("array<string>")
    got = evaluate(
        [(text,), ("",)], "v string", title=H.page_title(v), about=H.meta_description(v), mail=H.page_emails(v, F.array(F.lit("a@b.c"))),
        phone=H.page_phones(v, none), place=H.page_addresses(v),
    )
    assert got[0] == ("A B", "about us", ["X@y.com", "a@b.c", "x@Y.com"], ["+91 22 1234 5678"], ["12 Long Acre Road"])
    assert got[1] == (None, None, ["a@b.c"], [], [])


def test_names_and_types(evaluate):
    rows = [("https://h/About-Us", "x", "h"), ("https://h/x", "Reach /contact", "h"), ("https://h/", None, "my-o'neil_co.example.com")]
    got = evaluate(
        rows, "u string, t string, d string", kind=H.classify_page_type(F.col("u"), F.col("t")),
        name=H.find_best_company_name(F.col("t"), F.lit(None).cast("string"), F.col("d")),
    )
    assert got == [("about", "x"), ("contact", "Reach /contact"), ("generic", "My O'Neil Co")]


def test_structured_data(evaluate):
    org = {"@type": "Organization", "name": "Acme", "address": {"streetAddress": "1 Rd", "addressCountry": "IN"}, "sameAs": ["https://x.com/a", 3]}
    rows = [
        page(org), page([{"@type": "WebSite", "name": "no"}, org]), page("{broken", org), page({**org, "@type": ["Organization"]}),
        page({**org, "address": "2 Long Rd"}), page({**org, "sameAs": "https://x.com/one", "legalName": "Acme Ltd"}), page('["text", 1]', org),
    ]
    node = H.json_ld_company_text(F.col("v"))
    got = evaluate([(r,) for r in rows], "v string", c=H.company_from_node(node), missing=node.isNull())
    names = [(c["company_name"], c["address"], c["social_links"]) for c, _ in got]
    plain = ("Acme", "1 Rd, IN", ["https://x.com/a"])  # the number is no link
    assert names[:3] == [plain] * 3 and names[6] == plain
    assert got[3][1] is True and names[3] == (None, None, [])
    assert names[4][1] == "2 Long Rd" and names[5] == ("Acme Ltd", "1 Rd, IN", ["https://x.com/one"])


def test_parse_pages(spark):
    links = "".join(f'<a href="/about{i}">x</a>' for i in range(7)) + '<a href="/contact">c</a><a href="https://x.com/a?b=1">x</a>'
    body = f'<a href="mailto:a@b.c">m</a>{links}<p>5 Long Acre Road</p>'
    org = {"@type": "Organization", "email": "o@o.org", "url": "https://acme.org"}
    rows = [(1, "https://h.com/contact", page(body=body)), (2, "https://h.com/", page(org, body=body)), (3, "https://h.com/", page(title=""))]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    a, b, c = PG.parse_pages(frame, max_links=3).orderBy("page_id").collect()
    assert (a.company_name, a.website, a.email, a.address, a.confidence, a.extractor_version) == (
        "Acme Foods", "https://h.com/contact", "a@b.c", "5 Long Acre Road", 0.68, "heuristic-v1")
    assert a.important_page_links == {"about": [f"https://h.com/about{i}" for i in range(5)], "contact": ["https://h.com/contact"]}
    assert [x.page_type for x in a.important_page_candidates] == ["contact"] + ["about"] * 5
    assert a.discovered_links == [f"https://h.com/about{i}" for i in range(3)] and a.link_count == 9
    assert a.social_links == ["https://x.com/a"]
    assert (b.email, b.website, b.confidence, b.description, b.page_type) == ("o@o.org", "https://acme.org", 0.92, None, "generic")
    assert (c.company_name, c.confidence) == ("H", 0.15)
    s = PG.parse_pages(frame, variant="starter").orderBy("page_id").collect()
    assert [(x.company_name, x.email, x.confidence) for x in s] == [
        ("Acme Foods - Home", None, 0.45), (None, "o@o.org", 0.9), (None, None, 0.2)]
    assert [x.page_id for x in PG.admitted(PG.parse_pages(frame, variant="starter"), "starter").orderBy("page_id").collect()] == [1, 2]


def test_rich_signals_and_business_record(spark):
    graph = {"@graph": [{"@type": "Brand", "legalName": "Acme Brand", "telephone": "+91 22 5555 6666",
                         "contactPoint": {"email": "help@acme.org"}, "address": {"streetAddress": "7 North Road", "addressLocality": "Pune"}}]}
    head = (
        '<title>Welcome | Acme Foods</title><meta property="og:site_name" content="Acme &amp; Sons"><meta name="description" content="short">'
        '<meta property="og:description" content="Acme moves goods across the country."><link rel="canonical" href="/home">'
    )
    body = (
        '<header><div class="site-logo">Acme <b>Logo</b></div></header><img src="/logo.png" alt="Acme pic"><h1>Hello <i>you</i></h1>'
        '<div id="ContactBox">Phone: 022 4000 1234</div><footer>© Acme. Based in Mumbai, India</footer><script>x()</script>'
        '<a href="https://www.linkedin.com/company/acme/">in</a>'
    )
    html = f"<html><head>{head}{LD.format(json.dumps(graph))}</head><body>{body}</body></html>"
    frame = spark.createDataFrame([(1, "https://acme.org/", html, "https://acme.org/")], "page_id int, url string, html string, final_url string")
    signals = SG.rich_signals(frame)
    s = signals.first()
    assert s.canonical_url == "https://acme.org/home"
    assert s.company_name_candidates == ["Acme Brand", "Acme & Sons", "Acme pic", "Acme Logo", "© Acme. Based in Mumbai, India", "Hello you"]
    assert s.schema_addresses == ["7 North Road, Pune"] and s.schema_emails == ["help@acme.org"] and s.schema_telephones == ["+91 22 5555 6666"]
    assert s.focused_text_blocks == ["Phone: 022 4000 1234", "© Acme. Based in Mumbai, India"]
    assert "x()" not in s.body_text and "Hello you" in s.body_text
    item = SG.result_items(signals).first().item
    business = item.metadata.business
    assert item.metadata.description == "Acme moves goods across the country."
    assert business.company_name == "Acme Brand" and business.emails == ["help@acme.org"]
    assert business.phones == ["+91 22 5555 6666", "022 4000 1234"]
    assert business.headquarters_or_location_mentions == ["7 North Road, Pune", "Mumbai, India"]
    failed = SG.result_items(signals, ok=F.lit(False)).first().item
    assert failed.title == "https://acme.org/" and failed.metadata.business.phones == [] and failed.metadata.business.company_name is None
