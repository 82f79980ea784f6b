"""URL functions against the standard library and literal cases."""

import hashlib
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

from pyspark.sql import functions as F

from firmloom.functions import urls as U
from firmloom.functions.constants import STARTER_TRACKING_PARAMS, TRACKING_PARAMS

URLS = [
    "HTTP://A.com", "//a.com/p?b=2&a=1&UTM_Source=z", "a.com/p", "http://a.com///", "http://a.com/p?x=",
    "http://a.com/?q=a+b&q=%C3%A9~*", "http://a.com/?a=%zz", "http://a.com/?a=%zz%41", "http://a.com/?b=1&b=0&a",
    "http://A.com:8080/x/", "https://user:Pw@A.com/x", "mailto:a@b.c", "http://a.com/x;params?y=1",
    "  https://a.com/x#frag  ", "https://a.com?ref=1&z=2", "https://a.com/?srsltid=9&k=v", "https:///x", "",
    "https://a.com/über?ü=ö", "https://a.com/a?b=c=d&e==f", "ftp://a.com/", "javascript:void(0)",
    "https://a.com/p?utm%5Fsource=1&k=%2B", "http://a.com/a b?c=d e", "HTTPS://[::1]:80/p", "/only/path?x=1", "////x",
]


def expected_canonical(url, dropped):
    s = urlsplit(url.strip())
    path = s.path or "/"
    if path != "/":
        path = path.rstrip("/") if path.endswith("/") else path
    kept = [kv for kv in parse_qsl(s.query) if kv[0].lower() not in dropped]
    return urlunsplit(((s.scheme or "https").lower(), s.netloc.lower(), path, urlencode(sorted(kept)), ""))


def test_canonicalize_and_hash(evaluate):
    got = evaluate(
        [(u,) for u in URLS], "u string",
        canon=U.canonicalize_url(F.col("u")), starter=U.canonicalize_url(F.col("u"), STARTER_TRACKING_PARAMS),
        digest=U.hash_canonical(U.canonicalize_url(F.col("u"))),
    )
    for url, (canon, starter, digest) in zip(URLS, got):
        want = expected_canonical(url, TRACKING_PARAMS)
        assert canon == want, url
        assert starter == expected_canonical(url, STARTER_TRACKING_PARAMS), url
        assert digest == hashlib.sha256(expected_canonical(want, TRACKING_PARAMS).encode()).hexdigest(), url


def test_parts(evaluate):
    got = evaluate(
        [("https://U:p@Shop.A.co.in:81/x?y=1",), ("https://localhost/",)], "u string",
        host=U.extract_host(F.col("u")), root=U.guess_etld1(U.extract_host(F.col("u"))),
    )
    assert got == [("u:p@shop.a.co.in:81", "co.in:81"), ("localhost", "localhost")]


def test_join_url(evaluate):
    bases = ["http://h.com/a/b?q=1", "http://h.com", "https://h.com/a/b/", "https://h.com/a/../b/c"]
    refs = [
        "https://x.com/p", "//h2/p", "/p", "p", "./p", "../p", "../../../p", "?q", "#f", "p/../q", "p/..", "/a/./b",
        "x//y", "p#frag?x", "mailto:a@b", "g;x=1/../y", "", "/x?y=1#z", "..", ".", "http:p", "ftp://f/x",
    ]
    pairs = [(b, r) for b in bases for r in refs]
    got = evaluate(pairs, "b string, r string", out=U.join_url(F.col("b"), F.col("r")))
    for (b, r), value in zip(pairs, got):
        assert value == urljoin(b, r), (b, r)


def test_normalize_result_url(evaluate):
    rows = URLS + [
        "https://www.youtube.com/watch?v=1&t=30s#x", "https://www.ford.com/?srsltid=1&a=", "https://a.com/?t=1&srsltid=2&b",
    ]
    got = evaluate([(u,) for u in rows], "u string", out=U.normalize_result_url(F.col("u")))
    for url, value in zip(rows, got):
        s = urlsplit(url)
        kv = parse_qsl(s.query, keep_blank_values=True)
        gone = ("t",) if "youtube.com" in s.netloc else ("srsltid",) if "ford.com" in s.netloc else ()
        want = urlunsplit((s.scheme, s.netloc, s.path, urlencode([p for p in kv if p[0] not in gone]), ""))
        assert value == want, url


def test_result_link_lists(evaluate):
    links = ["", "https://www.google.com/x", "https://a.com/#1", "https://a.com/#2", "https://in.linkedin.com/c", "https://b.com"]
    out = U.extract_unique_urls(F.col("l"), ("https://www.google.",))
    got = evaluate([(links,)], "l array<string>", urls=out, ranked=U.prioritize_urls(out))
    assert got == [(
        ["https://a.com/", "https://in.linkedin.com/c", "https://b.com"],
        ["https://a.com/", "https://b.com", "https://in.linkedin.com/c"],
    )]


def test_classifiers(evaluate):
    got = evaluate(
        [("https://www.Glassdoor.com/about",), ("https://acme.com/support/Careers",), ("https://acme.com/x",)], "u string",
        kind=U.classify_domain(U.url_authority(F.col("u"))), official=U.is_likely_official_url(F.col("u")),
        page=U.classify_important_page(F.col("u")), hint=U.root_hint(U.url_authority(F.col("u"))),
    )
    assert got == [
        ("aggregator_or_directory", False, "about", "Glassdoor.com"),
        ("likely_official", True, "contact", "acme.com"),
        ("likely_official", True, None, "acme.com"),
    ]
