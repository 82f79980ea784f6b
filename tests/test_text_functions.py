"""Contact, name and segment functions on literal rows."""

from pyspark.sql import functions as F

from firmloom.functions import contacts as C, names as N, segments as S, text as T



def test_whitespace(evaluate):
    rows = [("  a  \n b ",), ("\t",), ("",), (None,)]
    assert evaluate(rows, "v string", out=T.clean_text(F.col("v"))) == ["a b", None, None, None]
    lists = [([" a", "a ", "", None, "b"],)]
    assert evaluate(lists, "v array<string>", out=T.unique_nonempty(F.col("v"))) == [["a", "b"]]


def test_emails(evaluate):
    rows = [
        ("Mail A.B@X.com, or c@d.org; bad..dots@x.com and x@y", [" Sales@X.com. ", "not one", "@x.com"]),
        ("nothing here", None),
        ("a@b.co a@b.co", []),
    ]
    got = evaluate(rows, "v string, d array<string>", out=C.extract_emails(F.col("v"), F.col("d")))
    assert got == [["sales@x.com", "a.b@x.com", "c@d.org"], [], ["a@b.co"]]


def test_phone_candidates(evaluate):
    cases = {
        "+91 22 1234 5678": True, "2019 - 2020": False, "11111111": False, "1 2 3 4 5 6 7 8": False, "022.4000.1234": False,
        "1234567": False, "1234567890123456": False, "12345678": True, "(022) 4000-1234": True, "2019 2020 1999": False,
        "12 34 56 78 90": False, "call 12345678": False, "1990 2000 123456": True, "": False,
    }
    got = evaluate([(k,) for k in cases], "v string", out=C.is_valid_phone_candidate(F.col("v")))
    assert dict(zip(cases, got)) == cases
    rows = [("+91 22 1234 5678 ext 5",), (" 12345678 ,; ",), ("  ",)]
    assert evaluate(rows, "v string", out=C.normalize_phone_candidate(F.col("v"))) == ["+91 22 1234 5678", "12345678", None]
    rows = [("+91  22 1",), ("12345678",), ("022-400",), ("12.34",)]
    assert evaluate(rows, "v string", out=C.format_phone_candidate(F.col("v"))) == ["+91 22 1", "12345678", "022-400", "1234"]


def test_phones_take_the_body_only_when_nothing_else_is_found(evaluate):
    rows = [
        ("Phone: 022 9999 8888", ["tel:+91 22 1111 2222"], ["Call us - 044 1234 5678, 2001 - 2002"]),
        ("Phone: 022 9999 8888 and 080 1111 2222", [], []),
        ("Hotline 1800 123 4567; Tel: 022 9999 8888", None, None),
        (None, None, None),
    ]
    got = evaluate(
        rows, "v string, t array<string>, b array<string>", out=C.extract_phones(F.col("v"), F.col("t"), F.col("b"))
    )
    assert got == [["+91 22 1111 2222", "044 1234 5678"], ["022 9999 8888"], ["022 9999 8888", "1800 123 4567"], []]


def test_locations(evaluate):
    cases = {
        "Pune, India": True, "Pune": False, "12345, 678": False, "a,b,c,d,e,f,g,h": False, "x" * 51: False, "x, " + "y" * 60: True,
        "Our Services Road": False, "z, " * 60: False,
    }
    got = evaluate([(k,) for k in cases], "v string", out=C.is_plausible_location(F.col("v")))
    assert dict(zip(cases, got)) == cases
    text = "headquarters in Pune, India. We are based in lower town; located in Area 51 North"
    got = evaluate([(text, ["Main Road, Delhi"] * 9 + ["Old Road, Agra"])], "v string, s array<string>",
                   cut=C.extract_location_mentions(F.col("v"), F.col("s")), alone=C.extract_location_mentions(F.col("v")))
    # Ten are kept before duplicates go.
    assert got == [(["Main Road, Delhi", "Old Road, Agra"],
                    ["Pune, India. We are based in lower town", "lower town", "Area 51 North"])]


def test_social_profiles(evaluate):
    cases = {
        "https://linkedin.com/company/acme": True, "https://linkedin.com/company": False, "https://linkedin.com/in/jobs": False,
        "https://linkedin.com/pulse/x": False, "https://www.youtube.com/@a": True, "https://youtube.com/watch": False,
        "https://youtube.com/channel/1": True, "https://facebook.com/Login": False, "https://x.com/acme": True,
        "https://netflix.com/title": True, "https://acme.com/x": False, "https://tiktok.com/": False,
    }
    got = evaluate([(k,) for k in cases], "v string", out=C.is_valid_social_profile(F.col("v")))
    assert dict(zip(cases, got)) == cases
    links = ["https://x.com/a/?s=1", "https://x.com/a", "https://x.com/intent/tweet", "https://facebook.com/sharer/x"]
    assert evaluate([(links,)], "v array<string>", out=C.clean_social_profiles(F.col("v"))) == [["https://x.com/a"]]


def test_company_names(evaluate):
    rows = [(" Acme | Official Website ",), ("Acme Corporate",), ("Home Page - Acme",), (" |- ",), (None,)]
    assert evaluate(rows, "v string", out=N.normalize_company_name(F.col("v"))) == ["Acme", "Acme", "Acme", None, None]
    cases = {
        "Acme | Official Website": True, "CONTACT US NOW PLEASE": False, "Our Team": False, "ab": False, "a" * 61: False,
        "a" * 60: True, "Contact Us": False, "Acme Careers": False, "ACME BIG CO": True, "Welcome to Acme": False, "Bread & You": False,
    }
    got = evaluate([(k,) for k in cases], "v string", out=N.is_strong_company_name(F.col("v")))
    assert dict(zip(cases, got)) == cases
    rows = [("Home | Acme Foods - Fresh – Daily|Acme Foods",), ("A-B C",), (None,)]
    got = evaluate(rows, "v string", parts=N.title_name_candidates(F.col("v")), best=N.pick_company_name(N.title_name_candidates(F.col("v"))))
    assert got == [(["Home", "Acme Foods", "Fresh", "Daily"], "Acme Foods"), (["A-B C"], "A-B C"), ([], None)]


def test_summaries(evaluate):
    rows = [("x" * 500,), ("y" * 39,), ("  " + "z " * 20,)]
    assert evaluate(rows, "v string", out=N.pick_company_summary(F.col("v"))) == ["x" * 400, None, None]
    rows = [(["a" * 50, "b" * 31, "c" * 31, "d" * 5, None, "e" * 401],), ([],)]
    assert evaluate(rows, "v array<string>", out=N.pick_best_description(F.col("v"))) == ["b" * 31, None]


def test_segments(evaluate):
    rows = [
        ("1) M/s Acme Travels Pvt Ltd 2) Bob (online booking), bob.com", "acme"),
        ("Zed Logistics, 2) Solo", None),
        ("Ram Kumar; Acme Limited\nx.com", ""),
        (" ,;", None),
    ]
    got = evaluate(
        rows, "v string, k string", parts=S.split_candidate_segments(F.col("v")), best=S.derive_search_company_name(F.col("v"), F.col("k")))
    assert got == [
        (["Acme Travels Pvt Ltd", "Bob", "bob.com"], "Acme Travels Pvt Ltd"),
        (["Zed Logistics", "2) Solo"], "Zed Logistics"),
        (["Ram Kumar", "Acme Limited", "x.com"], "Acme Limited"),
        ([], ""),
    ]
    cases = {"Acme Travels": 25 - 20 + 100, "acme.com": 100 - 10 - 90, "Foo Private Limited": 25 + 15 - 20, "foo": -10, "limited": 25 + 15 - 10}
    got = evaluate([(k,) for k in cases], "v string", out=S.score_segment(F.col("v"), F.lit("acme")))
    assert dict(zip(cases, got)) == cases
    rows = [("M/s.  X",), ("m/s X (Ticket Booking) (kept)",), ("- X :",)]
    assert evaluate(rows, "v string", out=S.normalize_segment(F.col("v"))) == ["M/s. X", "X  (kept)", "X"]


def test_alternation(evaluate):
    pair = S.assign_alternating(F.col("v"), "a", "b")
    fixed = S.assign_alternating(F.col("v"), "a", None)
    got = evaluate([(1,), (2,)], "v int", p=pair["primary"], f=pair["fallback"], q=fixed["primary"], g=fixed["fallback"])
    assert got == [("b", "a", "a", None), ("a", "b", "a", None)]


def test_character_references(spark, evaluate):
    import html
    import random

    from firmloom.functions.html import unescape_entities

    rnd = random.Random(5)
    names = [*html.entities.html5, "amp", "notit;", "notin;", "no", "xyz;", "eacute", "copy", "AMP;", "amplt;", "a" * 40]
    numbers = ["#38;", "#38", "#x26;lt;", "#0;", "#x0", "#128;", "#x9F;", "#129", "#13;", "#11;", "#127;", "#xD800;", "#xFDD0;", "#xFFFF;", "#x1FFFE;", "#x110000;", "#x10FFFF;", "#99999999999999999999999;", "#x000000041;", "#;", "#x;", "#xg", "#1234567"]
    texts = ["&eacute;&middot;&copy", "&notit;", "&#38;lt;", "&amp;lt;", "&amp;amp;", "", "&", "&&amp;", "a & b", "&ampx=1&copy=2", "no reference"] + [f"&{n}" for n in numbers]
    for _ in range(600):
        texts.append("".join(rnd.choice((f"&{rnd.choice(names)}", f"&{rnd.choice(numbers)}", f"&#{rnd.randrange(1200000)};", f"&#x{rnd.randrange(70000):x}", rnd.choice(";&#x \t<=é😀lt"), "text")) for _ in range(rnd.randrange(8))))
    texts += [f"&{n}" for n in html.entities.html5]
    got = evaluate([(t,) for t in texts], "t string", u=unescape_entities(F.col("t")))
    wrong = [(t, g, html.unescape(t)) for t, g in zip(texts, got, strict=True) if g != html.unescape(t)]
    assert wrong == []
