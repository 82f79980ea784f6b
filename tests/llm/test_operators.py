"""The corpus operators on small tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns, brute force."""

import base64
import hashlib
import random
import re

import pytest
from compare import differences, duck

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402

import corpus_pipeline  # noqa: E402
from firmloom.llm import bpe, byte_cnn, decontaminate, html_text, jaccard, pseudonyms, quality, queries, secret_scan, url_filter, warc  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, n_words string, label int"
SF_DIR = "/root/testdata/sf0.001"


def documents(spark, texts):
    rows = [(i, t, ("en", None, "xx", "fr")[k % 4], None if k % 3 == 0 else "src", None, "own", "own", k) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rnd, n):
    words = "the of and to in is that for with on be are was by this as at from or it".split() + [f"w{i}x" for i in range(200)]
    return " ".join(rnd.choice(words) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(3)
    long = prose(rnd, 30_000)
    base = prose(rnd, 300)
    texts = [(1, None), (2, ""), (3, "  \n\t"), (4, base), (5, base), (5, base), (6, base + " tail"), (None, base), (7, long), (8, "x" * 200_000), (9, "One two")]
    return documents(spark, texts)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), duck(SF_DIR), queries.SQL[name]) is None


def test_url_filter(spark):
    urls = [
        "http://A.com/x", "http://example.com/en/1", "http://www.example.com/en/1", "http://x.net/es/2", "http://com", "no scheme", None, "", "http://h.org/a?b://c/d#e",
        "ftp://net/fr/", "://z.org/p", "http://com/",
    ]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)] + [(0, urls[0], "mine"), (None, "http://q.org/z", None)], "page_id long, url string, verdict string")
    rows = url_filter.filter_urls(pages).collect()
    assert len(rows) == len(urls) + 2
    got = {r.page_id: r for r in rows}
    assert [(got[i].host, got[i].path) for i in (0, 4, 5, 6, 8, 10)] == [("a.com", "/x"), ("com", ""), ("", ""), ("", ""), ("h.org", "/a"), ("z.org", "/p")]
    assert [got[i].rule for i in range(5)] == ["com/", "example.com/en/", "www.example.com/en/", "net/es/", None]
    assert [got[i].verdict for i in (0, 1, 2, 3, 5, 6, 9, 11)] == ["allow", "block", "allow", "block", "allow", "allow", "block", "allow"]
    assert url_filter.filter_urls(pages.where("false")).count() == 0


def test_url_models_tell_good_from_bad(spark):
    rnd = random.Random(1)
    good, bad = (lambda: "".join(rnd.choice("abcd") for _ in range(12))), (lambda: "".join(rnd.choice("wxyz") for _ in range(12)))
    urls = [f"http://{good()}.com/{good()}" for _ in range(300)] + [f"http://{bad()}.net/es/{bad()}" for _ in range(300)]
    open_ones = [f"http://{good()}.org/{good()}" for _ in range(50)] + [f"http://{bad()}.org/{bad()}" for _ in range(50)]
    pages = spark.createDataFrame(list(enumerate(urls + open_ones)), "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in url_filter.filter_urls(pages).collect()}
    assert sum(verdicts[600 + i] == "allow" for i in range(50)) >= 48
    assert sum(verdicts[650 + i] == "block" for i in range(50)) >= 48


def test_quality(spark, mixed):
    rows = {}
    for r in quality.quality_rules(mixed, carry=("doc_id", "label", "n_words")).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert len(rows[5]) == 2 and rows[5][0].kept == rows[5][1].kept
    assert all(rows[i][0].n_words == 0 and rows[i][0].base_failed and not rows[i][0].kept for i in (1, 2, 3))
    assert rows[7][0].n_words == 30_000 and rows[4][0].label == 3
    assert quality.quality_rules(mixed.where("false")).count() == 0


def test_quality_of_other_scripts(spark):
    rnd = random.Random(8)

    def text(letters, n=120):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 8))) for _ in range(n))

    few = {"hi": "कखगघचजटडतदनपमयरलवसह" + "ािीुे्", "ar": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "th": "กขคงจชซดตถทนบปผพมยรลวสหอ", "ko": "가나다라마바사아자차카타파하", "zh": "的一是不了人我在有他这为之大来以个中上们", "he": "אבגדהוזחטיכלמנסעפצקרשת"}
    rows = [(i, prose(rnd, 200), "en") for i in range(100)]
    rows += [(1000 + 10 * k + i, text(v), n) for k, (n, v) in enumerate(few.items()) for i in range(3)]
    up = [(2000 + i, text("ABCDEFGHIJ"), "up") for i in range(quality.MIN_REFERENCE_DOCS)] + [(3000, text("ABCDEFGHIJ"), None), (3001, text("ABCDEFGHIJ"), "rare")]

    def verdicts(docs):
        got = quality.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), carry=("doc_id",)).collect()
        assert len(got) == len(docs)
        return {r.doc_id: r.kept for r in got}

    kept = verdicts(rows)
    assert [(n, i) for i, _, n in rows if n in few and not kept[i]] == []
    kept = verdicts(rows[:100] + up)
    assert all(kept[2000 + i] for i in range(quality.MIN_REFERENCE_DOCS)) and not kept[3000] and not kept[3001]


def test_repeated_words_by_brute_force(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(30))) for _ in range(60)]

    def count(t):
        w = t.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})

    got = {r.doc_id: r.n_repeat_words for r in quality.quality_rules(documents(spark, list(enumerate(texts))), carry=("doc_id",)).collect()}
    assert [got[i] for i in range(60)] == [count(t) for t in texts]


def test_secrets(spark, mixed):
    key = hashlib.sha1(b"k").hexdigest()
    found = f'set token = "{key}" now. Donaudampfschifffahrtsgesellschaft or a commit'
    docs = mixed.unionByName(documents(spark, [(20, found), (20, found), (21, f"password: {key[:20]}Zq and password: {key[:20]}Zq")]))
    findings = secret_scan.scan(docs, VOCABULARY)
    secrets = [r for r in findings.collect() if r.is_secret]
    assert sorted(r.doc_id for r in secrets) == [20, 20, 21, 21]
    clean = secret_scan.redact(docs, findings)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r.doc_id: r for r in clean.collect()}
    assert texts[20].text == found.replace(key, secret_scan.MASK) and texts[20]._key == "own"
    assert texts[21].text == "password: [SECRET] and password: [SECRET]" and texts[1].text is None
    assert secret_scan.scan(docs.where("false"), VOCABULARY).count() == 0
    assert secret_scan.redact(docs.where("false"), findings).count() == 0


def test_secrets_of_known_shape_under_neutral_names(spark):
    body = hashlib.sha512(b"k").hexdigest()
    block = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    shapes = ["AKIA" + body[:16].upper(), "ghp_" + body[:36], "xoxb-" + body[:20], "sk-" + body[:30], "AIza" + body[:35], f"eyJ{body[:20]}.eyJ{body[20:50]}.{body[50:70]}", block]
    forms = ["ID_OF = {}", "slack: {}", 'cfg => "{}"', "x={}", "env: OTHER={}", f"{'n' * 60}: {{}}", "thing{}= {{}}".format(" " * 9), "q=12345678&r={}", "a/b/{}"]
    cases = [(form.format(v), v) for v in shapes for form in forms]
    cases = [c for c in cases if not (c[0].startswith("a/b/") and c[1] == block)]
    text = body[:32]
    cases += [(f.format(text), text) for f in ("env: API_KEY={}", "env: API_KEY_NAME = {}", "some_name: API_KEY_NAME: {}", "q=12345678&api_key={}", "PASSWORD        = {}")]
    cases += [("token = QUJDREVGR0g5PQab12=\nsomething_long", "QUJDREVGR0g5PQab12="), ("password = Abc=12345678defgh9Q", "Abc=12345678defgh9Q")]
    rows = secret_scan.candidates(documents(spark, [(i, c) for i, (c, _) in enumerate(cases)]), VOCABULARY).collect()
    got = {}
    for r in rows:
        if r.label == 1:
            got.setdefault(r.id, []).append(cases[r.id][0][r["start"] : r["end"]])
    wrong = [(c, got.get(i)) for i, (c, v) in enumerate(cases) if not any(v in x for x in got.get(i, []))]
    assert wrong == []
    assert secret_scan.CANDIDATE.search("PASSWORD        = hunter2hunter2x")["value"] == "hunter2hunter2x"


def test_pseudonyms(spark):
    worker = pseudonyms.Pseudonymizer(b"k")
    for size in (1, 2, 10, 97):
        images = [worker.feistel.permute("t", i, size) for i in range(size)]
        assert sorted(images) == list(range(size))
        assert [worker.feistel.permute("t", i, size, back=True) for i in images] == list(range(size))
    text = "a.b7@mail.example.com 10.2.3.4 4111 1111 1111 1111 DE89370400440532013000 123-45-6789 2024-02-29 31.12.1999 +1 (017) 555-7713"
    new, found = worker.replace(text)
    assert [k for k, _, _ in found] == ["email", "ipv4", "card", "iban", "ssn", "date", "date", "phone"]
    assert all(new[a:b] not in text for _, a, b in found)
    assert worker.replace(new)[1] == found and len(new.split()) == len(text.split())  # every image passes its own check
    assert worker.replace("card 4111111111111112, ip 300.1.1.1, 2023-02-30")[1] == []
    rows = pseudonyms.pseudonymize(documents(spark, [(1, text), (2, f"x {text}"), (3, None), (4, ""), (1, text)]), b"k").collect()
    assert [r.n_pii for r in sorted(rows, key=lambda r: r.doc_id)] == [8, 8, 8, 0, 0]
    assert rows[1].text == f"x {rows[0].text}" and rows[0]._key == "own"
    assert pseudonyms.pseudonymize(documents(spark, [(1, "")]).where("false")).count() == 0


def test_pseudonyms_of_slash_and_mixed_dates(spark):
    worker = pseudonyms.Pseudonymizer(b"k")
    mixed = "3/4.2021 and 3.4/2021"
    assert worker.replace(mixed) == (mixed, [])
    assert worker.replace("13/25/2020 and 02/30/2020")[1] == []
    days = [f"{m:02d}/{d:02d}/{y}" for y in range(1999, 2003) for m in range(1, 13) for d in range(1, 29)]
    days += [f"{d:02d}/{m:02d}/{y}" for y in range(1999, 2003) for m in range(1, 13) for d in range(13, 29)]
    images = [worker.replace(d) for d in days]
    assert all(found and new != d for d, (new, found) in zip(days, images, strict=True)) and len({new for new, _ in images}) == len(days)
    for d, (new, _) in zip(days, images, strict=True):  # month-first dates stay such
        assert (int(new[3:5]) > 12) == (int(d[3:5]) > 12)
    rows = pseudonyms.pseudonymize(documents(spark, [(1, mixed), (2, "on 12/25/2020")]), b"k").collect()
    assert sorted((r.doc_id, r.n_pii) for r in rows) == [(1, 0), (2, 1)]


def test_decontamination_by_brute_force(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate([1, 2, 4, 9, 10, 11, 14, 30, 30])] + [(90, None), (91, "!!"), (92, "Zürich " * 12), (None, "w1 w2")]
    texts = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(60)] + [(70, None), (71, ""), (72, "zürich, " * 40), (73, "ZÜRICH " * 12), (5, "w1")]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def tokens(t):
        return word.findall((t or "").translate(lower))

    windows = {}
    for i, t in items:
        w = tokens(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)

    def expected(t):
        w, hit, held = tokens(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    held |= found
        return len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest(), bool(hit)

    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.decontamination(docs, bench).collect())
    assert got == sorted((i, *expected(t)) for i, t in texts)
    assert decontaminate.decontamination(docs.where("false"), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontamination(docs, bench.where("false")).collect())


def test_warc(spark):
    rows = [(1, "http://a.com/x", "hi"), (2, "http://a.com/x", "hi"), (3, None, None), (4, None, ""), (5, "no host", "hi"), (5, "no host", "hi"), (None, "http://b.com/\n", "z\r\n\r\nq"), (7, "http://a.com/y", "é" * 100_000)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, key int")
    index, _ = warc.archive_pages(pages)
    got = warc.look_up(warc.capture_keys(pages), index).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert [(by_id[i].record_type, by_id[i].refers_to) for i in (1, 2, 3, 4, 5, 7)] == [("response", None), ("revisit", 1), ("response", None), ("revisit", 3), ("revisit", 1), ("response", None)]
    assert by_id[7].payload_bytes == 200_000
    assert by_id[2].payload_digest == base64.b32encode(hashlib.sha1(b"hi").digest()).decode()
    assert [r.page_id for r in index.captures("http://a.com/x")] == [1, 2]
    assert list(index.captures("http://none.com/")) == []
    index, _ = warc.archive_pages(pages.where("false"))
    assert warc.look_up(warc.capture_keys(pages.where("false")), index).count() == 0


def test_jaccard_by_brute_force(spark, mixed):
    rnd = random.Random(11)
    texts = []
    for g in range(12):
        words = [f"g{g}w{rnd.randrange(60)}" for _ in range(rnd.randrange(3, 60))]
        for _ in range(12):
            copy = list(words)
            for _ in range(rnd.randrange(5)):
                copy[rnd.randrange(len(copy))] = f"n{rnd.randrange(40)}"
            texts.append((len(texts), " ".join(copy)))
    texts += [(500, None), (501, ""), (502, "One"), (503, "one"), (504, "one two")]
    for words, percent in ((3, 90), (5, 80), (2, 50)):
        sets = {}
        for i, t in texts:
            w = (t or "").lower().split()
            sets[i] = {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, 1))} if w else set()
        at = {i: i for i in sets}
        changed = True
        links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
        while changed:
            changed = False
            for i, j in links:
                if at[i] != at[j]:
                    at[i] = at[j] = min(at[i], at[j])
                    changed = True
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents(spark, texts), words, percent).collect()}
        assert got == {i: (len(s), at[i]) for i, s in sets.items()}
    kept = jaccard.one_of_each(mixed).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 2, 3, 4, 7, 8, 9] and all(r._key == "own" for r in kept)
    assert jaccard.one_of_each(mixed.where("false")).count() == 0


def test_classifier(spark):
    docs, labels = spark.read.parquet(f"{SF_DIR[:-5]}0.1/documents.parquet"), spark.read.parquet(f"{SF_DIR[:-5]}0.1/labels.parquet")
    rows = byte_cnn.score_quality(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    right = [[r.predicted == q for r in rows if r.quality == q] for q in (0, 1)]
    assert min(sum(x) / len(x) for x in right) > 0.9
    odd = documents(spark, [(1, None), (2, ""), (2, ""), (None, "x"), (3, "y" * 300_000)])
    scored = byte_cnn.score_quality(odd, labels.where("false")).collect()
    assert [r.score for r in scored] == [0.5] * 5
    assert byte_cnn.score_quality(odd.where("false"), labels).count() == 0


def test_chunks_cover_everything():
    for n in (256, 257, 448, 449, 1000, 5001):
        starts = byte_cnn.chunk_starts(n)
        assert set(range(n)) == {i for s in starts for i in range(s, s + byte_cnn.CHUNK)}


def test_html(spark):
    page = "<div>Home</div><p>{}</p><div>Copyright A</div>"
    rows = [
        (1, "http://a.com/x/1", page.format("one &amp two")), (2, "http://a.com/x/2", page.format("three\n  four&nbsp;five")), (3, None, None), (4, "http://b.com/", page.format("alone")),
        (4, "http://b.com/", page.format("alone")), (5, "http://c.com/", "<nav>a<nav>b</nav>c</nav><main>in<script>'<p>'</script>side</main> out<p"), (6, "http://c.com/q", ""),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.main_text(pages).collect())
    whole = "Home alone Copyright A"
    assert [g[1] for g in got] == ["one & two", "three four five", "", whole, whole, "inside", ""]
    assert all(len(t) == n for _, t, n in got)
    assert html_text.main_text(pages.where("false")).count() == 0


def test_html_alignment_decides_inside_and_outside_articles(spark):
    notice = "<p>Subscribers read on without adverts</p>"
    teasers = "<article>teaser {0}</article><div>The body of page {0} is long and plain</div><article class='comment'>comment {0}</article>"
    rows = [(i, f"http://a.com/{i}", f"<article><p>first {i}</p>{notice}<p>last {i}</p></article><div>Terms of use</div>") for i in range(2)]
    rows += [(10 + i, f"http://b.com/{i}", teasers.format(i)) for i in range(2)] + [(20, "http://c.com/", teasers.format(7))]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in (0, 1)] == ["first 0 last 0", "first 1 last 1"]
    assert all(f"The body of page {n} is long and plain" in got[i] for i, n in ((10, 0), (11, 1), (20, 7)))


def test_html_template_of_copies_and_stubs(spark):
    top, end = "<div>Our great shop, open since ever</div>", "<div>Copyright by the shop</div>"
    rows = [(i, f"http://a.com/p/{i}", f"{top}<nav>menu {i}</nav><p>same text</p>{end}") for i in range(4)]
    rows += [(9, "http://a.com/q", f"{top}<p>{'other text ' * 40}</p>{end}"), (10, "http://b.com/1", f"{top}<p>hm</p>{end}"), (11, "http://b.com/2", f"{top}<p>{'long text ' * 40}</p>{end}")]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 10)] == ["same text"] * 4 + ["hm"]
    assert got[9] == ("other text " * 40).strip() and got[11] == ("long text " * 40).strip()


def test_html_without_end_tags():
    def kept(page):
        return " ".join(x.text for x in html_text.lines_of(page) if not x.furniture)

    assert kept('<div><p class="share">Share<p>one</p><p>two</p></div><article><p>three</p></article>') == "one two three"
    assert kept('<div><p class="share">Share</div><p>one</p>') == "one"
    assert kept('<ul><li class="related">Related<li>one<li>two</ul><p>three') == "one two three"
    assert kept('<ul><li class="related">Related<ul><li>inner</li></ul>more</li><li>one</li></ul>') == "one"
    assert kept('<ul><li class="related">Related</ul><article>one</article>') == "one"
    assert kept('<dl><dt class="ads">a<dd>one<dd class="ads">b<dt>two</dl>three') == "one two three"
    assert kept('<table><tr><td class="ads">a<td>one<tr class="ads"><td>b<tr><td>two</table>three') == "one two three"
    assert kept('<table><tr><td class="ads">a<table><tr><td>b</table>c<td>one</table>') == "one"
    assert kept('<div><div class="ad">a</div><p>one</p><div class="ad">b<div>c</div>d</div>two</div>') == "one two"
    assert kept('<article><div class="ad">a<p>b</article><p>one</p>') == "one"
    assert kept('<p>one <span class="share">a<span>b</span>c</span> two</p>') == "one two"
    assert kept('<html><head><title>t</title><meta name="x"><body><p>one') == "one"
    assert kept('<h2 class="related">a</h3><p>one</p>') == "one"
    assert kept('<div class="ad">a</p></span></li>b</div>one') == "one"


def test_common_lines_by_brute_force():
    rnd = random.Random(2)
    for _ in range(500):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        taken, rest = sorted(html_text.common_lines(a, b)), iter(b)
        assert len(taken) == best[-1][-1] and all(a[i] in rest for i in taken)


def test_bpe_is_tiktoken(spark, mixed):
    import tiktoken

    ranks, _ = bpe.load_ranks(VOCABULARY)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(4)
    texts = [t for (t,) in mixed.select("text").collect()]
    texts += ["".join(rnd.choice("ab ") for _ in range(60)) for _ in range(100)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(1, 128), rnd.randrange(128, 0xD800), rnd.randrange(0xE000, 0x20000)])) for _ in range(40)) for _ in range(200)]
    got = list(bpe.DocumentCodec(VOCABULARY, public_tokenizers.PATTERN).encode([t or "" for t in texts]))
    assert [list(memoryview(g).cast("I")) for g in got] == [plain.encode_ordinary(t or "") for t in texts]
    rows = bpe.encode_digests(mixed, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert len(rows) == mixed.count() and all(r.round_trip for r in rows)
    assert bpe.encode_digests(mixed.where("false"), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        sizes.append(out.count())
    assert all(a <= docs.count() for a in sizes)
    kept = {r.doc_id for r in quality.quality_rules(docs, carry=("doc_id",)).where("kept").collect()}
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_DIR).select("doc_id").collect()} == kept
    alike = {r.doc_id for r in jaccard.near_duplicates(docs).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).select("doc_id").collect()} == alike
    clean = {r.doc_id for r in decontaminate.decontamination(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).where("NOT contaminated").collect()}
    assert {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, SF_DIR).select("doc_id").collect()} == clean
    empty = docs.where("false")
    assert all(stage(spark, empty, SF_DIR).count() == 0 for _, stage in corpus_pipeline.STAGES)
