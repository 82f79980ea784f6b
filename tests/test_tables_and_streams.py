"""Sources, versioned tables, skew helpers, records and the streaming stages."""

import json

import pytest
from pyspark.sql import functions as F

from firmloom import schemas, skew
from firmloom.operators import frontier as FR, health as HL, intake as IN, profiles as PR
from firmloom.sources import lists as LS, tables as TB
from firmloom.streaming import stages as ST


def now():
    return F.lit("2024-01-15 00:00:00").cast("timestamp")


# --- text and JSON lines -----------------------------------------------------
def test_lists(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text(" https://a.com \n\nhttps://b.com\n")
    assert sorted(r.url for r in LS.read_seeds(spark, str(tmp_path / "seeds.txt")).collect()) == ["https://a.com", "https://b.com"]
    lines = [f"query {i}" if i % 7 else "  " for i in range(1, 2001)]
    (tmp_path / "queries.txt").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.query_id: r.query for r in LS.read_queries(spark, str(tmp_path / "queries.txt")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: q.strip() for i, q in enumerate(lines, 1) if q.strip()}


def test_records(spark, tmp_path):
    good, bad = LS.read_records(spark, str(tmp_path / "none"))
    assert good.count() == 0 and bad.count() == 0
    path = tmp_path / "r.jsonl"
    path.write_text('{"query_id": 1, "status": "ok"}\n\n{broken\n{"query_id": 2, "status": "failed"}\n{"query_id": 1}\n{"status": "ok"}\n')
    good, bad = LS.read_records(spark, str(path))
    assert good.count() == 4 and [r._corrupt for r in bad.collect()] == ["{broken"]
    assert sorted(r.query_id for r in LS.completed_ids(good).collect()) == [1, 2]
    assert sorted(r.query_id for r in LS.completed_ids(good, only_ok=True).collect()) == [1]
    LS.append_records(good, str(tmp_path / "out"))
    LS.append_records(good, str(tmp_path / "out"))
    assert LS.read_records(spark, str(tmp_path / "out"))[0].count() == 8
    LS.write_summary(good, str(tmp_path / "summary"), single_file=True)
    assert len(list((tmp_path / "summary").glob("part-*"))) == 1


# --- tables ------------------------------------------------------------------
def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "t")
    assert TB.read_snapshot(spark, root, schemas.RAW_PAGES).count() == 0
    one = spark.createDataFrame([("a", "1")], schemas.RAW_PAGES)
    assert TB.write_snapshot(one, root, "b0") == 1
    grown = TB.read_snapshot(spark, root, schemas.RAW_PAGES).unionByName(spark.createDataFrame([("b", "2")], schemas.RAW_PAGES))
    assert TB.write_snapshot(grown, root, "b1") == 2
    assert TB.write_snapshot(one, root, "b1") == 2
    assert TB.read_snapshot(spark, root, schemas.RAW_PAGES).count() == 2
    TB.append_snapshot(spark.createDataFrame([("c", "3")], schemas.RAW_PAGES), root, "b2")
    assert sorted(r.html for r in TB.read_snapshot(spark, root, schemas.RAW_PAGES).collect()) == ["1", "2", "3"]
    TB.write_snapshot(TB.read_snapshot(spark, root, schemas.RAW_PAGES), root)
    assert TB.read_snapshot(spark, root, schemas.RAW_PAGES).count() == 3
    full = TB.with_defaults(spark.createDataFrame([("h",)], "host string"), schemas.DOMAIN_STATE, schemas.DOMAIN_STATE_DEFAULTS).first()
    assert (full.crawl_delay_ms, full.max_parallelism, full.recrawl_interval_hours, full.success_rate) == (1000, 1, 168, 1.0)
    assert set(TB.empty_table(spark, "urls").columns) == set(schemas.URLS.names)


def test_upsert(spark):
    current = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    incoming = spark.createDataFrame([("a", "9", 1), ("a", "8", 2), ("c", None, 1)], "k string, v string, t int")
    assert sorted(TB.upsert(current, incoming, "k", ["t"]).collect(), key=str) == [("a", "8"), ("b", "2"), ("c", None)]


def test_skew_helpers(spark):
    rows = [(g, i * 2, (i * 7) % 11) for i in range(60) for g in [i % 3 if i % 2 else 0]]
    frame = spark.createDataFrame(rows, "g int, pos long, v int")
    expect_prev, expect_sum, last, total = {}, {}, {}, {}
    for g, pos, v in rows:
        expect_prev[pos], last[g] = last.get(g), v
        total[g] = total.get(g, 0) + v
        expect_sum[pos] = total[g]
    for size in (6, 10_000):
        assert {r.pos: r.p for r in skew.previous_value(frame, "g", "pos", "v", "p", size).collect()} == expect_prev
        sums = skew.running_totals(frame, "g", "pos", {"s": F.col("v")}, size)
        assert {r.pos: r.s for r in sums.collect()} == expect_sum
        numbered = skew.number_rows(frame, "pos", [], "n", 100, size).collect()
        assert [r.n for r in sorted(numbered, key=lambda r: r.pos)] == list(range(101, 161))
    lookup = spark.createDataFrame([(0, "zero"), (1, "one")], "g int, name string")
    for hot in (3, 10_000):
        got = skew.lookup_join(frame, lookup, "g", F.col("pos"), hot).collect()
        assert len(got) == 60 and {(r.g, r.name) for r in got} == {(0, "zero"), (1, "one"), (2, None)}


# --- frontier ----------------------------------------------------------------
def frontier_rows(spark, rows):
    names = "id long, canonical_url string, url_hash string, host string, render_mode string, depth int, priority double, source_type string, state string, next_fetch_at timestamp, leased_until timestamp, retry_count int, last_fetched_at timestamp, http_status int"
    return spark.createDataFrame(rows, names)


def test_greedy_schedule(spark):
    """The two ranks give what a walk over the candidates gives."""
    import random

    rnd = random.Random(2)
    hosts = {f"h{i}": (rnd.choice([1, 2, 3]), rnd.choice(["http"] * 5 + ["browser"]), rnd.choice([0.0, 0.3]), rnd.choice([0.0] * 4 + [0.6])) for i in range(8)}
    rows = [(i, f"u{i}", f"k{i}", f"h{rnd.randrange(10)}", "http", 0, float(rnd.randrange(5)), "x", "ready", None, None, 0, None, None) for i in range(120)]
    policy = spark.createDataFrame(
        [(h, *v) for h, v in hosts.items()], "host string, max_parallelism int, preferred_render_mode string, challenge_rate double, ban_score double"
    ).withColumn("crawl_delay_ms", F.lit(1000))
    got = {r.id: r.decision for r in FR.schedule_decisions(frontier_rows(spark, rows), policy, 12, now()).collect()}
    want, used, taken = {}, {}, 0
    for r in sorted(rows, key=lambda r: (-r[6], r[0]))[:60]:
        quota, mode, challenge, ban = hosts.get(r[3], (2, "http", 0.0, 0.0))
        if mode == "browser" or challenge >= 0.2 or ban >= 0.5:
            want[r[0]] = "promoted"
        elif used.get(r[3], 0) >= quota or taken >= 12:
            want[r[0]] = "deferred"
        else:
            used[r[3]], taken, want[r[0]] = used.get(r[3], 0) + 1, taken + 1, "leased"
    assert got == want


def test_first_arrival_keeps_its_depth(spark):
    old = TB.empty_table(spark, "urls")
    links = spark.createDataFrame(
        [(1, 0, "https://a.com/x", 3), (1, 1, "https://a.com/contact?ref=1", 3), (2, 0, "https://a.com/x/", 1)],
        "position long, link_no int, url string, depth int")
    grown, new = FR.add_discovered_urls(old, links, now())
    got = [(r.id, r.canonical_url, r.depth, r.source_type, r.priority, r.retry_count) for r in new.orderBy("id").collect()]
    assert got == [(1, "https://a.com/x", 3, "discovered_link", 85.0, 0), (2, "https://a.com/contact", 3, "important_contact_page", 120.0, 0)]
    _, none = FR.add_discovered_urls(grown, links, now())
    assert none.count() == 0
    _, starter = FR.add_discovered_urls(old, links, now(), variant="starter")
    assert [r.priority for r in starter.orderBy("id").collect()] == [85.0, 85.0]


# --- health ------------------------------------------------------------------
def test_block_guard(spark):
    import random

    rnd = random.Random(1)
    rows = [(run, i, rnd.random() < 0.15) for run in range(4) for i in range(1, 80)]
    want = set()
    for run in range(4):
        hits = 0
        for r, i, blocked in rows:
            if r == run:
                hits += blocked
                want.add((run, i))
                if i >= 10 and hits / i >= 0.2:
                    break
    frame = spark.createDataFrame(rows, "run_id int, idx long, blocked boolean")
    for size in (7, None):
        assert {(r.run_id, r.idx) for r in HL.block_guard(frame, chunk_rows=size).collect()} == want


def test_record_status(spark):
    items = lambda *t: [{"url": "https://a.com", "title": x, "metadata": {"final_url": None}} for x in t]
    rows = [
        {"query_id": 1, "status": "ok", "results": items("Fine")}, {"query_id": 2, "status": "ok", "results": items("Access DENIED")},
        {"query_id": 3, "status": "ok", "results": []}, {"query_id": 4, "error": "boom", "note": "late"},
        {"query_id": 5, "status": "ok", "error": "got CAPTCHA", "results": items("x")},
    ]
    frame = spark.read.schema(schemas.QUERY_RECORD).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    got = {r.query_id: (r.inferred_status, r.status_detail) for r in HL.infer_record_status(frame).collect()}
    assert got == {
        1: ("ok", None), 2: ("blocked", "Detected blocking or challenge indicators in search/fetch results."),
        3: ("failed", "Search completed but produced no result URLs."), 4: ("failed", "boom | late"), 5: ("blocked", "got CAPTCHA"),
    }


# --- profiles ----------------------------------------------------------------
def stored_records(spark):
    def item(url, name, title, mails=(), description=None):
        return {"url": url, "title": title, "metadata": {"final_url": None, "domain": None, "description": description, "business": {
            "company_name": name, "emails": list(mails), "phones": [], "social_profiles": [], "headquarters_or_location_mentions": [" P  Q "]}}}

    rows = [
        {"query_id": 1, "company_profile": {"company_summary": "Old"}, "results": [
            item("https://www.linkedin.com/company/a", "Acme Linked", "x", ["z@a.com"]),
            item("https://acme.com/about", "Contact Us", "Home | Acme Foods", ["b@a.com", "z@a.com"]),
            item("https://acme.com/", "Acme Foods Official Website", "Acme Foods", ["a@a.com"]),
        ]},
        {"query_id": 2, "company_profile": {"company_summary": "Kept"}, "results": []},
    ]
    return spark.read.schema(schemas.QUERY_RECORD).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def test_repair(spark):
    first, second = PR.repair_records(stored_records(spark)).orderBy("query_id").collect()
    p = first.company_profile
    assert (p.company_name, p.company_summary, p.official_website, p.primary_domain) == ("Acme Foods", "Old", "https://acme.com/about", "acme.com")
    assert p.emails == ["z@a.com", "b@a.com", "a@a.com"] and p.headquarters_or_location_mentions == ["P Q"]
    assert p.all_domains == ["www.linkedin.com", "acme.com"] and p.important_pages == {"about": "https://acme.com/about"}
    names = [r.metadata.business.company_name for r in first.results]
    assert names == ["Acme Linked", "Acme Foods", "Acme Foods"]
    assert first.results[1].metadata.business.brand_domain_mapping.root_hint == "acme.com"
    assert second.company_profile.company_summary == "Kept" and second.company_profile.emails == []


def test_parts_follow_each_other(spark):
    flat = PR.results_of_records(stored_records(spark))
    tasks = spark.createDataFrame([(1, "q"), (9, "r")], "query_id long, query string")
    whole = PR.company_profiles(flat, tasks).where("query_id = 1").first().company_profile.emails
    parts = PR.company_profiles(flat, tasks, part_rows=2).where("query_id = 1").orderBy("part").collect()
    assert len(parts) == 2 and [e for p in parts for e in p.company_profile.emails] == whole
    assert PR.company_profiles(flat, tasks).where("query_id = 9").first().company_profile.emails == []


def test_intake(spark):
    rows = [("acme", "Acme Travels, Pune"), ("acme", "Acme Travels, Pune"), ("zzz", "Acme Travels, Pune"), (None, "Bob Cargo"), (" ", "  "), ("a_me", "ACME Movers")]
    frame = spark.createDataFrame(rows, "matched_keyword string, company_name string")
    done = spark.createDataFrame([(" M/s Bob  Cargo,",)], "company_name string")
    got = {(r.matched_keyword, r.raw_company_name, r.search_company_name) for r in IN.search_inputs(frame, done).collect()}
    assert got == {("acme", "Acme Travels, Pune", "Acme Travels"), ("a_me", "ACME Movers", "ACME Movers")}
    assert IN.search_inputs(frame, limit=1).count() == 1


# --- streams -----------------------------------------------------------------
PAGES = [(i, "h.com", f"https://h{i % 4}.com/{'contact' if i % 2 else ''}", f"h.com/{i}.html",
          f"<title>Firm {i % 3} | Home</title><a href='/p{i % 5}'>x</a> a{i}@b.com") for i in range(1, 13)]


@pytest.fixture
def staged(spark, tmp_path):
    source = tmp_path / "events"
    source.mkdir()
    for part in range(3):
        lines = [json.dumps({"frontier_id": i, "host": h, "depth": 1, "final_url": u, "html_object_key": k}) for i, h, u, k, _ in PAGES[part::3]]
        (source / f"{part}.json").write_text("\n".join(lines + ["{bad"]))
    store = spark.createDataFrame([(k, html) for *_, k, html in PAGES], schemas.RAW_PAGES).withColumn("bucket", TB.store_bucket())
    return source, store


def test_stream_equals_batch(spark, tmp_path, staged):
    source, store = staged
    events = ST.read_messages(spark, schemas.FETCH_EVENT, path=str(source), maxFilesPerTrigger="1")
    parsed = ST.parse_stage(events, store)
    ST.write_messages(parsed, str(tmp_path / "c1"), path=str(tmp_path / "parsed"), available_now=True).awaitTermination()
    batch = ST.parse_stage(ST.decode_messages(spark.read.text(str(source)), schemas.FETCH_EVENT), store)
    back = ST.decode_messages(spark.read.text(str(tmp_path / "parsed")), batch.schema)
    pick = lambda df: sorted(df.select("frontier_id", "parsed.observation.company_name", "parsed.observation.email", "parsed.discovered_links").collect())
    assert pick(back) == pick(batch) and len(pick(back)) == 12


def test_replayed_batch_changes_nothing(spark, tmp_path, staged):
    source, store = staged
    documents = ST.parse_stage(ST.decode_messages(spark.read.text(str(source)), schemas.FETCH_EVENT), store).cache()
    where = ST.Store(str(tmp_path / "db"))
    ST.resolve_batch(documents, 0, where, now())

    def state():
        kinds = {"urls": schemas.URLS, "observations": ST._observed_schema(), "companies": ST._company_schema(),
                 "company_observation_links": ST._link_schema()}
        return {t: TB.read_snapshot(spark, where.path(t), k).count() for t, k in kinds.items()}

    before = state()
    assert before["observations"] == 12 and before["company_observation_links"] == 12 and before["companies"] >= 3
    assert spark.read.parquet(where.path("evidence")).count() == 12
    ST.resolve_batch(documents, 0, where, now())
    assert state() == before
    # The same pages under a new batch number are new observations of the companies that are there.
    ST.resolve_batch(documents, 1, where, now())
    after = state()
    assert after["observations"] == 24 and after["companies"] == before["companies"] and after["urls"] == before["urls"]


@pytest.mark.parametrize("writes", [2, 3, 4])
def test_crash_after_a_write(spark, tmp_path, staged, monkeypatch, writes):
    source, store = staged
    documents = ST.parse_stage(ST.decode_messages(spark.read.text(str(source)), schemas.FETCH_EVENT), store).cache()
    clean, broken = ST.Store(str(tmp_path / "clean")), ST.Store(str(tmp_path / "broken"))
    ST.resolve_batch(documents, 0, clean, now())
    real, done = TB._publish, []

    def publish(*args):
        version = real(*args)
        done.append(version)
        if len(done) == writes:
            raise OSError("lost")
        return version

    with monkeypatch.context() as m:
        m.setattr(TB, "_publish", publish)
        with pytest.raises(OSError):
            ST.resolve_batch(documents, 0, broken, now())
    ST.resolve_batch(documents, 0, broken, now())

    def state(where):
        kinds = {"observations": ST._observed_schema(), "companies": ST._company_schema(), "company_observation_links": ST._link_schema()}
        rows = {t: sorted(map(str, TB.read_snapshot(spark, where.path(t), k).collect())) for t, k in kinds.items()}
        return rows | {"values": sorted(map(str, ST.stored_values(spark, where).collect()))}

    assert state(broken) == state(clean)
    assert {r.status for r in TB.read_snapshot(spark, broken.path("companies"), ST._company_schema()).collect()} == {"active"}


def test_first_arrivals(spark, tmp_path):
    for part, rows in enumerate([["a", "b", "a"], ["b", "c"], ["a"]]):
        (tmp_path / f"{part}.json").write_text("\n".join(json.dumps({"url_hash": r, "ts": f"2024-01-01T00:0{part}:00"}) for r in rows))
    for n, extra in enumerate(({}, {"event_time": "ts", "horizon": "1 hour"})):
        stream = spark.readStream.schema("url_hash string, ts timestamp").option("maxFilesPerTrigger", 1).json(str(tmp_path / "[0-9].json"))
        q = ST.first_arrivals(stream, **extra).writeStream.format("memory").queryName(f"arrivals{n}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert sorted(r.url_hash for r in spark.table(f"arrivals{n}").collect()) == ["a", "b", "c"]
