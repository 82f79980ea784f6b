"""Resolution and survivorship against a plain sequential replay."""

import random

import pytest
from pyspark.sql import functions as F

from firmloom.operators import resolve as R, survivorship as SV
from firmloom.operators.components import connected_components

WEIGHTS = {"contact": 1.0, "about": 0.9, "leadership": 0.75, "careers": 0.55, "generic": 0.35}
SCHEMA = (
    "id long, company_name string, website string, primary_domain string, email string, phone string, address string, "
    "city string, state_region string, country string, postal_code string, industry string, description string, "
    "social_links array<string>, source_url string, page_type string, confidence double, extractor_version string, "
    "observed_at timestamp"
)
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def random_rows(seed, n, domains, names):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d = rnd.choice([None, *[f"d{k}" for k in range(domains)]])
        row = dict.fromkeys(NAMES)
        row |= {
            "id": i * 3 + 1, "primary_domain": d, "website": f"https://{d}/" if d else None,
            "company_name": rnd.choice([None, "", *[f"N{k}" for k in range(names)]]),
            "email": rnd.choice([None, "", "a@x", "b@x"]), "phone": rnd.choice([None, "1", "2"]), "city": rnd.choice(["P", None]),
            "social_links": [rnd.choice(["", "s1", "s2"]) for _ in range(2)], "source_url": f"u{rnd.randrange(n)}",
            "page_type": rnd.choice([*WEIGHTS, "other", None]), "confidence": rnd.choice([0.5, 0.68, 0.92]), "extractor_version": f"v{i}",
        }
        rows.append(row)
    return rows


def replay(rows, companies=(), starter=False):
    """One observation after the other; returns ({id: company}, {observation: company id})."""
    table = {c["id"]: dict(c) for c in companies}
    owner, top = {}, max(table, default=0)
    for r in rows:
        w = r["confidence"] * WEIGHTS.get(r["page_type"] or "generic", 0.35)
        hits = [
            i for i, c in table.items()
            if (c["primary_domain"] is not None and c["primary_domain"] == r["primary_domain"])
            or (c["canonical_name"] is not None and c["canonical_name"] == r["company_name"])
        ]
        if hits:
            c = table[min(hits)]
            old = c["w"]

            def choose(prev, new):
                if starter:
                    return prev if new is None else new
                if not new:
                    return prev
                return new if not prev or w > old else prev

            for f in ("email", "phone", "city"):
                c[f] = choose(c[f], r[f])
            c["canonical_name"] = choose(c["canonical_name"], r["company_name"])
            c["primary_domain"] = c["primary_domain"] if r["primary_domain"] is None else r["primary_domain"]
            c["confidence"] = max(c["confidence"], r["confidence"] if starter else w)
        else:
            top += 1
            c = table[top] = {
                "id": top, "canonical_name": r["company_name"] or r["website"] or r["source_url"],
                "primary_domain": r["primary_domain"], "email": r["email"], "phone": r["phone"], "city": r["city"],
                "confidence": r["confidence"],
            }
        c["w"] = w
        owner[r["id"]] = c["id"]
    return table, owner


def as_frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed,n,domains,names,fold", [(1, 300, 40, 60, 10_000), (2, 250, 20, 30, 90)])
def test_exact_resolution(spark, seed, n, domains, names, fold):
    rows = random_rows(seed, n, domains, names)
    table, owner = replay(rows)
    out = R.resolve_observations(as_frame(spark, rows), max_fold_rows=fold, hot_rows=20)
    assert {r.observation_id: r.company_id for r in out.links.collect()} == owner
    got = {r.id: r for r in out.companies.collect()}
    assert set(got) == set(table)
    for i, c in table.items():
        r = got[i]
        assert (r.canonical_name, r.primary_domain, r.primary_email, r.primary_phone, r.city) == (
            c["canonical_name"], c["primary_domain"], c["email"], c["phone"], c["city"]), i
        assert r.confidence == pytest.approx(c["confidence"]) and r.confidence_details.weighted_confidence == pytest.approx(c["w"])


def test_starter_resolution(spark):
    rows = random_rows(13, 150, 25, 40)
    table, owner = replay(rows, starter=True)
    out = R.resolve_observations(as_frame(spark, rows), variant="starter")
    assert {r.observation_id: r.company_id for r in out.links.collect()} == owner
    got = {r.id: (r.canonical_name, r.primary_domain, r.primary_email, r.confidence) for r in out.companies.collect()}
    assert got == {i: (c["canonical_name"], c["primary_domain"], c["email"], c["confidence"]) for i, c in table.items()}


def test_late_batch_keeps_what_is_stored(spark):
    first, second = random_rows(3, 30, 3, 3), random_rows(4, 30, 3, 3)
    for rows, day, step in ((first, "2024-01-12", 0), (second, "2024-01-11", 1000)):
        for r in rows:
            r |= {"observed_at": day, "id": r["id"] + step}

    def frame(rows):
        schema = SCHEMA.replace("observed_at timestamp", "observed_at string")
        made = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], schema)
        return made.withColumn("observed_at", F.col("observed_at").cast("timestamp"))

    one = R.resolve_observations(frame(first), now=F.lit("2024-01-12").cast("timestamp"))
    companies = one.companies.withColumns({"status": F.lit("closed"), "note": F.lit("mine")})
    two = R.resolve_observations(frame(second), companies, now=F.lit("2024-01-13").cast("timestamp"))
    known = {r.id for r in companies.collect()}
    got = {r.id: r for r in two.companies.collect()}
    touched = {r.company_id for r in two.links.collect()}
    assert known & touched and set(got) == known | touched
    for i in known:
        assert (str(got[i].last_seen_at)[:10], got[i].status, got[i].note) == ("2024-01-12", "closed", "mine")
        assert str(got[i].updated_at)[:10] == ("2024-01-13" if i in touched else "2024-01-12")


def test_empty_domain_is_a_key_when_asked(spark):
    rows = [r | {"primary_domain": None, "website": "/about", "company_name": f"N{i}"} for i, r in enumerate(random_rows(6, 5, 2, 2))]
    frame = as_frame(spark, rows).drop("primary_domain")
    for asked, companies in ((True, 1), (False, 5)):
        assert R.resolve_observations(frame, empty_domain_is_key=asked).companies.count() == companies


@pytest.mark.parametrize("fold", [70])
def test_resolution_in_two_batches(spark, fold):
    rows = random_rows(7, 240, 25, 40)
    table, owner = replay(rows)
    first = R.resolve_observations(as_frame(spark, rows[:100]), max_fold_rows=fold)
    second = R.resolve_observations(as_frame(spark, rows[100:]), first.companies, first.links, max_fold_rows=fold)
    links = first.links.unionByName(second.links)
    assert {r.observation_id: r.company_id for r in links.collect()} == owner
    got = {r.id: (r.canonical_name, r.primary_domain, r.primary_email, r.city) for r in second.companies.collect()}
    assert got == {i: (c["canonical_name"], c["primary_domain"], c["email"], c["city"]) for i, c in table.items()}


def test_survivorship_chunks_do_not_matter(spark):
    rows = random_rows(11, 120, 4, 4)
    frame = SV.with_resolution_columns(as_frame(spark, rows)).withColumn("company_id", F.col("id") % 3)
    whole = sorted(SV.merged_companies(frame).drop("confidence_details").collect())
    small = sorted(SV.merged_companies(frame, chunk_rows=10).drop("confidence_details").collect())
    assert whole == small
    for variant in ({"mode": "best"}, {"variant": "starter"}):
        a = sorted(SV.merged_companies(frame, **variant).drop("confidence_details").collect())
        assert a == sorted(SV.merged_companies(frame, chunk_rows=10, **variant).drop("confidence_details").collect())


def test_starter_survivorship(spark):
    rows = [r | {"primary_domain": "d", "website": "https://d/"} for r in random_rows(5, 40, 1, 6)]
    table, _ = replay(rows, starter=True)
    frame = SV.with_resolution_columns(as_frame(spark, rows)).withColumn("company_id", F.lit(1))
    r = SV.merged_companies(frame, variant="starter").first()
    c = table[1]
    assert (r.canonical_name, r.primary_email, r.primary_phone, r.city, r.confidence) == (
        c["canonical_name"], c["email"], c["phone"], c["city"], c["confidence"])


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(500 + i, 501 + i) for i in range(40)] + [(900, None)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(a if b is None else b)
        parent[max(x, y)] = min(x, y)
    # Without coalescing, the edges stay in several partitions and the rounds have to join them.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for hot, chunk in ((3, 10), (1_000_000, 10), (3, 60), (3, 1_000_000)):
            got = connected_components(spark.createDataFrame(edges, "a long, b long"), hot, chunk).collect()
            assert {r.node: r.component for r in got} == {n: find(n) for n in list(parent)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_components_of_hubs_and_paths(spark):
    path, hub = [(i, i + 1) for i in range(300)], [(1000, 1001 + i) for i in range(200)]
    for chunk in (25, 1_000_000):
        named = [(f"n{a:04d}", f"n{b:04d}") for a, b in path + hub + hub]
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(named, "a string, b string"), 50, chunk).collect()}
        assert got == {**{f"n{i:04d}": "n0000" for i in range(301)}, **{f"n{i:04d}": "n1000" for i in range(1000, 1201)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lookup(spark):
    rows = random_rows(9, 200, 12, 12)
    companies = [(i, f"d{i % 9}" if i % 4 else None, f"N{i % 7}") for i in range(1, 30)]
    frame = spark.createDataFrame(companies, "id long, primary_domain string, canonical_name string")
    for hot in (5, 1_000_000):
        got = {r.id: r.matched_company_id for r in R.lookup_companies(as_frame(spark, rows), frame, hot_rows=hot).collect()}
        for r in rows:
            hits = [i for i, d, n in companies if (d and d == r["primary_domain"]) or n == r["company_name"]]
            assert got[r["id"]] == min(hits, default=None)
    assert "NestedLoop" not in R.lookup_companies(as_frame(spark, rows), frame)._jdf.queryExecution().toString()
