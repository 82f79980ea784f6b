"""Inputs derived from the shared tables (see FIXTURES.md), as DataFrames.

Only integer arithmetic and string concatenation, so that the same rows can be
written down again in plain SQL (``fixtures_sql``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmloom.operators.frontier import discovered_rows, first_per_key, with_url_columns
from firmloom.skew import running_totals

NOW_TEXT = "2024-01-15 00:00:00"


def now() -> Column:
    return F.lit(NOW_TEXT).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_modulus(value: Column, choices: Sequence[str | None]) -> Column:
    """``choices[value % len(choices)]``; ``{}``-free plain strings or null."""
    chain = None
    for i, choice in enumerate(choices):
        test, out = (value % len(choices)) == i, F.lit(choice).cast("string")
        chain = F.when(test, out) if chain is None else chain.when(test, out)
    return chain


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, source_type, depth, id: two spellings of every page URL with a path suffix."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    head = F.regexp_extract("url", "^[^?#]*", 0)
    suffix = by_modulus(F.col("page_id"), ["/about", "/contact-us", "/team", "/login", "/terms", ""])
    raw = pages.withColumn("u", F.concat(head, suffix, F.substring("url", F.length(head) + 1, F.length("url"))))
    u = F.col("u")
    other = F.when(u.contains("?") & ~u.contains("#"), F.concat(u, F.lit("&utm_medium=x"))).otherwise(
        F.concat(F.upper(F.substring_index(u, "://", 1)), F.lit("://"), F.substring_index(u, "://", -1))
    )
    both = raw.select("page_id", F.posexplode(F.array(u, other)).alias("n", "url"))
    return both.select(
        "url",
        F.when(F.col("page_id") % 4 == 0, "manual_seed").otherwise("discovered_link").alias("source_type"),
        (F.col("page_id") % 10).cast("int").alias("depth"),
        (F.col("page_id") * 2 + F.col("n") + 1).alias("id"),
    )


FRONTIER_COLUMNS = (
    "id", "canonical_url", "url_hash", "host", "etld1", "path", "query_norm", "source_type", "depth", "priority",
    "state", "render_mode", "next_fetch_at", "retry_count", "leased_until", "last_fetched_at", "http_status",
)


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = discovered_rows(seeds(spark, sf_dir), source_type=F.col("source_type"))
    unique = first_per_key(built.drop("url", "scheme", "state"), "url_hash", ["id"])
    i = F.col("id")
    stamp = lambda text: F.lit(text).cast("timestamp")
    leased = i % 5 == 1
    return unique.withColumns(
        {
            "state": F.when(i % 5 == 0, "fetched").when(leased, "leased").otherwise("ready"),
            "next_fetch_at": F.when(i % 3 == 1, stamp("2024-01-14 00:00:00")).when(
                i % 3 == 2, stamp("2024-01-16 00:00:00")
            ),
            "retry_count": (i % 4).cast("int"),
            "leased_until": F.when(leased & (i % 2 == 0), stamp("2024-01-14 23:00:00")).when(
                leased, stamp("2024-01-15 01:00:00")
            ),
            "last_fetched_at": F.when(i % 5 == 0, stamp("2024-01-01 00:00:00")),
            "http_status": F.when(i % 5 == 0, 200),
        }
    ).select(*FRONTIER_COLUMNS)


def domain_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = with_url_columns(table(spark, sf_dir, "pages").select("url")).select("host").distinct()
    n = F.length("host")
    return hosts.where(n % 4 != 0).select(
        "host",
        (n * 10 + 500).cast("int").alias("crawl_delay_ms"),
        (n % 3 + 1).cast("int").alias("max_parallelism"),
        F.when(n % 11 == 0, "browser").otherwise("http").alias("preferred_render_mode"),
        ((n % 10) / 20.0).alias("challenge_rate"),
        F.when(n % 13 == 0, 0.6).otherwise(0.1).alias("ban_score"),
        ((n % 5 + 1) * 24).cast("int").alias("recrawl_interval_hours"),
    )


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    e, failed = F.col("event_id"), F.col("event_type") == "error"
    blocked = failed & (e % 3 == 0)
    host = F.concat(F.lit("h"), F.col("user_id").cast("string"), F.lit(".example.com"))
    path = F.concat(F.lit("/p"), (e % 50).cast("string"))
    rows = events.select(
        e.alias("event_id"),
        F.concat(F.lit("https://"), host, path).alias("url"),
        F.sha2(F.concat(F.lit("https://"), host, path), 256).alias("url_hash"),
        host.alias("host"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        (F.col("user_id") % 10).alias("run_id"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(failed, 503).otherwise(200).alias("status_code"),
        F.floor("value").cast("int").alias("latency_ms"),
        blocked.alias("blocked"),
        F.when(failed, "http 503").alias("block_reason"),
        F.when(blocked, "Access denied").otherwise(F.concat(F.lit("Page "), e.cast("string"))).alias("title"),
    )
    return running_totals(rows, "run_id", "event_id", {"idx": F.lit(1)})


def company_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier").join(
        F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")
    )
    k = F.col("s_suppkey")
    key, name, nation = k.cast("string"), F.col("s_name"), F.col("n_name")
    site = F.concat(F.lit("https://www.s"), key, F.lit(".example.com"))
    digits = F.lpad(key, 4, "0")
    node = F.concat(
        F.lit('<script type="application/ld+json">{"@type":"'),
        by_modulus(k, ["Organization", "LocalBusiness", "WebSite", "None"]),
        F.lit('","name":"'), name, F.lit(' Ltd","url":"'), site, F.lit('/",'),
        F.when(k % 3 == 0, F.concat(F.lit('"telephone":"+1 555 000 '), digits, F.lit('",'))).otherwise(""),
        F.lit('"address":{"streetAddress":"'), key, F.lit(' Main Street","addressLocality":"'), nation,
        F.lit('","postalCode":"1'), digits, F.lit('"},"sameAs":["https://x.com/s'), key,
        F.lit('"],"industry":"Freight","description":"'), name, F.lit('  carries freight"}</script>'),
    )
    html = F.concat(
        F.lit("<html><head><title>"), name, F.lit(' | Home</title><meta name="description" content="'), name,
        F.lit(" of "), nation, F.lit(' moves  goods.">'), F.when(k % 4 < 3, node).otherwise(""),
        F.lit('</head><body><nav><a href="/about-us">About</a><a href="/contact">Contact</a>'),
        F.lit('<a href="/leadership">Team</a><a href="/careers">Jobs</a><a href="/products">Products</a></nav>'),
        F.lit('<a href="mailto:info@s'), key, F.lit('.example.com?subject=hi">mail</a><a href="tel:+91 22 4000 '),
        digits, F.lit('">call</a><a href="https://www.linkedin.com/company/s'), key,
        F.lit('/?trk=1">in</a><p>'), key, F.lit(" Long Acre Road, "), nation,
        F.lit("</p><p>sales@s"), key, F.lit(".example.com</p><!-- <a href=\"/hidden\">x</a> --></body></html>"),
    )
    path = by_modulus(k, ["/", "/about-us", "/contact", "/leadership", "/careers"])
    return joined.select(k.alias("page_id"), F.concat(site, path).alias("url"), html.alias("html"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    domain = F.when(o % 7 != 0, F.concat(F.lit("c"), c.cast("string"), F.lit(".example.com")))
    number = c + F.when(o % 40 == 1, 1).otherwise(0)
    text = lambda *parts: F.concat(*[p.cast("string") for p in parts])

    def some(modulus: int, value: Column) -> Column:
        return F.when(o % modulus != 0, value)

    page_type = F.element_at(
        F.create_map(*[F.lit(x) for pair in (
            ("1-URGENT", "contact"), ("2-HIGH", "about"), ("3-MEDIUM", "leadership"), ("4-NOT SPECIFIED", "careers"),
            ("5-LOW", "generic"),
        ) for x in pair]),
        F.col("o_orderpriority"),
    )
    email = F.when(o % 3 == 0, F.lit(None)).when(o % 11 == 0, "").otherwise(text(F.lit("e"), o % 17, F.lit("@x.com")))
    return table(spark, sf_dir, "orders").select(
        o.alias("id"),
        some(5, text(F.lit("Company "), number)).alias("company_name"),
        F.concat(F.lit("https://"), domain, F.lit("/")).alias("website"),
        domain.alias("primary_domain"),
        email.alias("email"),
        some(4, text(F.lit("+91 22 "), o % 1000 + 10000000)).alias("phone"),
        some(6, text(o % 90, F.lit(" Main Road"))).alias("address"),
        some(9, text(F.lit("City "), o % 13)).alias("city"),
        some(10, text(F.lit("State "), o % 8)).alias("state_region"),
        some(13, text(F.lit("Country "), o % 4)).alias("country"),
        some(14, text(o % 9999)).alias("postal_code"),
        some(2, text(F.lit("Industry "), o % 5)).alias("industry"),
        some(8, text(F.lit("Text "), o)).alias("description"),
        F.array(
            text(F.lit("https://x.com/c"), c), F.when(o % 4 == 1, "").otherwise(text(F.lit("https://in.com/"), o % 3))
        ).alias("social_links"),
        text(F.lit("https://src"), o % 100, F.lit(".example.com/p"), F.floor(o / 2)).alias("source_url"),
        page_type.alias("page_type"),
        F.when(F.col("o_orderstatus") == "P", 0.68).when(F.col("o_orderstatus") == "F", 0.50).otherwise(0.92).alias(
            "confidence"
        ),
        F.lit("heuristic-v1").alias("extractor_version"),
        F.col("o_orderdate").cast("timestamp").alias("observed_at"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, q = F.col("seq"), F.col("query_id").cast("string")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), (F.col("o_custkey") % 500).alias("query_id"))
    rows = running_totals(rows, "query_id", "seq", {"pos": F.lit(1)})  # before the texts, which the numbers need not carry along
    with_q = lambda template: F.concat(*[x for part in template.split("{q}") for x in (F.lit(part), q)][:-1])

    def pick(templates: Sequence[str | None]) -> Column:
        chain = None
        for i, t in enumerate(templates):
            value = F.lit(None).cast("string") if t is None else with_q(t)
            test = o % len(templates) == i
            chain = F.when(test, value) if chain is None else chain.when(test, value)
        return chain

    host = pick(["www.acme{q}.com", "acme{q}.in", "www.linkedin.com", "en.wikipedia.org", "acme{q}.com", "www.justdial.com"])
    path = pick(["/", "/about", "/contact", "/leadership", "/careers", "/x", ""])
    url = F.concat(F.lit("https://"), host, path)
    digit = lambda n: (o % n).cast("string")
    no_items = F.array().cast("array<string>")
    return rows.select(
        "query_id",
        "seq",
        url.alias("url"),
        F.when(o % 13 != 0, url).alias("final_url"),
        pick(["Acme {q} Logistics | Home", "CONTACT US NOW PLEASE", "Our Team", "Acme {q} - Official Website", None]).alias("title"),
        pick([
            "Acme {q}  moves goods and people across the whole country every day.", "Too short", None,
            "  Since 1950 Acme {q} has run   warehouses, trucks and trains for everyone. ",
        ]).alias("description"),
        pick([
            "Acme {q} Logistics", "Contact Us", None, "Welcome to Acme", "A&B {q} Movers", "Acme {q} corporate", "  ",
            "Leadership",
        ]).alias("company_name"),
        F.when(o % 3 == 0, no_items).otherwise(
            F.array(F.concat(F.lit("info"), q, F.lit("@acme.com")), F.concat(F.lit("sales"), digit(4), F.lit("@acme.com")))
        ).alias("emails"),
        F.array(F.concat(F.lit("+91 22 4000 "), F.lpad(digit(9), 4, "0"))).alias("phones"),
        F.array(
            F.concat(F.lit("https://www.linkedin.com/company/acme"), q), F.concat(F.lit("https://x.com/a"), digit(3))
        ).alias("social_profiles"),
        F.when(o % 4 == 0, no_items).otherwise(F.array(F.concat(F.lit("Pune, Area  "), digit(6)))).alias("locations"),
        "pos",
    )


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier").join(
        F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")
    )
    k, s, n = F.col("s_suppkey"), F.col("s_name"), F.col("n_name")
    numbered = F.concat(
        F.lit("1) M/s "), s, F.lit(" Private Limited 2) "), n, F.lit(" Logistics (online booking), "), n, F.lit(".com")
    )
    listed = F.concat(n, F.lit(" Travels, "), s, F.lit("; "), n, F.lit(" Roadways Pvt Ltd"))
    company = F.when(k % 3 == 0, numbered).when(k % 3 == 1, listed).otherwise(F.concat(s, F.lit(" "), n))
    keyword = F.when(F.floor(k / 3) % 3 == 0, n).when(F.floor(k / 3) % 3 == 1, " ")
    rows = joined.select(keyword.alias("matched_keyword"), company.alias("company_name"))
    return rows.unionAll(rows)
