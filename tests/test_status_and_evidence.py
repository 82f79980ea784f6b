"""Verdicts over joined texts, raw fields and evidence, arrivals remembered in a table."""

import json
import random

import pytest
from pyspark.sql import functions as F

from firmloom import schemas
from firmloom.functions import html as H
from firmloom.operators import health as HL, pages as PG
from firmloom.sources import tables as TB
from firmloom.streaming import stages as ST

PIECES = ["sign", "in", "Sign", "access", "DENIED", "verify", "you", "are", "human", "verify you", "you are", "are human", "unusual",
          "traffic", "temporarily", "unavailable", "fine", "", None, "a text that is much longer than any signal", "x" * 30 + " sign",
          "in " + "y" * 30, "robo", "t", "verify you are", "unavailable " * 3]


def test_joined_status_equals_the_nested_one(spark):
    rng = random.Random(5)
    records = []
    for q in range(600):
        items = [{"url": rng.choice(PIECES), "title": rng.choice(PIECES), "metadata": {"final_url": rng.choice(PIECES)}} for _ in range(rng.randrange(22))]
        records.append({"query_id": q, "status": rng.choice(["ok", "failed", "", None]), "error": rng.choice([None, "", "no access", "please sign", "boom"]),
                        "note": rng.choice([None, "", "verify", "late"]), "results": items or rng.choice([[], None])})
    text = spark.createDataFrame([(json.dumps(r),) for r in records], "v string")
    nested = text.select(F.from_json("v", schemas.QUERY_RECORD).alias("r")).select("r.*")
    tasks = nested.select("query_id", "status", "error", "note")
    flat = nested.select("query_id", F.posexplode("results").alias("seq", "i")).select(
        "query_id", "seq", "i.url", "i.title", F.col("i.metadata.final_url").alias("final_url"))
    pick = lambda df: sorted(map(tuple, df.select("query_id", "inferred_status", "status_detail").collect()))
    want = pick(HL.infer_record_status(nested))
    assert 100 < sum(w[1] == "blocked" for w in want) < 500
    assert pick(HL.infer_joined_status(tasks, flat)) == want
    assert pick(HL.infer_joined_status(tasks, flat, chunk_rows=2)) == want
    apart = pick(HL.infer_query_status(tasks, flat))
    assert sum(a != w for a, w in zip(apart, want, strict=True)) > 10  # what lies across joints matters here
    assert pick(HL.infer_joined_status(tasks, flat.where("false"))) == pick(HL.infer_query_status(tasks, flat.where("false")))


@pytest.mark.parametrize("node, given, want", [
    ('{"@type":"Organization","name":"A","n":1,"deep":{"x":[1,null,"\\u00e9"]},"title":"own"}', {"title": None, "emails": ["a@b.c"]},
     {"@type": "Organization", "name": "A", "n": 1, "deep": {"x": [1, None, "é"]}, "title": None, "emails": ["a@b.c"]}),
    (None, {"title": "T"}, {"title": "T"}),
    ("{}", {"title": "T"}, {"title": "T"}),
    ('{"a":1,"b":2,"a":3}', {"title": "T"}, {"a": 3, "b": 2, "title": "T"}),
    ('{"a":true,"b":2.5,"c":[]}', {}, {"a": True, "b": 2.5, "c": []}),
    ("no json", {"title": "T"}, {"title": "T"}),
])
def test_overlaid(spark, node, given, want):
    frame = spark.createDataFrame([(node, json.dumps(given))], "n string, g string")
    assert json.loads(frame.select(H.overlaid(F.col("n"), F.col("g"))).first()[0]) == want


HTML = """<title>Acme | Home</title><meta name="description" content="Ships"><script type="application/ld+json">
{"@type":"Organization","name":"Acme Ltd","founder":{"name":"Eve"},"title":"hidden"}</script><a href="/contact">c</a> a@acme.com"""


def test_raw_fields_and_evidence(spark):
    pages = spark.createDataFrame([(1, "h", "https://acme.com/", HTML), (2, "h", "https://b.com/", "<p>none</p>"), (3, "h", None, None)],
                                  "id long, host string, url string, html string")
    parsed = PG.parse_pages(pages).cache()
    one, two, three = (json.loads(r.raw_fields) for r in parsed.orderBy("id").collect())
    assert one["founder"] == {"name": "Eve"} and one["title"] == "Acme | Home" and one["emails"] == ["a@acme.com"]
    assert two["title"] is None and set(two) == set(three) == set(one) - {"@type", "name", "founder"}
    starter = [json.loads(r.raw_fields) for r in PG.parse_pages(pages, variant="starter").orderBy("id").collect()]
    assert starter[0]["title"] == "hidden" and set(starter[1]) == {"title", "description", "emails", "phones"}
    evidence = TB.evidence_rows(parsed, PG.OBSERVATION_FIELDS, PG.METADATA_FIELDS)
    observed = parsed.select(*PG.OBSERVATION_FIELDS)
    back = TB.observations_of_evidence(evidence, observed.schema)
    assert back.columns == ["evidence_object_key", *PG.OBSERVATION_FIELDS]
    assert sorted(map(str, back.drop("evidence_object_key").collect())) == sorted(map(str, observed.collect()))


def test_arrivals_in_a_table(spark, tmp_path):
    root = str(tmp_path / "seen")
    batches = [["a", "b", "a", None], ["b", "c", None], [], ["a", "d", "c"]]
    frames = [spark.createDataFrame([(k, f"{n}") for k in keys], "url_hash string, v string") for n, keys in enumerate(batches)]

    def state():
        return sorted(map(str, ST.stored_arrivals(spark, root, frames[0].schema).collect()))

    for n, frame in enumerate(frames):
        ST.arrivals_batch(frame, n, root, buckets=3)
        before = state()
        ST.arrivals_batch(frame, n, root, buckets=3)  # a batch that comes again changes nothing
        assert state() == before
    got = {(r.url_hash, r.batch) for r in ST.stored_arrivals(spark, root, frames[0].schema).collect()}
    assert got == {("a", 0), ("b", 0), (None, 0), ("c", 1), ("d", 3)} and len(state()) == 5
    ST.arrivals_batch(frames[1], 1, root, buckets=3)  # nor does an earlier one
    assert len(state()) == 5
    plan = ST.stored_arrivals(spark, root, frames[0].schema).where((F.col("batch") < 2) & F.col("bucket").isin([1]))
    assert "PartitionFilters: [isnotnull(batch" in plan._jdf.queryExecution().toString()
