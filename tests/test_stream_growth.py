"""The resolve stage does no step once per link, or in one task per million documents, that could be done less often."""

from pyspark.sql import functions as F
from test_tables_and_streams import now, staged  # noqa: F401

from firmloom import schemas
from firmloom.functions import html as H
from firmloom.operators import frontier as FR
from firmloom.sources import tables as TB
from firmloom.streaming import stages as ST


def test_links_that_pages_repeat_are_taken_apart_once(spark, monkeypatch):
    urls = ["https://A.com/x/", "https://a.com/x?utm_source=n", "https://a.com/y", None]
    rows = [(i, i % 3, i % 7, urls[i % 4]) for i in range(400, 0, -1)] + [(3, 9, 0, "https://a.com/x")]
    links = spark.createDataFrame(rows, "position long, depth int, link_no int, url string")
    old = spark.createDataFrame([], schemas.URLS)
    columns = ["id", "url_hash", "canonical_url", "depth", "source_type", "priority"]
    want = FR.insert_if_absent(old, FR.discovered_rows(links), now(), "position", ("link_no",))[1].select(columns).collect()
    seen, build = [], FR.discovered_rows
    monkeypatch.setattr(FR, "discovered_rows", lambda rows, **more: seen.append(rows.count()) or build(rows, **more))
    got = FR.add_discovered_urls(old, links, now())[1].select(columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 3
    assert seen == [5]


def test_documents_are_numbered_in_small_chunks(spark, tmp_path, staged, monkeypatch):  # noqa: F811
    source, store = staged
    documents = ST.parse_stage(ST.decode_messages(spark.read.text(str(source)), schemas.FETCH_EVENT), store).cache()
    chunks, number = [], ST.number_rows
    monkeypatch.setattr(ST, "number_rows", lambda *args, **more: chunks.append(more.get("chunk_rows", 1_000_000)) or number(*args, **more))

    def ids(name):
        where = ST.Store(str(tmp_path / name))
        ST.resolve_batch(documents, 0, where, now())
        return sorted(map(tuple, TB.read_snapshot(spark, where.path("observations"), ST._observed_schema()).select("id", "source_url").collect()))

    whole = ids("whole")
    assert chunks and max(chunks) <= 100_000
    monkeypatch.setattr(ST, "CHUNK_DOCUMENTS", 5)
    assert ids("cut") == whole and [i for i, _ in whole] == list(range(1, 13))


def test_hidden_markup_is_what_it_was(evaluate):
    texts = [
        "a<!-- b --><p>c</p><!-->d-->e", "<SCRIPT x='>'>y</Script >z<style>q", "<scripts>k</scripts><script/>t</script>u", "<!- n ->< !-- m -->",
        "<<!--a--><<script>\n</style></script\n>v<!-- open", "", "<style media=a>b</style><STYLE>c</STYLE>d<",
    ]
    old = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
    rows = [(t,) for t in texts]
    assert evaluate(rows, "html string", a=H.without_hidden_markup(F.col("html"))) == evaluate(rows, "html string", a=F.regexp_replace("html", old, " "))


def test_a_table_without_versions_is_joined_without_a_shuffle(spark, tmp_path):
    none = TB.read_snapshot(spark, str(tmp_path / "none"), schemas.URLS)
    assert none.schema == schemas.URLS and none.count() == 0 and none.agg(F.max("id")).first()[0] is None
    rows = spark.range(100).select(F.col("id").cast("string").alias("url_hash"))
    fresh = FR.absent_rows(none, rows, "url_hash")
    assert fresh.count() == 100
    assert "Join" not in fresh._jdf.queryExecution().optimizedPlan().toString()
