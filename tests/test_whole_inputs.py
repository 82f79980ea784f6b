"""Nothing is cut short or misread: limits can be lifted, several files, strict structured data, keyed upsert."""

from pyspark.sql import functions as F

from firmloom.functions import html as H
from firmloom.operators import frontier as FR, pages as PG, signals as SG
from firmloom.operators.components import connected_components
from firmloom.sources import lists as L, tables as TB


def test_lines_are_stripped_and_files_follow_each_other(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\tone  \n \t\n two\n")
    (tmp_path / "b.txt").write_text("three\x0b\nfour\n")
    rows = L.read_queries(spark, str(tmp_path)).orderBy("query_id").collect()
    assert [tuple(r) for r in rows] == [(1, "one"), (3, "two"), (4, "three"), (5, "four")]
    assert sorted(r.url for r in L.read_seeds(spark, str(tmp_path)).collect()) == ["four", "one", "three", "two"]


def test_limits_can_be_lifted(spark):
    page = "".join(f'<a href="/p{i}">x</a> u{i}@site{i}.com ' for i in range(120))
    pages = spark.createDataFrame([(1, "https://h.com/", f"<html><body>{page}</body></html>", 0)], "page_id long, url string, html string, depth int")
    whole = PG.parse_pages(pages, max_links=None, max_emails=None)
    row = whole.first()
    assert len(row.discovered_links) == 120 and len(row.emails) == 120
    links = FR.explode_links(whole.withColumn("depth", F.lit(0)), "discovered_links", "page_id", max_links=None)
    assert links.count() == 120
    assert len(PG.parse_pages(pages).first().discovered_links) == 50


def test_structured_data_is_strict_and_same_as_holds_strings(evaluate):
    def page(text):
        return f'<script type="application/ld+json">{text}</script>'

    rows = [
        (page('{"@type": "Organization", "name": "A", "sameAs": ["https://x.com/a", 5, {"u": "z"}, null]}'),),
        (page('{"@type": "Organization", "name": "B", "sameAs": "https://x.com/b"}'),),
        (page('{"@type": "Organization", "name": "C", "sameAs": 5}'),),
        (page("{'@type': 'Organization', 'name': 'D'}"),),
    ]
    got = evaluate(rows, "html string", c=H.company_from_node(H.json_ld_company_text(F.col("html"))))
    assert [(c.company_name, list(c.social_links or [])) for c in got] == [("A", ["https://x.com/a"]), ("B", ["https://x.com/b"]), ("C", []), (None, [])]


def test_deep_graphs_are_opened(evaluate):
    node = '{"@type": "Organization", "name": "Deep"}'
    for _ in range(6):
        node = f'{{"@graph": [{node}]}}'
    assert any("Deep" in n for n in evaluate([(node,)], "node string", n=SG.company_nodes(F.array("node"))) [0])
    for _ in range(34):
        node = f'{{"x": 1, "@graph": [{{"y": 2}}, {node}]}}'
    assert evaluate([(node,), ('{"a": 1}',), (None,)], "node string", n=F.size(SG.company_nodes(F.array("node")))) == [1, 0, 0]


def test_upsert_with_ties_and_null_keys(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    incoming = spark.createDataFrame([("b", 5, 1), ("b", 6, 2), (None, 7, 1), ("c", 8, 1)], "k string, v int, o int")
    got = TB.upsert(current, incoming, "k", ["o"]).collect()
    assert sorted((str(r.k), r.v) for r in got) == [("None", 7), ("a", 1), ("b", 6), ("c", 8)]


def test_components_over_any_number_of_partitions(spark):
    pairs = [(i, i + 1) for i in range(60) if i % 20 != 19] + [(99, None)]
    for parts in (1, 7):
        df = spark.createDataFrame(pairs, "a long, b long").repartition(parts)
        got = {r.node: r.component for r in connected_components(df).collect()}
        assert got == {**{i: i - i % 20 for i in range(60)}, 99: 99}
