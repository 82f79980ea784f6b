"""Work and memory that must not grow faster than the input."""

import pyarrow as pa
from pyspark.sql import functions as F

from firmloom.operators import components as CC, profiles as PR, signals as SG
from firmloom.plans import fixtures as fx
from test_larger_inputs import SF_DIR, pytestmark  # noqa: F401


def test_stars_take_no_part_in_later_rounds(spark, monkeypatch):
    path = [(i, i + 1) for i in range(200)]
    pairs = [(1000 + i - i % 4, 1000 + i) for i in range(400)] + path
    seen, step = [], CC._large_star
    monkeypatch.setattr(CC, "_large_star", lambda edges, hot: seen.append(edges.count()) or step(edges, hot))
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = dict(CC.connected_components(edges, chunk_edges=60).collect())
    assert got == {n: 0 for n in range(201)} | {1000 + i: 1000 + i - i % 4 for i in range(400)}
    assert len(seen) > 1 and max(seen[1:]) <= len(path)


def test_values_of_profiles_are_hashed_not_sorted(spark):
    rows = [(1, 3, ["b", "a", "b"]), (1, 1 << 40, ["b", "c"]), (1, 2, ["x", "a", "a"]), (2, 5, ["a"])]
    facts = spark.createDataFrame(rows, "query_id long, pos long, emails array<string>").select(
        "*", *[F.lit(None).cast("array<string>").alias(c) for c in ("phones", "social_profiles", "locations")],
        F.lit("u").alias("final"), F.lit("").alias("domain"),
    ).fillna("").withColumns({c: F.array().cast("array<string>") for c in ("phones", "social_profiles", "locations")})
    values = PR.profile_values(facts)
    got = {tuple(r) for r in values.where("field = 'emails'").drop("field").collect()}
    assert got == {(1, "x", 2, 0), (1, "a", 2, 1), (1, "b", 3, 0), (1, "c", 1 << 40, 1), (2, "a", 5, 0)}
    assert "SortAggregate" not in values._jdf.queryExecution().executedPlan().toString()


def test_results_are_numbered_before_their_texts(spark):
    plan = fx.results(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "@acme.com" in plan and "@acme.com" not in plan[plan.index("Window"):]


def test_blocks_are_read_in_small_slices_of_the_same_buffers():
    html = ["<footer>f <b>x</b></footer><nav class='navbar-brand'>B</nav>", None, "<p>no</p>"] * 100
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(html)], ["page_id", "html"])
    out = list(SG._with_blocks(iter([batch]), "html", 20))
    assert max(b.num_rows for b in out) <= SG.SLICE_PAGES and sum(b.num_rows for b in out) == 300
    assert {b.column(1).buffers()[2].address for b in out} == {batch.column(1).buffers()[2].address}
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["focused_text_blocks"] for r in rows] == [["f x"], [], []] * 100
    assert [r["nav_brand"] for r in rows] == ["B", None, None] * 100
