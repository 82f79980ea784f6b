"""What only larger or differently laid out tables show: letters beyond ASCII at the ends of words, tables of many files."""

import os

import pytest
from compare import TABLES, differences, duck
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from firmloom.functions import html as H

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables are not here")


@pytest.fixture
def tables(spark, tmp_path):
    """The shared tables, with pages of one's own in ``pages.parquet``, a folder."""

    def run(pages, files=1):
        for name in TABLES:
            if name != "pages":
                (tmp_path / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
        pages.repartition(files).write.parquet(str(tmp_path / "pages.parquet"))
        con = duck(SF_DIR)
        con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        return str(tmp_path), con

    return run


_TEXTS = [
    "130 Tzlichber die stärke", "0114 die schge ieheitst chpfbe erkeitstück", "12 Ober der Straße", "7 Some Long Parkſ",
    "9 hohe LindenparK", "éa@b.com ü.b@c.deä", "+49 30 1234567 890", "١٢ Some Long Road", "1 Old Mill Road",
]


@pytest.mark.parametrize("name", ["page_contacts", "parse_pages", "parse_pages_starter", "raw_fields", "evidence_observations"])
def test_words_that_end_at_letters_beyond_ascii(spark, tables, name):
    rows = [(i, f"https://h{i}.example.com/contact", f"<html><title>T</title><p>{t}.</p></html>") for i, t in enumerate(_TEXTS)]
    sf_dir, con = tables(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) is None


def test_words_of_any_script_are_the_default(evaluate):
    got = evaluate([(t,) for t in _TEXTS[:2]], "html string", a=H.page_addresses(F.col("html")))
    assert got == [[], ["0114 die schge ieheitst"]]


@pytest.mark.parametrize("name", ["stream_fetch_events", "stream_parse"])
def test_streams_read_tables_of_many_files(spark, tables, name):
    sf_dir, con = tables(spark.read.parquet(f"{SF_DIR}/pages.parquet"), files=3)
    assert differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) is None
