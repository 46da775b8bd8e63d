"""Every registered collection query against its SQL in DuckDB, on the smallest test tables."""

import math
import os

import duckdb
import pytest

from civicdocs.plans.queries import QUERIES, SQL, flagship
from civicdocs.plans.standins import ctes

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def compare(spark, duck, frame, sql):
    columns = sorted(frame.columns)
    got = sorted(tuple(map(plain, r)) for r in frame.select(*columns).collect())
    cursor = duck.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, QUERIES[name](spark, DATA), SQL[name])


def test_flagship(spark):
    counts = flagship(spark, DATA).collect()
    leaves = sum(r.pdfs for r in counts if r.level == 0)
    assert leaves == sum(r.pdfs for r in counts if r.level == 1) == next(r.pdfs for r in counts if r.level == 3)


def test_scans_are_narrow(spark):
    """Only the columns that a query needs are read, and filters reach the scan."""
    plan = lambda name: QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan("harvest_manifest") and "l_tax" not in plan("pdf_count_rollup")
    assert "PushedFilters: [" in plan("book_chapters")
    for name in ("notice_rows", "assign_pages", "page_envelope", "apply_changes", "latest_by_id", "first_by_dest"):
        assert "Window" not in plan(name)


def test_upload_time_of_every_section(spark, duck):
    """Names without a 13-digit number are sections too; theirs is null."""
    whole = ctes("section") + r" SELECT chapter_id, section_id, epoch_ms(CAST(NULLIF(regexp_extract(pdfName, '_(\d{13})\.', 1), '') AS BIGINT)) AS uploaded FROM section"
    got = QUERIES["upload_time"](spark, DATA)
    assert got.count() == spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    compare(spark, duck, got, whole)


@pytest.mark.parametrize("name, cut", [("stream_harvest", "c.book_id % 4 = 0 AND "), ("chapter_wise_content", " WHERE l_linenumber > 2")])
def test_no_commission_or_section_is_left_out(spark, duck, name, cut):
    compare(spark, duck, QUERIES[name](spark, DATA), SQL[name].replace(cut, ""))
