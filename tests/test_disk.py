"""What queries leave on disk while they run: exports, intermediate tables and shuffle files."""

import gzip
import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civicdocs.operators import hierarchy as H
from civicdocs.operators import manifest as M
from civicdocs.plans import queries as Q
from civicdocs.sources import listing as L
from civicdocs.sources import readers as R
from civicdocs.sources.storage import passing, shared_dir, stored
from civicdocs.streaming.incremental import incremental_harvest

DATA = "/root/testdata/sf0.001"
with_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(found.size()) if (f := found.apply(i).getName()).startswith("shuffle_")}


def below(spark, name):
    root = Path(shared_dir(spark).removeprefix("file:"))
    return sorted(p.name for p in root.glob(f"{name}*"))


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids")))
    assert not shuffle_files(spark) - before and kept.count() == 7


def test_passing_tables_go(spark):
    with passing(spark.range(5), "passing-test") as rows:
        assert rows.count() == 5 and len(below(spark, "passing-test")) == 1
    assert not below(spark, "passing-test")


def test_compressed_exports(spark, tmp_path):
    put = lambda name, value: (tmp_path / name).write_bytes(gzip.compress(json.dumps(value).encode()))
    put("chapters-commission-4.json.gz", [{"id": 1, "sections": [{"id": 2}]}])
    put("volumes-commission-5.json.gz", [{"id": 6, "chapters": [{"id": 7}]}])
    assert [(r.book_id, r.id) for r in R.read_volumes(spark, str(tmp_path)).collect()] == [(5, 6)]
    assert {(r.book_id, r.id) for r in R.read_chapters(spark, str(tmp_path)).collect()} == {(4, 1), (5, 6)}
    assert {(r.book_id, r.volume_id, r.id) for r in L.listed_chapters(L.export_files(spark, str(tmp_path))).collect()} == {(4, None, 1), (5, 6, 7)}


@with_tables
@pytest.mark.parametrize("name", ["read_volumes", "read_volume_trees"])
def test_exports_are_small(spark, monkeypatch, name):
    """The files are compressed, in all rounds alike, and nothing else stays."""
    monkeypatch.setattr(Q, "FILE_ROWS", 5)
    before = set(below(spark, "volume"))
    n = Q.QUERIES[name](spark, DATA).count()
    path = Path(shared_dir(spark).removeprefix("file:")) / next(iter(set(below(spark, "volume")) - before))
    files = [p for p in path.rglob("*") if p.is_file() and p.suffix != ".crc" and p.name != "_SUCCESS"]
    assert len(files) > 64 and all(p.name.endswith(".json.gz") for p in files)
    assert sum(len(json.loads(gzip.decompress(p.read_bytes()))) for p in files) == n == spark.read.parquet(f"{DATA}/orders.parquet").select("o_custkey", "o_orderpriority").distinct().count()
    assert not below(spark, "listing")


def test_sections_are_chosen_before_they_move(spark):
    """Only sections with a PDF are dealt by commission, one row each, and without contents."""
    books = spark.createDataFrame([(2, "Health", 1, True)], "id long, name string, serial int, hasVolume boolean")
    text = json.dumps([{"id": 9, "book": {"id": 2}, "sections": [{"id": 1, "name": "n", "hasPdf": True, "pdfName": "1_2.pdf", "paragraphs": [{"id": 3}]}]}])
    files = spark.createDataFrame([("x", "volumes-commission-2.json", '[{"id": 7, "name": "V", "chapters": ' + text + "}]"), ("y", "y.json", text)], "file_path string, file_name string, text string")
    m = M.listed_manifest(books, L.listed_chapters(files))
    assert [(r.section_id, r.dest) for r in m.collect()] == [(1, "01-Health/V/1_n.pdf")]
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    above, _, below_it = plan.partition("LeftSemi")
    assert "posexplode" not in above and below_it.count("posexplode(sections") == 2 and "chapter_title" not in below_it.split("posexplode")[0]
    assert set(H.LISTED) - {"book_pos"} <= set(m.columns)


def test_tree_is_dealt_once(spark):
    """Paths stay behind when they have been sorted, and nodes that share one count each other, also across batches and partitions."""
    rnd = random.Random(4)
    paths = sorted({p[:k] for p in (tuple((rnd.randrange(3), rnd.randrange(4)) for _ in range(rnd.randint(1, 4))) for _ in range(300)) for k in range(1, len(p) + 1)})
    paths = sorted([*paths, *rnd.choices(paths, k=40)])
    nodes = spark.createDataFrame([(i, [*p]) for i, p in enumerate(paths)], "k int, path array<struct<serial:int,id:bigint>>")
    size = {p: sum(x[: len(p)] == p for x in paths) for p in paths}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        got = H.preorder(nodes, "k")
        assert got.columns == ["k", "rn", "subtree_end"]
        assert sorted((r.rn, paths[r.k], r.subtree_end) for r in got.collect()) == [(i + 1, p, i + size[p]) for i, p in enumerate(paths)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    parts = H.preorder([nodes.filter("k % 3 = 0"), nodes.filter("k % 3 > 0").select("path", "k")], "k")
    assert sorted((r.rn, paths[r.k], r.subtree_end) for r in parts.collect()) == [(i + 1, p, i + size[p]) for i, p in enumerate(paths)] and not below(spark, "nodes")
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_harvest_leaves_only_its_table(spark, tmp_path):
    books = spark.createDataFrame([(2, "Health", 1)], "id long, name string, serial int")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([{"id": 9, "book": {"id": 2}, "sections": [{"id": 1, "name": "n", "hasPdf": True, "pdfName": "1_2.pdf"}]}]))
    incremental_harvest(spark, str(tmp_path / "in"), books, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1 and not below(spark, "harvested")
