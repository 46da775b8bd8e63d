"""Readers, hierarchy, manifest, board, texts, labels, changes and streams on small hand-written collections."""

import json
import random

import pytest
from pyspark.sql import functions as F

from civicdocs.operators import changes as C
from civicdocs.operators import hierarchy as H
from civicdocs.operators import manifest as M
from civicdocs.operators import numbering as N
from civicdocs.operators import texts as S
from civicdocs.operators import versions
from civicdocs.sources import listing as L
from civicdocs.sources import readers as R
from civicdocs.sources.schemas import BOOK
from civicdocs.sources.writers import read_manifest, write_manifest
from civicdocs.streaming import incremental

BOOKS = [
    {"id": 1, "name": "Police", "nameBangla": "পুলিশ", "serial": 2, "hasVolume": True, "summaryFileName": "1_1.pdf", "summaryEn": ""},
    {"id": 2, "name": "Health", "nameBangla": "", "serial": 1, "hasVolume": None, "pdfName": "2_1.pdf", "summaryEn": "2_2.pdf"},
    {"id": 3, "name": "Media", "serial": None, "summaryFileName": " "},
]
PARAGRAPHS = [
    {"id": 12, "serial": 2, "content": "second\nline", "header": ""}, {"id": 11, "serial": 1, "content": "first", "header": "Intro", "indexChar": "ক"},
    {"id": 13, "serial": None, "content": None, "header": "Only header"}, {"id": 14, "serial": 2, "content": "tie", "hasImage": True, "fileName": "p.png"},
    {"id": 15, "serial": 3, "content": "no file", "hasImage": True, "fileName": None},
]
CHAPTERS = [
    {"id": 21, "serial": 1, "title": "", "chapterName": "One", "book": {"id": 2}, "sections": [
        {"id": 31, "serial": 2, "name": "Same", "hasPdf": True, "pdfName": "77_1750000000000.pdf"}, {"id": 32, "serial": 2, "name": "Same", "hasPdf": True, "pdfName": "77_1750000000001.pdf"},
        {"id": 33, "serial": 1, "name": "No pdf", "hasPdf": True, "pdfName": ""}, {"id": 34, "serial": 3, "name": "Text", "hasPdf": False, "paragraphs": PARAGRAPHS},
    ]},
    {"id": 22, "serial": 1, "title": "Two", "book": {"id": 2}, "sections": []}, {"id": 20, "serial": None, "title": "Zero", "book": {"id": 2}},
]
VOLUMES = [{"id": 41, "serial": 1, "name": "Vol/A ", "nameBangla": "খণ্ড", "book": {"id": 1}, "chapters": [{"id": 23, "serial": 1, "title": "V", "sections": [{"id": 35, "serial": 1, "name": "In volume", "hasPdf": True, "pdfName": "5_1750000000002.pdf"}]}]}, {"id": 42, "serial": 2, "name": "Empty", "book": {"id": 1}, "chapters": []}]


@pytest.fixture(scope="module")
def collection(tmp_path_factory):
    root = tmp_path_factory.mktemp("collection")
    put = lambda name, value: ((root / name).parent.mkdir(parents=True, exist_ok=True), (root / name).write_text(value if isinstance(value, str) else json.dumps(value)))
    put("books.json", BOOKS)
    put("chapters/chapters-commission-2.json", CHAPTERS)
    put("volumes/volume-wise-commission-1.json", VOLUMES)
    notices = [{"id": i, "title": f"n{i}", "serial": s, "publishDate": "05-06-2025"} for i, s in ((1, 11), (13, 11), (2, 3), (5, 20))]
    put("notices/notices-page1.json", {"content": notices[:2], "number": 0, "totalPages": 2, "totalElements": 4, "sort": {"sorted": True}})
    put("notices/notices-page2.json", {"content": notices[2:], "number": 1, "totalPages": 2, "totalElements": 4})
    put("i18n/en/global.json", '{"global": {"menu": {"home": "Home", "home": "Start", "a.b": "dot"}, "n": null, "deep": {"a": {"b": {"c": "x"}}}}}')
    put("i18n/bn/global.json", '{"global": {"menu": {"home": "হোম"}}}')
    put("broken/a.json", '[{"id": 1, "na')
    put("broken/b.json", [{"id": 9, "name": "good"}])
    put("pdfs/x/a.pdf", "12345")
    put("pdfs/b.txt", "1")
    return root


def sections_of(spark, collection):
    direct = R.read_chapters(spark, str(collection / "chapters")).select("book_id", "id", "serial", "title", "nameBangla", "chapterName", "sections")
    volumes = H.flatten_volumes(R.read_volume_trees(spark, str(collection / "volumes")))
    books = R.read_books(spark, str(collection / "books.json"))
    return books, H.branches(books, direct, volumes), R.read_volumes(spark, str(collection / "volumes"))


def test_readers(spark, collection):
    books = {r.id: r for r in R.read_books(spark, str(collection / "books.json")).collect()}
    assert len(books) == 3 and books[2].hasVolume is None and books[1].summaryEn == "" and books[3].serial is None
    assert {(r.book_id, r.id) for r in R.read_chapters(spark, str(collection / "chapters")).collect()} == {(2, 20), (2, 21), (2, 22)}
    assert [r.number for r in R.read_notices(spark, str(collection / "notices")).orderBy("id").collect()] == [0, 1, 1, 0]
    good, bad = R.split_bad(R.read_books(spark, str(collection / "broken"), corrupt=True).cache())
    assert [r.id for r in good.collect()] == [9] and bad.count() == 1
    files = R.list_attachments(spark, str(collection / "pdfs")).collect()
    assert [(r.file_name, r.length) for r in files] == [("a.pdf", 5)]


def test_labels(spark, collection):
    labels = R.read_labels(spark, str(collection / "i18n"))
    got = {(r.lang, r.key): r.value for r in labels.collect()}
    assert got == {("en", "global.menu.home"): "Start", ("en", "global.menu.a.b"): "dot", ("en", "global.n"): None, ("en", "global.deep.a.b.c"): "x", ("bn", "global.menu.home"): "হোম"}
    assert ["global", "menu", "a.b"] in [r.path for r in labels.collect()]
    parity = {r.key: r.status for r in S.label_parity(labels).collect()}
    assert parity["global.menu.home"] == "different" and parity["global.n"] == "en-only"
    wanted = spark.createDataFrame([("en", "global.menu.home", "d"), ("en", "none", "d"), ("bn", "none", None), ("en", "global.n", None)], "lang string, key string, default string")
    assert sorted(r.value for r in S.label_lookup(wanted, labels).collect()) == ["", "", "Start", "d"]
    assert R.flatten_json(spark.createDataFrame([("xx", "{broken"), ("xx", None)], "lang string, text string")).count() == 0


def test_manifest(spark, collection, tmp_path):
    books, chapters, volumes = sections_of(spark, collection)
    flat = H.flatten_chapters(chapters).drop("paragraphs")
    m = M.manifest(books, flat, volumes).cache()
    assert sorted((r.section_id, r.dest) for r in m.collect()) == [(31, "01-Health/77_Same.pdf"), (32, "01-Health/77_Same.pdf"), (35, "02-Police/Vol-A/5_In volume.pdf")]
    assert len({r.dest_unique for r in m.collect()}) == 3
    assert sorted(map(tuple, M.collisions(m).collect())) == [("01-Health/77_Same.pdf", 2, f"77_175000000000{i}.pdf", 1) for i in (0, 1)]
    assert {r.section_id for r in M.first_by_dest(m, "book_id", "section_id").collect()} == {31, 35}
    done = spark.createDataFrame([("01-Health/77_Same.pdf",)], "dest string")
    left = M.pending(m, done)
    assert [r.section_id for r in left.collect()] == [35] and left.count() + m.join(done, "dest", "left_semi").count() == m.count()
    counts = {(r.book_id, r.volume_id, r.level): r.pdfs for r in M.pdf_counts(m).collect()}
    assert counts == {(2, None, 0): 2, (2, None, 1): 2, (1, 41, 0): 1, (1, None, 1): 1, (None, None, 3): 3}
    write_manifest(m, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 3 and (tmp_path / "m" / "commission_dir=02-Police" / "volume_dir=Vol-A").is_dir()
    ids = chapters.select("book_id")
    assert [r.id for r in H.missing_payload(books, ids).collect()] == [3]


def test_reconcile(spark):
    refs = spark.createDataFrame([("a",), ("a",), ("b",)], "file_name string")
    files = spark.createDataFrame([("a", 5), ("c", 7)], "file_name string, length long")
    got = M.reconcile(refs, files)
    assert sorted((r.file_name, r.length, r.status) for r in got.collect()) == [("a", 5, "ok"), ("b", None, "missing"), ("c", 7, "orphan")]
    report = {r.status: (r.files, r.bytes) for r in M.fetch_report(got.withColumn("owner", F.lit("x")), "owner").collect()}
    assert report == {"ok": (1, 5), "missing": (1, 0), "orphan": (1, 7)}
    assert M.corpus_card(refs, refs).first().pdfs == 2 and M.corpus_card(refs, refs, approximate=True).first().commissions == 3


def test_tree(spark, collection):
    _, chapters, _ = sections_of(spark, collection)
    c = chapters.withColumnRenamed("id", "chapter_id")
    s = H.flatten_chapters(chapters).withColumnRenamed("section_id", "id")
    tree = {r.book_id: r.tree for r in H.nest_tree(c, s).collect()}
    assert [(x.id, x.label, [(y.id, y.kind) for y in x.sections]) for x in tree[2]] == [(20, "Zero", []), (21, "One", [(33, "text"), (31, "pdf"), (32, "pdf"), (34, "text")]), (22, "Two", [])]
    in_place = H.sort_nested(R.read_chapters(spark, "file://" + str(collection / "chapters"))).filter("id = 21").first()
    assert [x.id for x in in_place.sections] == [33, 31, 32, 34] and [p.id for p in in_place.sections[3].paragraphs] == [13, 11, 12, 14, 15]
    positions = H.tree_order(s, ["chapter_id"], ["serial", "id"]).filter("chapter_id = 21").collect()
    assert {r.id: r.position for r in positions} == {33: 1, 31: 2, 32: 3, 34: 4} and {tuple(r.path[0]) for r in positions} == {(1, 33), (2, 31), (2, 32), (3, 34)}
    volumes = R.read_volumes(spark, str(collection / "volumes"))
    whole = {r.book_id: r.tree for r in H.nest_volumes(c, s, volumes).collect()}
    assert [(v.id, v.label, [x.id for x in v.chapters]) for v in whole[1]] == [(41, "খণ্ড", [23]), (42, "Empty", [])]
    assert [(v.id, [x.id for x in v.chapters]) for v in whole[2]] == [(None, [20, 21, 22])]
    assert {r.owner_id for r in H.attachment_refs(R.read_books(spark, str(collection / "books.json")), "book", ["pdfName", "summaryFileName", "summaryEn"]).collect()} == {1, 2, 3}
    assert H.book_chapters(R.read_books(spark, str(collection / "books.json")), c.select("book_id", "chapter_id")).count() == 5


def test_texts(spark, collection):
    _, chapters, _ = sections_of(spark, collection)
    p = H.flatten_paragraphs(H.flatten_chapters(chapters))
    bodies = S.assemble_sections(p)
    row = bodies.first()
    assert row.body.split("\n") == ["Only header", "Intro|ক|first", "second<br>line", "tie|/pdfs/attachment/p.png", "no file"] and row.n_paragraphs == 5
    assert S.assemble_sections(p, header=False).first().body.startswith("\nক|first")
    looked = S.section_body_lookup(spark.createDataFrame([(34,), (99,)], "section_id long"), bodies)
    assert {r.section_id: r.found for r in looked.collect()} == {34: True, 99: False}
    assert S.oversized_sections(bodies, 10).count() == 1
    assert S.lookup_one(p, "12").count() == 1


def test_summary(spark, collection):
    books = R.read_books(spark, str(collection / "books.json"))
    assert [(r.rn, r.id, r.name, r.summary_en) for r in S.summary_rows(books).orderBy("rn").collect()] == [(1, 3, "Media", ""), (2, 2, "Health", "/pdfs/attachment/2_2.pdf"), (3, 1, "পুলিশ", "")]
    assert tuple(S.summary_coverage(books).first()) == (3, 2, 1, 0, 0)


def test_board(spark):
    rows = spark.createDataFrame([(i, (i * 7) % 5) for i in range(1, 48)], "id long, serial int")
    order = (F.desc("serial"), F.desc("id"))
    want = sorted(range(1, 48), key=lambda i: (-((i * 7) % 5), -i))
    numbered = N.global_index(rows, *order, partitions=7).cache()
    assert [r.id for r in numbered.orderBy("rn").collect()] == want and [r.rn for r in numbered.orderBy("rn").collect()] == list(range(1, 48))
    pages = N.page_envelopes(numbered, 10).orderBy("page").collect()
    assert [(p.number_of_elements, p.first, p.last, p.has_prev, p.has_next) for p in pages] == [(10, True, False, False, True)] + [(10, False, False, True, True)] * 3 + [(7, False, True, True, False)]
    assert sum(p.number_of_elements for p in pages) == pages[0].total_elements == 47
    assert [r.id for r in N.page_slice(rows, 1, 10, *order).collect()] == want[:10] and [r.id for r in N.page_slice(rows, 3, 10, *order).collect()] == want[20:30]
    assert N.global_index(rows.limit(0), *order).count() == 0


def test_ties_on_a_page_border(spark):
    rows = spark.createDataFrame([(1, 11), (13, 11)], "id long, serial int")
    assert [r.id for r in N.global_index(rows, F.desc("serial"), F.desc("id")).orderBy("rn").collect()] == [13, 1]
    assert [r.id for r in N.global_index(rows, F.desc("serial"), F.asc("id")).orderBy("rn").collect()] == [1, 13]


def test_changes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    ddl = "id long, seq int, op string, payload struct<v:string>"
    rows = [(1, 1, "delete", None), (1, 2, "update", ("a2",)), (2, 1, "update", ("b2",)), (2, 2, "delete", None), (4, 1, "save", ("d",)), (9, 1, "delete", None), (3, 1, None, ("c2",))]
    batch = spark.createDataFrame(rows, ddl)
    once = C.apply_changes(base, batch)
    assert sorted(map(tuple, once.collect())) == [(1, "a2"), (3, "c2"), (4, "d")]
    assert sorted(map(tuple, C.apply_changes(once, batch).collect())) == sorted(map(tuple, once.collect()))


def test_serials_and_batches(spark):
    old = spark.createDataFrame([(1, 5), (1, 7), (2, None)], "p long, serial int")
    assert {r.p: r.next_serial for r in C.max_serials(old, "p").collect()} == {1: 8, 2: 1}
    new = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "p long, t string")
    assert sorted((r.p, r.t, r.serial) for r in C.next_serials(new, old, "p", "t").collect()) == [(1, "x", 8), (1, "y", 9), (3, "z", 1)]
    batch = spark.createDataFrame([(1, [("o0", True), ("o1", False), ("o2", True)], ["f0", "f1"])], "id long, objects array<struct<n:string,hasImage:boolean>>, files array<string>")
    assert [(r.n, r.fileName) for r in C.zip_attachments(batch).orderBy("pos").collect()] == [("o0", "f0"), ("o1", None), ("o2", None)]
    assert C.remove_at(batch, "files", F.lit(0)).first().files == ["f1"] and C.remove_at(batch, "files", F.lit(9)).first().files == ["f0", "f1"] == C.remove_at(batch, "files", F.lit(None).cast("int")).first().files
    good, bad = C.validate(old, {"serial": F.col("serial").isNotNull()})
    assert good.count() == 2 and bad.first().violations == ["serial"]
    stamped = C.stamp_parent(new.withColumnRenamed("p", "batch"), spark.createDataFrame([(1, 100)], "batch long, parent long"), "batch", "parent")
    assert {r.parent for r in stamped.collect()} == {100} and stamped.count() == 2


def test_random_trees_flatten_back(spark):
    """Nesting and flattening again gives every section once, in sibling order."""
    rnd = random.Random(5)
    rows = [(c, i, rnd.choice([None, 1, 1, 2, 3]), rnd.choice([None, "", "n"]), rnd.choice([True, False, None]), rnd.choice([None, "", "p"])) for c in range(20) for i in range(rnd.randint(1, 9))]
    s = spark.createDataFrame(rows, "chapter_id long, id long, serial int, name string, hasPdf boolean, pdfName string")
    for r in H.nest_sections(s).collect():
        want = sorted((x for x in rows if x[0] == r.chapter_id), key=lambda x: (x[2] or 0, x[1]))
        assert [(y.id, y.label, y.kind) for y in r.sections] == [(x[1], x[3] or "", "pdf" if x[4] and x[5] else "text") for x in want]


def test_stream_harvest(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "manifest")
    source.mkdir()
    books = spark.createDataFrame([(2, "Health", 1)], "id long, name string, serial int")
    (source / "a.json").write_text(json.dumps(CHAPTERS))
    run = lambda: incremental.incremental_harvest(spark, str(source), books, target, str(tmp_path / "ck")).awaitTermination()
    run()
    assert [r.section_id for r in spark.read.parquet(target).collect()] == [31]  # two sections want the same path
    more = [{"id": 29, "serial": 1, "title": "new", "book": {"id": 2}, "sections": [{"id": 39, "serial": 1, "name": "New", "hasPdf": True, "pdfName": "8_1750000000009.pdf"}, *CHAPTERS[0]["sections"]]}]
    (source / "b.json").write_text(json.dumps(more))
    run()
    assert {r.dest for r in spark.read.parquet(target).collect()} == {"01-Health/77_Same.pdf", "01-Health/8_New.pdf"}


def test_volume_files_and_names_in_a_stream(spark, tmp_path):
    """Both kinds of file in one stream; a file whose records name no commission belongs to the one in its name; a commission is taken from one branch only."""
    source, target = tmp_path / "in", str(tmp_path / "manifest")
    (source / "v").mkdir(parents=True)
    books = spark.createDataFrame([(1, "Police", 2, True), (2, "Health", 1, None), (7, "Media", 3, False)], "id long, name string, serial int, hasVolume boolean")
    nameless = [{k: v for k, v in c.items() if k != "book"} for c in CHAPTERS]
    (source / "chapters-commission-7.json").write_text(json.dumps(nameless))
    (source / "chapters-commission-1.json").write_text(json.dumps(nameless))  # has volumes: not taken from here
    (source / "broken.json").write_text('[{"id": 1')
    run = lambda: incremental.incremental_harvest(spark, str(source), books, target, str(tmp_path / "ck")).awaitTermination()
    run()
    assert [(r.book_id, r.dest) for r in spark.read.parquet(target).collect()] == [(7, "03-Media/77_Same.pdf")]
    (source / "v" / "volume-wise-commission-1.json").write_text(json.dumps([{k: v for k, v in x.items() if k != "book"} for x in VOLUMES]))
    (source / "v" / "volume-wise-commission-2.json").write_text(json.dumps(VOLUMES))  # has none
    run()
    run()
    assert {(r.book_id, r.volume_id, r.dest) for r in spark.read.parquet(target).collect()} == {(7, None, "03-Media/77_Same.pdf"), (1, 41, "02-Police/Vol-A/5_In volume.pdf")}


CHANGES = "id long, seq int, op string, payload struct<v:string,w:int>"


def test_versions_in_any_order(spark, tmp_path):
    """All orders of arrival lead to one state: the greatest seq of each id, deletions included."""
    rnd = random.Random(3)
    changes = [(rnd.randrange(9), i, rnd.choice(["save", "update", "delete", None]), (f"v{i}", i)) for i in range(60)] + [(None, 5, "save", ("none", 1)), (20, None, "save", ("weak", 1)), (3, 100, "delete", None), (21, None, "delete", None)]
    base = [(1, "a", 1), (20, "b", 2), (30, "c", 3), (21, "d", 4)]
    want = {i: (v, w) for i, v, w in base}
    for i, seq, op, payload in sorted(changes, key=lambda c: (c[1] is not None, c[1] or 0)):
        if op == "delete":
            want.pop(i, None)
        else:
            want[i] = payload if seq is not None else max(payload, want.get(i, payload))
    for k in range(3):
        rnd.shuffle(changes)
        path = str(tmp_path / f"t{k}")
        versions.create(spark.createDataFrame(base, "id long, v string, w int"), path, buckets=5, seq=F.lit(None).cast("int"))
        for at in range(0, len(changes), 25):
            versions.merge(spark.createDataFrame(changes[at : at + 25], CHANGES), path)
        assert {r.id: (r.v, r.w) for r in versions.read(spark, path).collect()} == want
        before = versions.merge(spark.createDataFrame(changes[:25], CHANGES), path)  # once more: nothing changes
        assert {r.id: (r.v, r.w) for r in versions.read(spark, path).collect()} == want
        assert versions.merge(spark.createDataFrame([], CHANGES), path) == before
        assert {r.id: (r.v, r.w) for r in versions.read(spark, path, version=0).collect()} == {i: (v, w) for i, v, w in base}
    assert {r.id for r in versions.read(spark, path, deleted=True).filter("deleted").collect()} >= {3, 21}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(spark.range(200).select("id", F.lit("a").alias("v"), F.lit(0).alias("w")), path, buckets=8)
    before = set(versions.read(spark, path).inputFiles())
    versions.merge(spark.createDataFrame([(5, 1, "update", ("b", 1)), (5, 2, "update", ("c", 1))], CHANGES), path)
    after = set(versions.read(spark, path).inputFiles())
    assert len(before - after) == len(after - before) == 1 and len(before & after) == len(before) - 1
    assert versions.read(spark, path).filter("id = 5").first().v == "c" and versions.read(spark, path).count() == 200
    empty = str(tmp_path / "e")
    versions.create(spark.range(0).select("id", F.lit("a").alias("v"), F.lit(0).alias("w")), empty)
    assert versions.read(spark, empty).count() == 0
    versions.merge(spark.createDataFrame([(5, 1, "save", ("b", 1))], CHANGES), empty)
    assert versions.read(spark, empty).first().v == "b"


def test_a_batch_that_failed_before_its_version_leaves_the_table(spark, tmp_path):
    """Data without a version is not seen, and the next batch writes over it."""
    path = str(tmp_path / "t")
    versions.create(spark.createDataFrame([(1, "a", 0)], "id long, v string, w int"), path, buckets=2)
    spark.createDataFrame([(1, 9, False, ("lost", 0), 0)], "id long, seq long, deleted boolean, payload struct<v:string,w:int>, bucket int").write.partitionBy("bucket").parquet(f"{path}/data/v=1")
    assert versions.read(spark, path).first().v == "a"
    versions.merge(spark.createDataFrame([(1, 1, "save", ("b", 0))], CHANGES), path)
    assert [r.v for r in versions.read(spark, path).collect()] == ["b"]


def test_stream_changes(spark, tmp_path):
    """seq 10 first, seq 5 in a later batch: the state says what 10 said."""
    source, path = tmp_path / "changes", str(tmp_path / "state")
    versions.create(spark.createDataFrame([(1, "a", 0)], "id long, v string, w int"), path, buckets=3, seq=F.lit(None).cast("int"))
    for rows in ([(1, 10, "update", ("new", 1)), (2, 3, "delete", None)], [(1, 5, "update", ("old", 1)), (2, 1, "save", ("late", 1)), (3, 1, "save", ("c", 1))]):
        spark.createDataFrame(rows, CHANGES).write.mode("append").json(str(source))
        incremental.stream_changes(spark.readStream.schema(CHANGES).json(str(source)), path, str(tmp_path / "ck2")).awaitTermination()
    assert sorted(map(tuple, versions.read(spark, path).collect())) == [(1, "new", 1), (3, "c", 1)]


def test_first_of_the_listing(spark, tmp_path):
    """Two sections with one path, listed against their serials: the first listed goes; volumes and chapters alike."""
    pdf = lambda i, serial, n: {"id": i, "serial": serial, "name": "Same", "hasPdf": True, "pdfName": f"77_{n}.pdf"}
    chapters = [{"id": 9, "serial": 5, "book": {"id": 2}, "sections": [pdf(32, 12, 2), pdf(31, 11, 1)]}, {"id": 8, "serial": 1, "book": {"id": 2}, "sections": [pdf(30, 1, 3)]}]
    volumes = [{"id": 51, "serial": 2, "name": "V", "book": {"id": 1}, "chapters": [{"id": 4, "serial": 1, "sections": [pdf(41, 9, 4)]}]}, {"id": 50, "serial": 1, "name": "V", "book": {"id": 1}, "chapters": [{"id": 3, "serial": 1, "sections": [pdf(40, 1, 5)]}]}]
    (tmp_path / "x.json").write_text(json.dumps(chapters))
    (tmp_path / "volumes-commission-1.json").write_text(json.dumps(volumes))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "books.json").write_text(json.dumps(BOOKS[::-1]))
    books = L.listed_books(L.export_files(spark, str(tmp_path / "b")))
    assert {r.id: r.book_pos for r in books.collect()} == {3: 0, 2: 1, 1: 2}
    c = L.listed_chapters(L.export_files(spark, str(tmp_path), glob="[xv]*.json"))
    chosen = H.branches(books, c.filter("volume_pos is null"), c.filter("volume_pos is not null"))
    m = M.manifest(books, H.flatten_chapters(chosen).drop("paragraphs"))
    assert m.count() == 5 and {r.section_id: r.dest for r in M.first_in_listing(m).collect()} == {32: "01-Health/77_Same.pdf", 41: "02-Police/V/77_Same.pdf"}


def test_order_of_the_whole_tree(spark, collection):
    """Pre-order numbers and subtree ends against a plain walk over random trees, volumes only here and there."""
    rnd = random.Random(9)
    books, volumes, chapters, sections, paragraphs = [], [], [], [], []
    for b in range(6):
        books.append((b, rnd.choice([None, 1, 2])))
        mine = [(10 * b + k, rnd.randrange(2), b) for k in range(rnd.randrange(3))]
        volumes += mine
        for c in range(rnd.randrange(4)):
            cid = 100 + 10 * b + c
            chapters.append((cid, rnd.randrange(3), b, rnd.choice(mine)[0] if mine else None))
            for s in range(rnd.randrange(3)):
                sid = 1000 + 10 * cid + s
                sections.append((sid, rnd.choice([None, 1]), cid, sid))
                paragraphs += [(p, rnd.randrange(2), sid) for p in range(rnd.randrange(3))]
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    nodes = H.tree_nodes(
        make(books, "id long, serial int"), make(volumes, "id long, serial int, book_id long"), make(chapters, "chapter_id long, serial int, book_id long, volume_id long"),
        make(sections, "id long, serial int, chapter_id long, section_key long"), make(paragraphs, "id long, serial int, section_key long"),
    )
    got = sorted((r.rn, r.kind, r.id, r.subtree_end) for r in H.preorder(nodes).collect())
    want: list = []

    def walk(kind, row, children):
        at = len(want)
        want.append(None)
        for child in sorted(children, key=lambda x: (x[1][1] or 0, x[1][0])):
            walk(*child)
        want[at] = (at + 1, kind, row[0], len(want))

    def below_chapter(c):
        return [("section", s, [("paragraph", p, []) for p in paragraphs if p[2] == s[3]]) for s in sections if s[2] == c[0]]

    def below_book(b):
        return [("volume", v, [("chapter", c, below_chapter(c)) for c in chapters if c[3] == v[0]]) for v in volumes if v[2] == b[0]] + [("chapter", c, below_chapter(c)) for c in chapters if c[2] == b[0] and c[3] is None]

    for b in sorted(books, key=lambda x: (x[1] or 0, x[0])):
        walk("commission", b, below_book(b))
    assert got == want and len({k for _, k, _, _ in got}) == 5
    assert H.preorder(nodes.limit(0)).count() == 0


def test_outcome_of_each_file(spark, tmp_path):
    for name, text in (("a.json", '[{"id": 1}, {"id": 2}]'), ("b.json", "[]"), ("c.json", '[{"id": 1}, {"id"'), ("d.json", ""), ("e.json", '{"id": 3}')):
        (tmp_path / name).write_text(text)
    expected = spark.createDataFrame([("a.json",), ("z.json",), ("z.json",)], "file_name string")
    told = L.file_outcomes(L.export_files(spark, str(tmp_path)), BOOK, expected, L.file_names(spark, str(tmp_path)))
    assert {r.file_name: (r.status, r.records) for r in told.collect()} == {"a.json": ("ok", 2), "b.json": ("empty", 0), "c.json": ("bad", 0), "d.json": ("bad", 0), "e.json": ("ok", 1), "z.json": ("missing", 0)}
    for _ in range(2):
        L.write_quarantine(told, str(tmp_path / "q"))
    held = spark.read.parquet(str(tmp_path / "q")).collect()
    assert sorted(r.file_name for r in held) == ["c.json", "c.json", "d.json", "d.json"] and {r.text for r in held if r.file_name == "c.json"} == {'[{"id": 1}, {"id"'} and all(r.file_path.endswith(r.file_name) for r in held)


def test_search_by_many_keys(spark):
    """Nested, overlapping, repeated and case-folded keys against plain containment, in one block and in many."""
    rnd = random.Random(4)
    texts = [(i, "".join(rnd.choice("abcAÉé ") for _ in range(rnd.randrange(80)))) for i in range(60)] + [(60, None), (61, ""), (62, "100% a.b")]
    keys = {"".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 4))) for _ in range(150)} | {"A", "a", "É", "%", "a.b", "zzz", "100%"}
    rows = spark.createDataFrame([(i, t, "x") for i, t in texts], "id long, text string, other string")
    want = {(i, k) for i, t in texts for k in keys if t is not None and k.lower() in t.lower()}
    frame = spark.createDataFrame([(k,) for k in [*keys, "a", "zzz"]], "key string")
    for size in (40, 1 << 20):
        got = S.search_keys(rows, frame, "text", block_bytes=size).collect()
        assert {(r.id, r.key) for r in got} == want and len(got) == len(want)
    every = S.search_keys(rows, spark.createDataFrame([("",), (None,), ("zzz",)], "key string"), "text", "other").collect()
    assert len(every) == 2 * len(texts) and {r.id for r in S.search_keys(rows, frame.filter("key = 'x'").union(spark.createDataFrame([("x",)], "key string")), "text", "other").collect()} == {i for i, _ in texts}
    assert S.search_keys(rows, frame.limit(0), "text").count() == 0


def test_ten_thousand_keys_cost_about_as_much_as_ten(spark):
    import time

    rows = spark.range(20000).select("id", F.concat_ws(" ", *[F.sha1(F.concat("id", F.lit(str(k)))) for k in range(20)]).alias("text")).cache()
    rows.count()
    keys = spark.range(10000).select(F.substring(F.sha1(F.col("id").cast("string")), 1, 9).alias("key"))
    took = {}
    for n in (10, 10, 10000):
        began = time.perf_counter()
        S.search_keys(rows, keys.limit(n), "text").count()
        took[n] = time.perf_counter() - began
    assert took[10000] < 4 * took[10] + 2


def test_stored_pages(spark, tmp_path):
    """Every page by its keys, ties and both directions included; a page reads one folder and a range of keys."""
    rows = spark.createDataFrame([(i, (i * 7) % 5, f"t{i}") for i in range(1, 148)], "id long, serial int, title string")
    for up in (True, False):
        order, path = (("serial", False), ("id", up)), str(tmp_path / f"b{up}")
        N.write_pages(rows, path, 10, *order, pages_per_block=4)
        want = sorted(range(1, 148), key=lambda i: (-((i * 7) % 5), i if up else -i))
        for p in range(1, 16):
            assert [r.id for r in N.seek_page(spark, path, p, *order).orderBy("rn").collect()] == want[10 * (p - 1) : 10 * p]
        assert N.seek_page(spark, path, 16, *order).count() == 0 == N.seek_page(spark, path, 0, *order).count()
        page = N.seek_page(spark, path, 9, *order)
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(block" in plan and "LessThanOrEqual(serial" in plan and "Exchange" not in plan
        assert all("/block=2/" in r[0] for r in page.select(F.input_file_name()).distinct().collect())
    N.write_pages(rows.limit(0), str(tmp_path / "e"), 10, ("serial", False), ("id", True))
    assert N.seek_page(spark, str(tmp_path / "e"), 1, ("serial", False), ("id", True)).count() == 0


def test_sketches_unite(spark, tmp_path):
    path = str(tmp_path / "s")
    refs = spark.range(60000).select((F.col("id") % 3).alias("owner"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("f"), F.col("id") % 20000)).alias("file_name"))
    exact = {r.owner: r.n for r in refs.groupBy("owner").agg(F.count_distinct("file_name").alias("n")).collect()}
    for part in refs.randomSplit([0.5, 0.5, 0.5], 1):
        M.add_sketches(M.attachment_sketches(part, "owner"), path)
    M.add_sketches(M.attachment_sketches(refs, "owner"), path)  # once more: counts stay
    for r in M.sketched_counts(spark.read.parquet(path), "owner").collect():
        assert abs(r.pdfs - exact[r.owner]) <= 4 * M.SKETCH_ERROR * exact[r.owner]
    whole = refs.agg(F.count_distinct("file_name")).first()[0]
    assert abs(M.sketched_counts(spark.read.parquet(path)).first().pdfs - whole) <= 4 * M.SKETCH_ERROR * whole
    assert M.sketched_counts(M.attachment_sketches(refs.limit(0), "owner"), "owner").count() == 0


def test_manifest_files_by_size(spark, tmp_path):
    """Large directories get several files, small ones one; a filter on a directory reads only it."""
    big = spark.range(40000).select(F.lit("01-Big").alias("commission_dir"), F.lit(None).cast("string").alias("volume_dir"), F.sha2(F.col("id").cast("string"), 512).alias("dest"))
    small = spark.range(300).select(F.concat(F.lit("02-Small"), F.col("id") % 3).alias("commission_dir"), F.lit("V").alias("volume_dir"), F.lit("x").alias("dest"))
    write_manifest(big.unionAll(small).repartition(6), str(tmp_path / "m"), file_bytes=1 << 20)
    files = lambda name: list((tmp_path / "m").glob(f"commission_dir={name}/*/*.parquet"))
    assert len(files("01-Big")) > 3 and all(len(files(f"02-Small{k}")) == 1 for k in range(3))
    back = read_manifest(spark, str(tmp_path / "m"))
    assert back.filter("volume_dir is null").count() == 40000 and back.filter("volume_dir = 'V'").count() == 300
    plan = back.filter("commission_dir = '02-Small1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commission_dir" in plan


def test_labels_at_any_depth_without_python(spark):
    deep = {"a": {"b": [1, {"c": True, "d": None}, [], {}, "s"]}, "x.y": {"z": 1.5, "": "empty key"}, "t": "é \" quote", "n": -3}
    rows = [("en", json.dumps(deep)), ("fr", '{"a": {"p": "lost"}, "a": {"b.c": "kept"}}'), ("de", "{broken"), ("es", None), ("it", "[]"), ("pt", '"bare"'), ("nl", '["x"]')]
    got = R.flatten_json(spark.createDataFrame(rows, "lang string, text string"))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()

    def leaves(node, path):
        if isinstance(node, (dict, list)):
            for k, v in node.items() if isinstance(node, dict) else enumerate(node):
                yield from leaves(v, (*path, str(k)))
        elif path:
            yield path, None if node is None else node if isinstance(node, str) else json.dumps(node)

    want = {("en", *x) for x in leaves(deep, ())} | {("fr", ("a", "b.c"), "kept"), ("nl", ("0",), "x")}
    assert {(r.lang, tuple(r.path), r.value) for r in got.collect()} == want
    assert R.flatten_json(spark.createDataFrame([], "lang string, text string")).count() == 0 and spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def test_parity_of_several_pairs(spark):
    rows = [("bn", "k", "x"), ("en", "k", "x"), ("fr", "k", None), ("bn", "only", None), ("de", "far", "y")]
    labels = spark.createDataFrame(rows, "lang string, key string, value string")
    got = {(r.pair, r.key): r.status for r in S.label_parities(labels, [("bn", "en"), ("en", "fr")]).collect()}
    assert got == {("bn-en", "k"): "same", ("bn-en", "only"): "bn-only", ("en-fr", "k"): "different"}


def test_summary_has_no_window_of_all_rows(spark, collection):
    plan = S.summary_rows(R.read_books(spark, str(collection / "books.json")))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_plans(spark):
    """Numbering never moves all rows to one task, and commissions are broadcast."""
    rows = spark.range(1000).withColumn("serial", F.col("id") % 7)
    plan = N.global_index(rows, F.desc("serial"), F.desc("id"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    books = spark.createDataFrame([(1, "a", 1)], "id long, name string, serial int")
    sections = spark.createDataFrame([], "book_id long, volume_id long, chapter_id long, section_id long, serial int, name string, hasPdf boolean, pdfName string, content string")
    plan = M.manifest(books, sections)._jdf.queryExecution().optimizedPlan().toString()
    assert all("LogicalRDD" in line for line in plan.splitlines() if "content#" in line)
