"""Column expressions on hand-written rows: null against empty, ties, code points, Bangla text."""

import datetime

import pytest
from pyspark.sql import functions as F

from civicdocs.functions import text as X


def one(spark, rows, ddl, *exprs):
    out = [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*exprs).collect()]
    return [r[0] for r in out] if len(exprs) == 1 else out


def test_names(spark):
    rows = [("খ", "b"), (None, "b"), ("", "b"), ("খ", ""), ("", None), (" ", "b")]
    assert one(spark, rows, "bn string, en string", X.localized("bn", "bn", "en"), X.localized("en", "bn", "en")) == [
        ("খ", "b"), ("b", "b"), ("b", "b"), ("খ", "খ"), (None, None), (" ", "b"),
    ]
    assert one(spark, rows, "bn string, en string", X.localized_strict("bn", "bn", "en"))[:3] == ["খ", None, ""]
    picked = one(spark, [("bn", "খ", "b"), ("en", "খ", "b"), (None, "খ", "b")], "l string, bn string, en string", X.localized(F.col("l"), "bn", "en"), X.localized_strict(F.col("l"), "bn", "en"))
    assert picked == [("খ", "খ"), ("b", "b"), ("b", "b")]
    assert one(spark, [("", "n", 7), (None, "n", 7), (None, None, 7)], "bn string, name string, id long", X.display_name("bn", "name", "id")) == ["", "n", "7"]


def test_labels(spark):
    assert one(spark, [("t", "c"), ("", "c"), (None, None)], "t string, c string", X.chapter_label("t", "c")) == ["t", "c", ""]
    assert one(spark, [("n",), (None,)], "n string", X.section_label("n")) == ["n", ""]
    assert one(spark, [("A", None)], "n string, b string", *X.report_titles("n", "b")) == [("Report of the A", "  এর প্রতিবেদন ")]
    assert one(spark, [(2, 1, None), (3, 4, "খ")], "c int, s int, b string", X.section_header("c", "s", "b")) == ["2.1 null", "3.4 খ"]
    assert one(spark, [(2, "খ")], "c int, b string", X.chapter_name("c", "b")) == [" অধ্যায়-2: খ"]


@pytest.mark.parametrize("n", [59, 60, 61])
def test_safe_name_counts_code_points(spark, n):
    assert one(spark, [("😀" * n,), ("ক" * n,)], "n string", X.safe_name("n")) == ["😀" * min(n, 60), "ক" * min(n, 60)]


def test_safe_name(spark):
    rows = [("a/b\\c:d",), ("\t x y \n",), (None,), ("a" * 59 + "/b",), ("a" * 59 + " b",), ("\x1cx\x1f",)]
    assert one(spark, rows, "n string", X.safe_name("n")) == ["a-b-c-d", "x y", "unnamed", "a" * 59 + "-", "a" * 59, "x"]


def test_slugs_and_paths(spark):
    assert one(spark, [(7, "A b/c"), (12, "x" * 50), (123, None)], "s int, n string", X.commission_slug("s", "n")) == ["07-A-b-c", "12-" + "x" * 40, "123-unknown"]
    assert one(spark, [("Vol/1 ",), ("v" * 40,), (None,)], "n string", X.volume_slug("n")) == ["Vol-1", "v" * 30, "volume"]
    got = one(spark, [("c", "v", "12_9.pdf", "x:y"), ("c", None, "noprefix.pdf", "z")], "c string, v string, p string, s string", X.target_path("c", "v", "p", "s"))
    assert got == ["c/v/12_x-y.pdf", "c/noprefix.pdf_z.pdf"]
    assert one(spark, [("a.pdf",), ("",), (None,)], "f string", X.attachment_url("f")) == ["/pdfs/attachment/a.pdf", "", ""]
    moved = one(spark, [("/api/attachment/view-pdf/a/b.pdf",), ("/api/attachment/block-image/c.png",), ("/x/api/attachment/view-pdf/a",)], "p string", X.rewrite_path("p"))
    assert moved == ["/pdfs/attachment/a/b.pdf", "/pdfs/attachment/c.png", "/x/api/attachment/view-pdf/a"]


def test_text(spark):
    assert one(spark, [("&\"'<>&amp;",)], "t string", X.escape_attribute("t")) == ["&amp;&quot;&#39;&lt;>&amp;amp;"]
    assert one(spark, [("a\nb\n",)], "t string", X.line_breaks("t")) == ["a<br>b<br>"]


def test_routes(spark):
    rows = [("",), (None,), ("#/",), ("#/view/54",), ("#view",), ("#/nope/1",), ("#/notice/",), ("view/1/2",)]
    assert one(spark, rows, "h string", *X.parse_route("h")) == [
        ("home", None), ("home", None), ("home", None), ("view", "54"), ("view", None), ("home", "1"), ("notice", None), ("view", "1"),
    ]


def test_dates_and_times(spark):
    assert one(spark, [("05-06-2025",), ("2025-06-05",), ("31-02-2025",), (None,), ("",)], "d string", X.notice_date("d")) == [datetime.date(2025, 6, 5), None, None, None, None]
    got = one(spark, [("12_1750000000000.pdf",), ("12_17.pdf",), (None,)], "f string", F.unix_millis(X.upload_time("f")))
    assert got == [1750000000000, None, None]


def test_booleans_uploads_bytes(spark):
    assert one(spark, [("true",), ("1",), ("TRUE",), ("0",), (None,)], "b string", X.decode_bool("b")) == [True, True, False, False, False]
    assert one(spark, [(True,), (False,), (None,)], "b boolean", X.encode_bool("b")) == [1, 0, 0]
    assert one(spark, [("data:x;base64,aGk=",), ("data:x;base64,?",), (None,)], "d string", X.decode_upload("d")) == [bytearray(b"hi"), None, None]
    assert one(spark, [(5,), (1234567,), (12345678901,)], "n long", X.format_bytes("n")) == ["         5", " 1,234,567", "12,345,678,901"]


def test_authorities(spark):
    rows = [(True, ["A", "B"]), (False, ["A"]), (None, ["A"]), (True, None), (True, []), (True, [None])]
    ddl = "ok boolean, held array<string>"
    assert one(spark, rows, ddl, X.has_authority("ok", "held", F.lit("A"))) == [True, False, False, False, False, False]
    assert one(spark, rows, ddl, X.has_any_authority("ok", "held", X.authority_list(F.lit(" A ,C")))) == [True, False, False, False, False, False]


def test_kinds(spark):
    rows = [(True, "a.pdf"), (True, ""), (True, None), (False, "a.pdf"), (None, "a.pdf")]
    assert one(spark, rows, "h boolean, p string", X.section_kind("h", "p")) == ["pdf", "text", "text", "text", "text"]
    assert one(spark, [([1],), ([],), (None,)], "c array<int>", X.has_children("c"), X.chapter_kind("c")) == [(True, "branch"), (False, "leaf"), (False, "leaf")]


def test_search_is_literal(spark):
    rows = [("Ab.c", None), ("100%", "য়"), (None, None), ("abxc", "য়")]
    find = lambda key: one(spark, rows, "t string, b string", X.contains_key(key, "t", "b"))
    assert find("B.C") == [True, False, False, False]
    assert find("%") == [False, True, False, False]
    assert find("") == [True] * 4
    assert find("য়") == [False, "য়" in rows[1][1], False, "য়" in rows[3][1]]
    composed = one(spark, rows, "t string, b string", X.contains_key("য়", X.compose_bangla("b")))
    assert composed == [False, True, False, True]


def test_required_and_languages(spark):
    rules = {"serial": F.col("s").isNotNull(), "name": X.nz("n").isNotNull()}
    assert one(spark, [(1, "a"), (None, ""), (1, None)], "s int, n string", X.required_violations(rules)) == [[], ["serial", "name"], ["name"]]
    assert one(spark, [("bn",), ("xx",), ("pt-br",)], "l string", X.language_name("l")) == ["Bangla", None, "Português (Brasil)"]
    assert len(X.LANGUAGES) == 22
