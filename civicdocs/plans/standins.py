"""The collection's entities drawn from star-schema tables.

Each is one SELECT that Spark and DuckDB both read, so that queries and their
SQL start from the same rows. ``{ms}`` is the one expression they spell apart.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SELECTS = {
    "book": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS serial,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE c_mktsegment END AS nameBangla,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN true WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE false END AS hasVolume,
  CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS STRING) || '_1700000000000.pdf' ELSE '' END AS pdfName,
  CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '' ELSE CAST(c_custkey AS STRING) || '_1710000000000.pdf' END AS summaryFileName,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN '' ELSE CAST(c_custkey AS STRING) || '_1720000000000.pdf' END AS summaryEn
FROM customer""",
    "chapter": """SELECT o_orderkey AS chapter_id, o_custkey AS book_id, CAST(month(o_orderdate) AS INT) AS serial,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS title, o_orderstatus AS nameBangla,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Chapter ' || CAST(o_orderkey AS STRING) END AS chapterName,
  o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS volume_id
FROM orders""",
    "volume": """SELECT DISTINCT o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id, o_custkey AS book_id,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS serial, 'Volume/' || o_orderpriority AS name
FROM orders""",
    "section": """SELECT l_orderkey AS chapter_id, l_partkey * 100000 + l_suppkey AS section_id, CAST(l_linenumber AS INT) AS serial, l_returnflag = 'R' AS hasPdf,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_partkey AS STRING) || '_' || CAST({ms} AS STRING) || '.pdf' WHEN l_linenumber % 2 = 0 THEN '' ELSE NULL END AS pdfName,
  ' ' || l_returnflag || '/' || l_linestatus || ': ' || CAST(l_linenumber AS STRING) || ' ' AS name,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_returnflag END AS nameBangla
FROM lineitem""",
    "paragraph": """SELECT conv_id AS section_id, turn AS id, CAST(turn AS INT) AS serial, CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN '' END AS header,
  text AS content, CASE WHEN turn % 2 = 0 THEN CAST(turn AS STRING) END AS indexChar, turn % 4 = 1 AS hasImage,
  CASE WHEN conv_id % 2 = 0 THEN CAST(conv_id AS STRING) || '.png' END AS fileName
FROM conversations""",
    "notice": """SELECT doc_id AS id, CAST(n_chars AS INT) AS serial, lang, substr(text, 1, 80) AS title, source, text FROM documents""",
}
MS = {"spark": "unix_millis(CAST(l_shipdate AS TIMESTAMP))", "duckdb": "epoch_ms(l_shipdate)"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SELECTS[name].replace("{ms}", MS["spark"])
    head, _, source = text.rpartition("FROM ")
    return spark.sql(f"{head} FROM {{source}}", source=table(spark, sf_dir, source.strip()))


def fields(name: str) -> dict[str, str]:
    """The entity's fields, each with its expression over a row of its table."""
    text = re.sub(r"^SELECT (DISTINCT )?", "", SELECTS[name].replace("{ms}", MS["spark"])).rpartition("FROM ")[0]
    ends = [i for i, c in enumerate(text) if c == "," and text.count("(", 0, i) == text.count(")", 0, i)]
    parts = [text[i:j].strip() for i, j in zip([0, *[e + 1 for e in ends]], [*ends, len(text)], strict=True)]
    return {part.rpartition(" AS ")[2] if " AS " in part else part: part.rpartition(" AS ")[0] if " AS " in part else part for part in parts}


def from_row(name: str) -> Column:
    """The entity as a struct, where the columns of its table are at hand."""
    return F.expr("struct(" + ", ".join(f"{x} AS {field}" for field, x in fields(name).items()) + ")")


def from_rows(name: str, rows: str, shape: str, **outside: str) -> Column:
    """An array of rows of the entity's table -> an array of ``shape``, in which ``{field}`` is a field of the entity. ``outside`` names columns that stand outside the array."""
    there = lambda m: outside.get(m[0], f"x.{m[0]}")
    inner = {field: "(" + re.sub(r"\b[a-z]_\w+", there, x) + ")" for field, x in fields(name).items()}
    return F.expr(f"transform({rows}, x -> {shape.format(**inner)})")


def ctes(*names: str) -> str:
    """WITH clause of the named entities for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({SELECTS[n].replace('{ms}', MS['duckdb'])})" for n in names)
