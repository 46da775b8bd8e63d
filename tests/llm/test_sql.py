"""The operators that SQL can express, against DuckDB on the smallest test tables."""

import os

import pytest

from civicdocs.llm.queries import QUERIES, SQL
from tests.test_queries import DATA, compare, duck  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", list(SQL))
def test_operator(spark, duck, name):  # noqa: F811
    compare(spark, duck, QUERIES[name](spark, DATA), SQL[name])


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL and not n.startswith("op13_")])
def test_operator_returns_a_row_for_each_input(spark, name):
    table = "pages" if name.startswith("op2_") else "documents"
    assert QUERIES[name](spark, DATA).count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()
