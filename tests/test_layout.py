"""The collection library stands alone, and Spark does its work."""

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent / "civicdocs"
SOURCES = [p for p in ROOT.rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]


def test_nothing_imports_the_optional_part():
    assert SOURCES and not [p for p in SOURCES if re.search(r"^\s*(from|import)\s.*\bllm\b", p.read_text(), re.M)]


def test_no_rdds_or_row_functions():
    bad = re.compile(r"\.rdd\b|F\.udf\(|localCheckpoint|\.toPandas\(|crossJoin")
    assert not [p for p in SOURCES if bad.search(p.read_text())]
