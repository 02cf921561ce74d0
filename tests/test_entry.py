import os
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

TOP = Path(entry.__file__).resolve().parent


def test_nothing_else_imports_the_corpus_operators():
    for path in (TOP / "sieveyard").rglob("*.py"):
        if "llm" not in path.relative_to(TOP).parts:
            assert not re.search(r"^\s*(from|import)\b.*\b(llm|corpus_pipeline)\b", path.read_text(), re.M), path


def test_queries_and_sql_go_together():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert ("pipeline" in entry.queries()) == entry.LLM


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no driver tables")
def test_entry(spark):
    assert {r.split for r in entry.entry(spark).collect()} == {"train", "validation", "test"}
