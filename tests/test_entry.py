"""The driver contract, and that the library stands without the llm subpackage."""

import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parents[1]


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_stands_without_llm():
    code = "import importlib.util as u; real = u.find_spec; u.find_spec = lambda n, *a: None if n == 'concordia.llm' else real(n, *a); import __spark_entry__ as e; assert 'p3_found' in e.queries() and 'p8_ids' not in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=REPO, env=os.environ | {"PYTHONPATH": str(REPO)}).returncode == 0


def test_nothing_imports_llm():
    for f in (REPO / "concordia").rglob("*.py"):
        if "llm" not in f.parts:
            assert "concordia.llm" not in f.read_text() and "from concordia import llm" not in f.read_text()
