"""The entry without what the operators for training data need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["ahocorasick", "numpy", "logilake.llm", "corpus_pipeline"])
def test_catalog_queries_stay_when_a_dependency_is_missing(hidden):
    code = f"""
import sys
sys.modules[{hidden!r}] = None
import __spark_entry__ as entry
from logilake.catalog import all_queries, all_sql
assert all_queries().keys() <= entry.queries().keys() and all_sql().keys() <= entry.oracle_sql().keys()
assert "pipeline" not in entry.queries()
print(len(all_queries()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 75
