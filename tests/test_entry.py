"""The driver contract without the optional part."""

from __future__ import annotations

import subprocess
import sys

import pytest

from tests.conftest import ROOT
from wordmill.plans.registry import ORACLE_SQL, QUERIES

SCRIPT = r'''
import sys
sys.path.insert(0, sys.argv[1])

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == sys.argv[2] or name == sys.argv[2]:
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(sorted(e.queries()) , sorted(e.oracle_sql()))
'''


@pytest.mark.parametrize("missing", ["wordmill.llm", "xxhash", "corpus_pipeline"])
def test_core_queries_work_without(missing):
    r = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, missing], capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
    for name in [*QUERIES, *ORACLE_SQL]:
        assert repr(name) in r.stdout
    assert "'pipeline'" not in r.stdout
