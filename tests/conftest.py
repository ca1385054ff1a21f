from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from wordmill.session import build_session  # noqa: E402

SF_SMALL = os.environ.get("WORDMILL_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", "wordmill-tests", {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="wordmill-test-")
