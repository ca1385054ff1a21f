"""Every registered query against its DuckDB SQL (the driver's check)."""

from __future__ import annotations

import hashlib
import os

import duckdb
import pytest

from __spark_entry__ import entry
from tests.conftest import SF_SMALL
from wordmill.plans.registry import ORACLE_SQL, QUERIES

TABLES = ("events documents pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9))
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE_SQL[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["word", "count", "rank"]
    assert 0 < df.count() <= 10
    assert os.path.isdir("/root/testdata/sf0.001")
