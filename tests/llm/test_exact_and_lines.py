"""Exact dedup and line dedup against their SQL and on hard rows."""

from __future__ import annotations

import re
from collections import defaultdict

import pandas as pd
import pytest

from tests.llm.helpers import HARD_TEXTS, SF, duck, hard_docs, same, sha256
from wordmill.llm.exact_dedup import exact_dedup
from wordmill.llm.line_dedup import line_dedup
from wordmill.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same(QUERIES[name](spark, SF), *duck(ORACLE_SQL[name]))


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_dedup_of_hard_rows(spark, digest_all):
    texts = [*HARD_TEXTS, (10, "A\n"), (11, " A"), (12, " A ")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, size int, keep int")
    rows = exact_dedup(docs, digest_all=digest_all, prefix_chars=1).collect()
    groups = defaultdict(list)
    for key, text in texts:
        norm = re.sub(r"[\x20\x09-\x0D]+", "", text or "")
        groups[sha256(norm)].append((-len(text or ""), key is None, key or 0, key))
    assert len(rows) == len(texts)
    kept = defaultdict(int)
    for r in rows:
        if r.text_sha256 is None:
            assert not digest_all and r.group_size == 1 and r.kept
            continue
        members = groups[r.text_sha256]
        assert r.group_size == len(members) and r.keep_id == min(members)[3]
        kept[r.text_sha256] += r.kept
    assert all(n == 1 for n in kept.values())
    assert exact_dedup(docs.limit(0), digest_all=digest_all).collect() == []


def test_line_dedup_of_hard_rows(spark):
    docs = hard_docs(spark)
    before = {(r.doc_id, r.text) for r in docs.collect()}
    out = line_dedup(docs)
    assert {(r.doc_id, r.text) for r in out.collect()} == before  # nothing is frequent here
    assert set(docs.columns) <= set(out.columns)
    assert line_dedup(docs.limit(0)).collect() == []


def test_line_dedup_drops_by_site(spark):
    rows = [(n, f"menu\nstory {n}\n\n menu ", "a" if n < 50 else None) for n in range(100)]
    rows += [(100 + n, "a copied page\nof two lines", "a") for n in range(40)]  # copies are one page
    rows += [(200 + n, f"menu\nother {n}", "b") for n in range(3)]  # fewer than MIN_PAGES
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup(docs).collect()}
    assert got[3] == ("story 3\n", 2) and got[70] == ("story 70\n", 2)
    assert got[120] == ("a copied page\nof two lines", 0) and got[201] == ("menu\nother 1", 0)
    out = line_dedup(docs).select("doc_id", "source", "text", "n_lines", "n_dropped")
    same(out, *duck(ORACLE_SQL["op10_line_dedup"], documents=frame.astype(object).where(frame.notna(), None)))
