"""Operator 13 against comparing every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from tests.llm.helpers import SF, hard_docs
from wordmill.llm import spelling
from wordmill.llm.queries import QUERIES


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(counts: dict[str, int], ratio: int = 5) -> dict[str, tuple]:
    by_length: dict[int, list[str]] = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    form, n_near = {}, {}
    for w, n in counts.items():
        near = [v for d in (-1, 0, 1) for v in by_length.get(len(w) + d, ()) if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        n_near[w] = len(near)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, n_near[w], counts.get(form[w]))
    return out


def plain_words(rows) -> dict[str, int]:
    total: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def as_dict(df) -> dict[str, tuple]:
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def grouped(spark, counts: dict[str, int], **kw):
    return as_dict(spelling.spelling_groups(
        spark.createDataFrame(list(counts.items()), "word string, n long"), **kw))


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_groups(plain_words(docs))
    got = as_dict(QUERIES["op13_spelling_variants"](spark, SF))
    assert got == want
    assert any(f for f, *_ in got.values())


def test_dense_words_equal_all_pairs(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([1, 1, 5, 5, 25, 130, 700])
              for _ in range(900)}
    assert grouped(spark, counts) == plain_groups(counts)
    assert grouped(spark, counts, ratio=2) == plain_groups(counts, 2)


def test_chains_ties_and_runs(spark):
    counts = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "zaaaaaaaa": 625, "banane": 50, "banana": 50, "bananb": 10}
    got = grouped(spark, counts)
    assert got == plain_groups(counts)
    assert got["aaaaaa"] == ("aaaaaaa", "zaaaaaaaa", 5, 1, 25)
    assert got["bananb"] == ("banana", "banana", 10, 2, 50)
    assert got["zaaaaaaaa"] == (None, "zaaaaaaaa", 625, 1, None)


def test_very_long_words(spark):
    rng = random.Random(6)
    base = "".join(rng.choice("abcde") for _ in range(5000))
    counts = {base: 100, base[:2500] + base[2501:]: 7, base[:40] + "z" + base[41:]: 20, "x" + base: 9,
              base[:-1]: 5, base[::-1]: 3, base[:33]: 50, base[:32]: 4, base[:31] + base[32:33]: 3}
    assert grouped(spark, counts) == plain_groups(counts)


def test_part_is_how_both_ends_are_written():
    word = "ab" * 40
    heads, tails = spelling._ends(word)
    assert heads == [spelling._part(word[:i]) for i in range(81)]
    assert [t for t in tails if not t.startswith("#")] == [word[i:] for i in range(48, 81)]
    assert len(set(tails)) == len(set(heads)) == 81


def test_runs_of_hard_texts(spark, monkeypatch):
    docs = hard_docs(spark, clash=("word", "n", "rank", "key"))
    more = spark.createDataFrame([(20 + i, "Straßen ÉTUDES ×÷abcdef don't straßens " * 2, None, None, 1, *"xxxx")
                                  for i in range(3)], docs.schema)
    both = docs.unionByName(more)
    want = plain_words((r["doc_id"], r["text"]) for r in both.collect())
    assert "straßen" in want and "Études" in want
    for chunk in (spelling._CHUNK, 10):
        monkeypatch.setattr(spelling, "_CHUNK", chunk)
        got = spelling.word_counts(both, edit=spelling.deletions())
        assert {r["word"]: r["n"] for r in got.collect()} == want


def test_empty_and_null(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(spelling.word_counts(empty)).collect() == []
    got = spelling.spelling_groups(spark.createDataFrame([(None, 5), ("abcdef", 5)], "word string, n long"))
    assert [tuple(r) for r in got.collect()] == [("abcdef", None, "abcdef", 5, 0, None)]
