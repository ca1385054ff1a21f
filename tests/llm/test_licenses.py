"""Operator 12 against comparing every run of words with every notice."""

from __future__ import annotations

import random
import re

import pytest

from tests.llm.helpers import SF, hard_docs
from wordmill.llm import licenses
from wordmill.llm.queries import QUERIES

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_words(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_base(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    words = plain_words(text)
    at = [(i, label) for p, label in BASE.items() for i in range(len(words))
          if words[i:i + len(p.split())] == p.split()]
    places = [i for i, _ in at]
    return (len(words), len(at), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in at})))


def cost(marked: str, found: str) -> float:
    """Edits from a notice to ``found``; none inside its brackets or at the
    spaces beside them."""
    chars, fixed, exact = [], [], False
    for c in marked:
        if c in "[]":
            exact = c == "["
        else:
            chars.append(c)
            fixed.append(exact)
    lock = [f or (c == " " and ((i and fixed[i - 1]) or (i + 1 < len(fixed) and fixed[i + 1])))
            for i, (c, f) in enumerate(zip(chars, fixed))]
    inf = float("inf")
    # Nothing may be inserted next to a locked letter on its locked side.
    closed = [(i > 0 and lock[i - 1]) and (i < len(lock) and lock[i]) for i in range(len(chars) + 1)]
    row = [0.0 if j == 0 else (inf if closed[0] or lock[0] else float(j)) for j in range(len(found) + 1)]
    for i, c in enumerate(chars, 1):
        new = []
        for j in range(len(found) + 1):
            best = row[j] + (inf if lock[i - 1] else 1)
            if j:
                best = min(best, row[j - 1] + (0 if found[j - 1] == c else inf if lock[i - 1] else 1),
                           new[j - 1] + (inf if closed[i] or (i == len(chars) and lock[-1]) else 1))
            new.append(best)
        row = new
    return row[-1]


def plain_notices(text: str, notices) -> tuple[set[str], float]:
    """Labels and best similarity, by trying every run of whole words."""
    words = plain_words(text)
    labels, best = set(), 0.0
    for label, marked in notices:
        bare = marked.replace("[", "").replace("]", "")
        k = min(len(bare) // 10, 4)
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                found = " ".join(words[i:j])
                if len(found) > len(bare) + k:
                    break
                if len(found) >= len(bare) - k and (edits := cost(marked, found)) <= k:
                    labels.add(label)
                    best = max(best, 1 - edits / len(bare))
    return labels, best


def damaged(rng: random.Random, text: str, n: int) -> str:
    for _ in range(n):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice(["", rng.choice("aeinst 2"), text[i] + rng.choice("aeinst ")]) + text[i + 1:]
    return text


ALL = [*licenses.BASE, *licenses.NOTICES]


def test_equals_every_run_of_words():
    rng = random.Random(12)
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    n_found = 0
    for trial in range(400):
        label, marked = rng.choice(ALL)
        bare = marked.replace("[", "").replace("]", "")
        text = " ".join(["here is", damaged(rng, bare, trial % 7), "and so on", damaged(rng, bare, 1)][:2 + trial % 3])
        labels, best = plain_notices(text, ALL)
        row = licenses._row(scanner, text)
        assert (set(filter(None, row["labels"].split(","))), row["score"]) == (labels, pytest.approx(best)), text
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == plain_base(text)
        n_found += bool(labels)
    assert 150 < n_found < 400


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT Licence.", "mit"),
    ("released under thee MIT-license", "mit"),
    ("released under the MPL license", ""),
    ("released under the permit license", ""),
    ("Apache License, Version 2.0", "apache-2"),
    ("Apache Licence, Version 2.0", "apache-2"),
    ("Apache License, Version 1.1", ""),
    ("GNU Lesser General Public License", "lgpl"),
    ("GNU General Public Licence, version 3", "gpl"),
    ("CC-BY-NC 4.0 and CC BY-SA", "cc-by-nc"),
    ("Permission is herby granted, free of charge, to any persons", "mit"),
    ("a license for the many people under the sun", ""),
])
def test_examples(text, labels):
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    assert licenses._row(scanner, text)["labels"] == labels


def test_query_holds_the_base_places(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_license_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_base(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) and (not r["n_base"] or r["score"] == 1)
    assert any(r["n_base"] for r in rows)


def test_overlapping_and_repeated_places(spark):
    docs = spark.createDataFrame([(1, "a b a b a cc by nc cc by nc"), (1, "a b a b a cc by nc cc by nc")],
                                 "doc_id long, text string")
    got = licenses.license_scan(docs, base=[("x", "a b a"), *licenses.BASE]).collect()
    assert [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got] == \
        [(11, 4, 0, 8, "cc-by-nc,x")] * 2


def test_spans(spark):
    docs = spark.createDataFrame([(1, "It is under the\nMIT licence; CC BY-NC.")], "doc_id long, text string")
    got = licenses.license_spans(licenses.license_scan(docs)).collect()
    assert [tuple(r) for r in got] == [
        (1, "mit", "under the mit license", 2, 4, 1, "under the mit licence"),
        (1, "cc-by-nc", "cc by nc", 6, 3, 0, "cc by nc")]


def test_hard_rows(spark):
    docs = hard_docs(spark, clash=("n_words", "labels", "score", "spans"))
    long = spark.createDataFrame([(50, "Ünder the MIT license, under the mit license " * 20000, None, None, 1, *"xxxx")],
                                 docs.schema)
    rows = licenses.license_scan(docs.unionByName(long)).collect()
    assert len(rows) == docs.count() + 1
    want = sorted(map(str, ((r["doc_id"], *plain_base(r["text"])) for r in docs.collect())))
    got = sorted(str(tuple(r)[:6]) for r in rows if r["doc_id"] != 50)
    assert got == want
    big = next(r for r in rows if r["doc_id"] == 50)
    assert (big["n_words"], big["n_base"], big["first_word"], big["last_word"]) == (160000, 20000, 4, 159996)
    assert len(big["spans"]) == 40000 and big["labels"] == "mit"
    assert licenses.license_scan(docs.limit(0)).collect() == []


def test_bad_notice():
    with pytest.raises(ValueError):
        licenses.make_notice("x", "Under the  license")
