"""The pipeline: every stage against a brute-force version of it."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.helpers import SF, hard_docs
from tests.llm.test_decontaminate import plain_leaks
from tests.llm.test_langid import plain_grams, plain_rank
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_tokens_and_packing import check_packing
from wordmill.llm import langid
from wordmill.llm.line_dedup import MIN_PAGES, RATIO


def plain_language(rows):
    learned = {}
    for r in rows:
        if r["lang"] is not None and (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5):
            learned.setdefault(r["lang"], Counter()).update(plain_grams(r["text"] or ""))
    profiles = [dict((g, i) for i, g in enumerate(plain_rank(c, langid.SIZE))) for c in learned.values() if c]
    out = []
    for r in rows:
        if any(c.isalpha() for c in r["text"] or "") and profiles:
            own = plain_rank(plain_grams(r["text"]), langid.SIZE)
            far = min(sum(abs(p[g] - i) if g in p else langid.SIZE for i, g in enumerate(own)) for p in profiles)
            if 1 - far / (langid.SIZE * len(own)) >= langid.MIN_SCORE:
                out.append(r)
    return out


def plain_lines(rows):
    pages, on = defaultdict(set), defaultdict(set)
    for r in rows:
        pages[r["source"]].add(r["text"] or "")
        for line in (r["text"] or "").split("\n"):
            on[r["source"], line.strip(" ")].add(r["text"] or "")
    bad = {k for k, p in on.items() if k[1] and len(p) >= MIN_PAGES and len(p) > RATIO * len(pages[k[0]])}
    out = []
    for r in rows:
        if r["text"] is not None:
            text = "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" ")) not in bad)
            r = {**r, "text": text, "n_chars": len(text)}
        out.append(r)
    return out


def plain_simhash(rows):
    fps = [slow_fingerprint(r["text"]) for r in rows]
    of = slow_components([(i, fp) for i, fp in enumerate(fps)], 2)  # components by row number
    best = {}
    for i, r in enumerate(rows):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if of[i] not in best or key < best[of[i]][0]:
            best[of[i]] = (key, r)
    return [r for _, r in best.values()]


def plain_decontamination(rows, items):
    bad = {k for k, _, _ in plain_leaks(list(enumerate(r["text"] for r in rows)), items)}
    return [r for i, r in enumerate(rows) if i not in bad]


def as_set(rows):
    return sorted(str(sorted((k, r[k]) for k in ("doc_id", "text", "lang", "source", "n_chars"))) for r in rows)


@pytest.mark.parametrize("which", ["documents", "hard"])
def test_stages_match_brute_force(spark, which, scratch):
    if which == "documents":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
    else:
        docs = hard_docs(spark)
    rows = [r.asDict() for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = [plain_language, plain_lines, plain_simhash, lambda r: plain_decontamination(r, items)]
    for n, ((name, stage), check) in enumerate(zip(corpus_pipeline.STAGES, plain)):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        want = check(rows)
        path = f"{scratch}/{n}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert as_set(r.asDict() for r in docs.collect()) == as_set(want), name
        rows = want
    texts = defaultdict(list)
    for r in rows:
        texts[r["doc_id"]].append(r["text"])
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    sequences, bound = check_packing(packed, texts)
    assert sequences <= bound + 1
    if which == "documents":
        whole = corpus_pipeline.run(spark, SF).collect()
        assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in whole) == Counter(
            (r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_empty_table(spark):
    docs = hard_docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_repeated_rows_stay_once(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x", "s", 7), (1, "a b c d", "x", "s", 7), (2, "a b c d", "x", "s", 7),
                                  (None, "q r s t", "x", "s", 7), (None, "q r s t", "x", "s", 7)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == [("1", "a b c d"), ("None", "q r s t")]


