"""Decontamination against a brute-force version, re-parameterised questions
and hard rows."""

from __future__ import annotations

import re

import regex

from tests.llm.helpers import SF, hard_docs
from wordmill.llm import decontaminate as dc


def plain_windows(text):
    marked = regex.sub(r"(^|[.!?:;\n\"(][ \t\n\x0b\f\r]*)(\p{Lu})", "\\1\x01\\2", text or "")
    raw = regex.findall(r"(?:[\p{L}\p{N}\x01]|(?<=[0-9])[.,](?=[0-9]))+", marked)
    tpl = []
    for t in raw:
        if regex.match(r"\x01?\p{N}", t) or t.lower().replace("\x01", "") in dc.NUMBER_WORDS:
            tpl.append("#n")
        elif t.lower() != t and regex.fullmatch(r"\p{Lu}\p{Ll}+", t):
            tpl.append("#a")
        elif t.lower() in dc.UNITS:
            tpl.append("#u")
        else:
            tpl.append(t.lower().replace("\x01", ""))
    out = []
    for i in range(len(tpl) - dc.WINDOW + 1):
        part = tpl[i:i + dc.WINDOW]
        slots = [p + r.lower().replace("\x01", "") for p, r in zip(part, raw[i:]) if p[0] == "#"]
        if len(slots) <= dc.WINDOW - dc.MIN_WORDS:
            out.append((i, tuple(part), tuple(slots)))
    return out


def plain_leaks(docs, items):
    out = set()
    index = {}
    total = {}
    for item, text in items:
        for pos, part, slots in plain_windows(text):
            index.setdefault(part, []).append((item, pos, slots))
            total.setdefault(item, set()).add(pos)
    for key, text in docs:
        aligned = {}
        for pos, part, slots in plain_windows(text):
            for item, item_pos, item_slots in index.get(part, ()):
                at, pairs = aligned.setdefault((item, pos - item_pos), (set(), set()))
                at.add(item_pos)
                pairs.update(zip(item_slots, slots))
        held = {}
        for (item, _), (at, pairs) in aligned.items():
            if len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs):
                held.setdefault(item, set()).update(at)
        out |= {(key, item, round(len(at) / len(total[item]), 9)) for item, at in held.items()
                if len(at) / len(total[item]) >= dc.MIN_COVERAGE}
    return out


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = plain_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    out = dc.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id, round(r.coverage, 9)) for r in out} == want
    assert want and len(out) == len(want) and all(r.verbatim for r in out)
    # Every whole passage is found, and documents without one stay.
    flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [flat(r.text) for r in bench.collect()]
    whole = {r.doc_id for r in docs.collect() if any(i in flat(r.text) for i in items)}
    assert whole == {d for d, _, _ in want}
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - whole


ITEM = "A train leaves Boston at 9 and travels 60 miles in 2 hours; how far does Alice go in 9 hours if she left Boston?"


def test_reparameterised_questions(spark):
    texts = {
        1: "Intro. " + ITEM + " Outro.",
        2: ITEM.replace("9", "7").replace("60", "80").replace("Boston", "Leeds").replace("Alice", "Maria"),
        3: ITEM.replace("miles", "km").replace("2", "5"),
        4: ITEM.replace("at 9", "at 7"),  # 9 becomes both 7 and 9
        5: ITEM.replace("left Boston", "left Leeds"),  # so does Boston
        6: "A train leaves now and nothing else of the question is here, as far as Alice can see in her hours.",
        7: ITEM.upper(),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (1, ITEM)], "item_id long, text string")
    got = {r.doc_id: r.verbatim for r in dc.leaks(docs, bench).collect()}
    assert got == {1: True, 2: False, 3: False}
    assert plain_leaks(texts.items(), [(1, ITEM)]) == {(k, 1, 1.0) for k in got}


def test_hard_rows(spark):
    docs = hard_docs(spark, clash=("id", "hash", "slots", "raw", "text_key", "item_id", "coverage"))
    bench = spark.createDataFrame([(None, "word " * 6), (2, "a b"), (3, "É a b c x y and more")],
                                  "item_id long, text string")
    # The text without an id is "a b", the whole of a short item.
    assert {(r.doc_id, r.item_id) for r in dc.leaks(docs, bench).collect()} == {(4, None), (None, 2)}
    left = dc.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - 2
    assert dc.leaks(docs.limit(0), bench).collect() == [] == dc.leaks(docs, bench.limit(0)).collect()
    assert dc.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_short_items_are_found_as_whole_texts(spark):
    texts = {1: "Who wrote Hamlet?", 2: "WHO WROTE HAMLET", 3: "Tell me who wrote Hamlet?", 4: "Who wrote Macbeth?",
             5: "3 + 4 = ?", 6: "3 + 5 = ?", 7: "1 2 3 4 5 6 7 8", 8: "1 2 3 4 5 6 7 9", 9: "?", 10: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = [(1, "Who wrote Hamlet?"), (2, "3 + 4"), (3, "1 2 3 4 5 6 7 8"), (4, "?"), (5, None), (1, "Who wrote Hamlet?"),
             (6, "who wrote hamlet")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.coverage, r.verbatim) for r in dc.leaks(docs, bench).collect())
    assert got == [(d, i, 1.0, True) for d, i in ((1, 1), (1, 6), (2, 1), (2, 6), (5, 2), (7, 3))]
    assert sorted(r.doc_id for r in dc.decontaminate(docs, bench).collect()) == [3, 4, 6, 8, 9, 10]


def test_numbers_in_any_writing(spark):
    item = "A shop sells 1,200 cards at 3.50 dollars each. Three clerks work there for twelve hours; what does one day bring?"
    other = item.replace("1,200", "850").replace("3.50", "4").replace("Three", "Four").replace("twelve", "twenty")
    more = item.replace("1,200", "eighty").replace("Three", "7")
    got = found(spark, item, {1: item, 2: other, 3: more, 4: item.replace("twelve", "12")})
    assert got == {1: (1.0, True), 2: (1.0, False), 3: (1.0, False), 4: (1.0, False)}


def test_queries_run(spark):
    from wordmill.llm.queries import QUERIES
    assert QUERIES["op2_decontamination"](spark, SF).columns == ["doc_id", "item_id", "coverage", "verbatim"]


def found(spark, item, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r.doc_id: (round(r.coverage, 3), r.verbatim) for r in dc.leaks(docs, bench).collect()}


def test_names_that_open_sentences(spark):
    item = "Tom has 3 apples. Tom buys 2 more. How many apples does Tom have?"
    texts = {
        1: item,
        2: item.replace("Tom", "Ann"),
        3: "Now see this. " + item.replace("Tom", "Ann").replace("3", "8"),
        4: item.replace("Tom buys", "Ann buys").replace("does Tom", "does Eve"),  # one name, three values
        5: item.lower(),  # as found by the reading as words alone
        6: "Tom has a dog. How many apples are there?",
    }
    got = found(spark, item, texts)
    assert set(got) == {1, 2, 3, 5} and got[1][1] and not got[2][1] and not got[3][1]
    assert got[1][0] == got[2][0] == got[3][0] == 1.0


def test_a_reading_with_conflicts_leaves_the_other(spark):
    item = "Boston is a very large old city. They say that all the trains go to Boston each day."
    got = found(spark, item, {1: item.replace("to Boston", "to Leeds")})
    assert got == {1: (1.0, False)}


LONG = ("A farmer plants rows of beans along the fence while her brother digs a narrow ditch behind the barn and "
        "fills it with water from the old well so that the seedlings may drink all through the dry season until "
        "rain comes; after that both of them sell what grew there at the market near the river for 40 dollars. "
        "What did they earn?")


def test_a_run_of_a_long_item_is_found(spark):
    words = LONG.split()
    filler = "Nothing of this kind is written here, nor is it anywhere else."
    texts = {
        1: " ".join([filler, *words[5:35], filler]),
        2: " ".join([filler, *words[5:18], filler]),  # 13 words
        3: " ".join([filler, *words[5:17], filler]),  # 12 words
        4: " ".join([filler, *words[5:15], filler, *words[30:40], filler]),  # two runs of 10
        5: " ".join([filler, *words[-18:]]).replace("40", "55"),  # the question part
    }
    got = found(spark, LONG, texts)
    assert set(got) == {1, 2, 5}
    assert all(coverage < dc.MIN_COVERAGE for coverage, _ in got.values())
    assert got[1][1] and got[2][1] and not got[5][1]


def test_longest_run(spark):
    frame = spark.createDataFrame([(1, [0, 1, 2, 20, 25, 31]), (2, [8]), (3, [])], "id int, at array<int>")
    assert {r.id: r.run for r in frame.select("id", dc._run(frame["at"]).alias("run")).collect()} == {1: 10, 2: 5, 3: 0}


def test_windows_without_slots_survive_a_conflict(spark):
    item = LONG.replace("plants rows", "plants 40 rows")
    assert item.count("40") == 2
    texts = {1: item.replace("for 40", "for 55"), 2: item.replace("40", "55"),
             3: "She plants 40 rows of beans along the road and then sells all of it for 55 dollars. What did they earn?"}
    got = found(spark, item, texts)
    assert set(got) == {1, 2} and not got[1][1] and not got[2][1]
    assert dc.MIN_COVERAGE <= got[1][0] < got[2][0] == 1.0
