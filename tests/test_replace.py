"""K2 and K3 under failures, A3 into a bucketed set, O2 for a large k, P6
without a field list."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordmill.functions.runlog import kv_value
from wordmill.operators.rank import count_cutoff, top_ranked, top_words
from wordmill.operators.runlog import discover_keys, kv_rows
from wordmill.plans.inspect import explain_string, physical_lines
from wordmill.sinks.buckets import merge_into, merged, read_bucketed, write_bucketed
from wordmill.sinks.text import mark_staged, stage, write_counts
from wordmill.sources.text import InputNotFound, read_counts, read_lines
from wordmill.store import Store


def counts(spark, **words):
    return spark.createDataFrame(list(words.items()), "word string, count bigint")


def as_dict(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: r["count"] for r in rows}


def hidden(folder):
    return sorted(n for n in os.listdir(folder) if n.startswith(".") and not n.endswith(".crc"))


# -- K2 ------------------------------------------------------------------------

def test_a_failed_job_leaves_the_old_result(spark, scratch):
    out = os.path.join(scratch, "out")
    write_counts(counts(spark, a=1, b=2), out)
    bad = spark.range(1000).select(F.col("id").cast("string").alias("word"), F.when(
        F.col("id") == 999, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("count"))
    with pytest.raises(Exception, match="lost"):
        write_counts(bad, out, mode="overwrite")
    assert as_dict(read_counts(spark, out)) == {"a": 1, "b": 2} and hidden(scratch) == []
    write_counts(counts(spark, c=3), out, mode="overwrite")
    assert as_dict(read_counts(spark, out)) == {"c": 3} and hidden(scratch) == []


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_replacement_that_dies_at_a_rename(spark, scratch, monkeypatch, dies_at):
    out = os.path.join(scratch, "out")
    write_counts(counts(spark, a=1), out)
    real, calls = Store.move, []

    def move(self, source, target):
        calls.append(1)
        if len(calls) == dies_at:
            raise KeyboardInterrupt
        return real(self, source, target)
    with monkeypatch.context() as m:
        m.setattr(Store, "move", move)
        m.setattr(Store, "delete", lambda self, path: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            write_counts(counts(spark, b=2), out, mode="overwrite")
    # Readers see the old one or the new one, whole.
    assert as_dict(read_counts(spark, out)) == ({"a": 1} if dies_at == 1 else {"b": 2})
    write_counts(counts(spark, c=3), out, mode="overwrite")
    assert as_dict(read_counts(spark, out)) == {"c": 3}
    assert not [n for n in hidden(scratch) if ".old-" in n]


def test_a_missing_result_stays_missing(spark, scratch):
    out = os.path.join(scratch, "out")
    with pytest.raises(InputNotFound):
        read_counts(spark, out)
    write_counts(counts(spark, a=1), out, mode="overwrite")
    write_counts(read_counts(spark, out), out, mode="overwrite")  # from itself
    assert as_dict(read_counts(spark, out)) == {"a": 1}
    Store(spark, out).delete(out)
    with pytest.raises(InputNotFound):
        read_counts(spark, out)


# -- K3 ------------------------------------------------------------------------

def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_what_a_crashed_run_left_is_staged_again(spark, scratch):
    path = os.path.join(scratch, "input")
    os.makedirs(os.path.join(path, "_temporary", "0"))
    assert stage(lines(spark, "one"), path)
    assert [r["value"] for r in read_lines(spark, path).collect()] == ["one"]
    assert not stage(lines(spark, "two"), path)
    # Some part files, but no marker: the job died while it committed.
    path = os.path.join(scratch, "half")
    os.makedirs(path)
    with open(os.path.join(path, "part-00000"), "w") as fh:
        fh.write("half\n")
    assert stage(lines(spark, "whole"), path)
    assert [r["value"] for r in read_lines(spark, path).collect()] == ["whole"]
    kept = [n for n in hidden(scratch) if n.startswith(".half.incomplete-")]
    assert len(kept) == 1 and os.listdir(os.path.join(scratch, kept[0])) == ["part-00000"]


def test_a_failed_staging_leaves_nothing(spark, scratch):
    path = os.path.join(scratch, "input")
    bad = spark.range(10).select(F.raise_error(F.lit("lost")).cast("string").alias("value"))
    with pytest.raises(Exception, match="lost"):
        stage(bad, path)
    assert os.listdir(scratch) == []
    assert stage(lines(spark, "one"), path)


def test_complete_inputs_are_kept(spark, scratch):
    by_job = os.path.join(scratch, "job")
    lines(spark, "job").write.text(by_job)
    by_hand = os.path.join(scratch, "hand")
    os.makedirs(by_hand)
    with open(os.path.join(by_hand, "in.txt"), "w") as fh:
        fh.write("hand\n")
    mark_staged(spark, by_hand)
    single = os.path.join(scratch, "single.txt")
    with open(single, "w") as fh:
        fh.write("single\n")
    for path, want in ((by_job, "job"), (by_hand, "hand"), (single, "single")):
        assert not stage(lines(spark, "other"), path)
        assert [r["value"] for r in read_lines(spark, path).collect()] == [want]


def test_two_runs_stage_at_once(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "input")
    real, done = Store.write_new, []

    def slower(self, target, text):
        if not done:
            done.append(1)
            assert stage(lines(spark, "first"), path)
        return real(self, target, text)
    monkeypatch.setattr(Store, "write_new", slower)
    assert not stage(lines(spark, "second"), path)
    assert [r["value"] for r in read_lines(spark, path).collect()] == ["first"] and hidden(scratch) == []


# -- A3 ------------------------------------------------------------------------

def test_merge_into_a_bucketed_set(spark, scratch):
    path = os.path.join(scratch, "set")
    rng = random.Random(1)
    total = Counter({f"w{rng.randint(0, 400)}é'\"": rng.randint(1, 9) for _ in range(300)})
    write_bucketed(spark.createDataFrame(list(total.items()), "word string, count bigint"), path, buckets=4)
    with pytest.raises(FileExistsError):
        write_bucketed(counts(spark, a=1), path)
    for _ in range(3):
        parts = [[(f"w{rng.randint(0, 600)}é'\"", rng.randint(1, 9)) for _ in range(200)] for _ in range(2)]
        merge_into(path, *[spark.createDataFrame([*p, (None, 5)], "word string, count bigint") for p in parts])
        for word, n in [x for p in parts for x in p]:
            total[word] += n
        assert as_dict(read_bucketed(spark, path)) == dict(total)
    merge_into(path, counts(spark, a=1).limit(0))
    assert as_dict(read_bucketed(spark, path)) == dict(total)
    assert len([n for n in os.listdir(path) if n.endswith(".parquet")]) == 4
    assert spark.catalog.listTables() == []


def test_the_old_set_is_not_shuffled(spark, scratch):
    path = os.path.join(scratch, "set")
    old = spark.range(20000).select(F.col("id").cast("string").alias("word"), F.col("id").alias("count"))
    write_bucketed(old, path, buckets=4)
    both = merged(read_bucketed(spark, path), counts(spark, **{"7": 1, "new": 2}))
    plan = physical_lines(both)
    joins = [i for i, ln in enumerate(plan) if "SortMergeJoin" in ln]
    scan = next(i for i, ln in enumerate(plan) if "Bucketed: true" in ln)
    side = plan[joins[0] + 1:scan + 1]
    assert not any("Exchange" in ln for ln in side), plan
    assert sum("Exchange" in ln for ln in plan) == 1, plan
    got = as_dict(both)
    assert got["7"] == 8 and got["new"] == 2 and len(got) == 20001
    assert "Bucketed: true" in explain_string(both)


def test_a_failed_merge_leaves_the_set(spark, scratch):
    path = os.path.join(scratch, "set")
    write_bucketed(counts(spark, a=1), path, buckets=2)
    bad = counts(spark, b=1).withColumn("count", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        merge_into(path, bad)
    assert as_dict(read_bucketed(spark, path)) == {"a": 1}
    with pytest.raises(InputNotFound):
        read_bucketed(spark, scratch)


# -- O2 ------------------------------------------------------------------------

def test_top_ranked_is_top_words(spark):
    rng = random.Random(6)
    rows = [(f"w{i}", int(rng.paretovariate(0.6))) for i in range(6000)] + [("huge", 2**62), ("zero", 0), ("neg", -3)]
    df = spark.createDataFrame(rows, "word string, count bigint").repartition(5)
    for k in (1, 7, 500, 5999, 6003, 10_000):
        got = sorted((r["rank"], r["word"], r["count"]) for r in top_ranked(df, k).collect())
        assert got == sorted((r["rank"], r["word"], r["count"]) for r in top_words(df, k).collect())
    cutoff = count_cutoff(df, 500)
    passed = sum(c >= cutoff for _, c in rows)
    assert 500 <= passed < 6000 and count_cutoff(df, 7000) is None


def test_top_ranked_of_200_000_words(spark):
    n = 300_000
    df = spark.range(0, n, 1, 8).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"),
                                        (F.col("id") * 7919 % n).alias("count"))
    top = top_ranked(df, 200_000)
    got = top.agg(F.count("*"), F.min("count"), F.max("rank"), F.count_if(F.col("rank") == n - F.col("count"))).first()
    assert tuple(got) == (200_000, n - 200_000, 200_000, 200_000)
    assert max(top.rdd.glom().map(len).collect()) < 60_000
    assert not any("TakeOrdered" in ln for ln in physical_lines(top))


# -- P6 ------------------------------------------------------------------------

RECORDS = ["A=1|B=2|A=3", "B=|B=5|C", "=x|A=b=c|D=", None, "", "|||", "Z=9|Y=8|X=7|Z=6"]


def test_rows_of_unknown_keys(spark):
    df = spark.createDataFrame([(i, r, "x") for i, r in enumerate(RECORDS)], "id int, record string, key string")
    got = [(r["id"], r["pos"], r["key"], r["value"])
           for r in kv_rows(df, keep=["id"], pos_col="pos").orderBy("id", "pos").collect()]
    assert got == [(0, 1, "A", "1"), (0, 2, "B", "2"), (1, 1, "B", None), (2, 1, "", "x"), (2, 2, "A", "b=c"),
                   (2, 3, "D", None), (6, 1, "Z", "9"), (6, 2, "Y", "8"), (6, 3, "X", "7")]
    # As with a field list, key by key.
    for key in "ABDXYZ":
        by_list = {r["id"]: r["v"] for r in df.select("id", kv_value("record", key).alias("v")).collect() if r["v"]}
        assert by_list == {i: v for i, _, k, v in got if k == key and v is not None}


def test_long_separators_and_long_records(spark):
    df = spark.createDataFrame([("k1:=1;;k2:=a;b;;k1:=2",)], "record string")
    assert [tuple(r) for r in kv_rows(df, pair_sep=";;", kv_sep=":=").collect()] == [("k1", "1"), ("k2", "a;b")]
    long = "|".join(f"K{i % 30000}={i}" for i in range(60000))
    rows = kv_rows(spark.createDataFrame([(long,)], "record string")).collect()
    assert len(rows) == 30000 and all(r["key"] == f"K{r['value']}" for r in rows)


def test_discover_keys(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "record string")
    got = {r["key"]: tuple(r)[1:] for r in discover_keys(df).collect()}
    assert got["A"] == (2, 2, 1) and got["B"] == (2, 1, 1) and got["D"] == (1, 0, 0) and set(got) == set("ABDXYZ") | {""}
