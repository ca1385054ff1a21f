"""S3 corpus, R9 split report, streaming word count."""

from __future__ import annotations

import os
import time

import pytest

import duckdb
from pyspark.sql import functions as F

from wordmill.operators.text import token_count, word_count
from wordmill.plans.registry import _corpus_sql
from wordmill.sources.corpus import VOCABULARY, corpus, corpus_for
from wordmill.sources.splits import split_report
from wordmill.plans.sweeps import split_size_sweep
from wordmill.sources.text import InputNotFound
from wordmill.streaming.wordcount import latest_counts, start_word_count


def test_corpus_line_shape_and_blocks(spark):
    df = corpus(spark, n_lines=200, block_lines=10, with_ids=True)
    rows = df.orderBy("line_id").collect()
    assert len(rows) == 200 and [r["line_id"] for r in rows] == list(range(200))
    for r in rows:
        assert r["value"].startswith(" ") and not r["value"].startswith("  ")
        words = r["value"][1:].split(" ")
        assert len(words) == 15 and set(words) <= set(VOCABULARY)
    by_block = {}
    for r in rows:
        by_block.setdefault(r["block"], set()).add(r["value"])
    assert len(by_block) == 20 and all(len(v) == 1 for v in by_block.values())


def test_corpus_rounds_up_to_whole_blocks(spark):
    assert corpus(spark, n_lines=25, block_lines=10).count() == 30


def test_corpus_matches_sql_rebuild(spark):
    spark_lines = corpus_for(spark.range(0, 15000).withColumnRenamed("id", "event_id"), "event_id")
    got = sorted((r["line_id"], r["value"]) for r in spark_lines.collect())
    con = duckdb.connect()
    sql = _corpus_sql("SELECT range AS id FROM range(15000)")
    want = sorted((r[0], r[2]) for r in con.execute(sql).fetchall())
    assert got == want
    same = corpus(spark, n_lines=15000, with_ids=True).select("line_id", "value")
    assert sorted((r["line_id"], r["value"]) for r in same.collect()) == got


def test_corpus_full_size_totals(spark):
    df = corpus(spark)  # 4,000,000 lines x 15 words
    r = token_count(df, "value").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("s")).first()
    assert r["s"] == 60_000_000 and r["n"] == 16
    w = word_count(df, "value").agg(F.sum("count").alias("s")).first()
    assert w["s"] == 60_000_000


def test_split_report(spark, scratch):
    path = os.path.join(scratch, "big.txt")
    line = (" ".join(VOCABULARY) + "\n").encode()
    with open(path, "wb") as fh:
        fh.write(line * (9 * 512 * 1024 // len(line)))  # about 4.5 MiB
    rep = {r["split_mb"]: (r["tasks"], r["splits"], r["rows"])
           for r in split_report(spark, path, [1, 2, 4]).collect()}
    n_rows = 9 * 512 * 1024 // len(line)
    assert rep[1] == (5, 5, n_rows) and rep[2] == (3, 3, n_rows) and rep[4] == (2, 2, n_rows)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1024 * 1024)


def test_split_report_reads_many_splits_in_a_task(spark, scratch):
    # What tasks report to the driver must not grow with the number of splits.
    path = os.path.join(scratch, "many.txt")
    with open(path, "wb") as fh:
        fh.write((b"x" * 63 + b"\n") * (4 << 14))  # 4 MiB
    sc = spark.sparkContext
    sc.setJobGroup("split-report-tasks", "")
    try:
        rep = split_report(spark, path, [16], unit_bytes=1024).first()
        tracker = sc.statusTracker()
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("split-report-tasks")
                 for s in tracker.getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert (rep["tasks"], rep["splits"], rep["rows"]) == (256, 256, 4 << 14)
    assert 0 < max(tasks) <= max(sc.defaultParallelism, 8) + 1


def test_streaming_word_count_incremental(spark, scratch):
    inp = os.path.join(scratch, "in")
    os.makedirs(inp)
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    with open(os.path.join(inp, "a.txt"), "w") as fh:
        fh.write("The cat\nthe dog\n")
    q = start_word_count(spark, inp, out, ckpt)
    q.awaitTermination(120)
    first = {r["word"]: r["count"] for r in latest_counts(spark, out).collect()}
    assert first == {"the": 2, "cat": 1, "dog": 1}
    time.sleep(1)
    with open(os.path.join(inp, "b.txt"), "w") as fh:
        fh.write("THE end.\n")
    q = start_word_count(spark, inp, out, ckpt)
    q.awaitTermination(120)
    second = {r["word"]: r["count"] for r in latest_counts(spark, out).collect()}
    assert second == {"the": 3, "cat": 1, "dog": 1, "end": 1}
    # A batch that is still being written has no _SUCCESS file and is not read.
    os.makedirs(os.path.join(out, "epoch-999999999999"))
    assert latest_counts(spark, out).count() == 4


def test_split_size_sweep_report(spark, scratch):
    path = os.path.join(scratch, "big.txt")
    line = (" ".join(VOCABULARY) + "\n").encode()
    with open(path, "wb") as fh:
        fh.write(line * (9 * 512 * 1024 // len(line)))
    rep = split_size_sweep(spark, path, [1, 2], records_path=os.path.join(scratch, "records"))
    got = [(r["i"], r["BLOCKSIZE"], r["BLOCOS"], r["MAP_TASKS"], r["METADATA"])
           for r in rep.orderBy("i").collect()]
    assert got == [(1, 1, 5, 5, 750), (2, 2, 3, 3, 450)]
    assert all(r["TEMPO_WC"] > 0 and r["UPLOAD"] == 0 for r in rep.collect())
    staged = split_size_sweep(spark, path, [1], stage_input=True).first()
    assert staged["UPLOAD"] > 0 and staged["METADATA"] == 150 * staged["BLOCOS"]
    with pytest.raises(InputNotFound):
        split_size_sweep(spark, path + ".missing", [1])


def test_streaming_raw_token_count(spark, scratch):
    inp = os.path.join(scratch, "in")
    os.makedirs(inp)
    with open(os.path.join(inp, "a.txt"), "w") as fh:
        fh.write("The the\tTHE,\nthe\n")
    out = os.path.join(scratch, "out")
    q = start_word_count(spark, inp, out, os.path.join(scratch, "ckpt"), normalized=False)
    q.awaitTermination(120)
    got = {r["word"]: r["count"] for r in latest_counts(spark, out).collect()}
    assert got == {"The": 1, "the": 2, "THE,": 1}
