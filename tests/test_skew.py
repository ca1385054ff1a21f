"""A word that holds a third of all tokens must not reach one reduce task as a
third of the rows: map-side combining sends it once per map task. Checked
from the shuffle-read metrics in Spark's event log (child process, so the
log belongs to its own session)."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import ROOT

SCRIPT = r'''
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from wordmill.session import build_session
from wordmill.operators.text import token_count, word_count
spark = build_session("local[4]", "skew", {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "false",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[2],
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
n = 300_000
# every line: the hot word plus two rare ones -> "hot" is a third of all tokens
lines = spark.range(0, n, 1, 8).select(F.concat_ws(" ", F.lit("hot"),
    F.concat(F.lit("a"), F.col("id").cast("string")),
    F.concat(F.lit("b"), (F.col("id") % 50000).cast("string"))).alias("text"))
spark.sparkContext.setJobDescription("raw")
got = {r["word"]: r["count"] for r in token_count(lines).where("word = 'hot'").collect()}
assert got == {"hot": n}, got
spark.sparkContext.setJobDescription("normalised")
got = {r["word"]: r["count"] for r in word_count(lines).where("word = 'hot'").collect()}
assert got == {"hot": n}, got
spark.sparkContext.setJobDescription("full")
token_count(lines).write.format("noop").mode("overwrite").save()
spark.stop()
'''


def max_reduce_records(logdir: str) -> dict[str, int]:
    """Largest shuffle-read record count of any task, per job description."""
    stage_job: dict[int, str] = {}
    worst: dict[str, int] = {}
    for root, _, files in os.walk(logdir):
        for name in files:
            with open(os.path.join(root, name)) as fh:
                for line in fh:
                    ev = json.loads(line)
                    if ev.get("Event") == "SparkListenerJobStart":
                        desc = (ev.get("Properties") or {}).get("spark.job.description", "?")
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = desc
                    elif ev.get("Event") == "SparkListenerTaskEnd":
                        read = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                        job = stage_job.get(ev["Stage ID"], "?")
                        worst[job] = max(worst.get(job, 0), int(read.get("Total Records Read", 0)))
    return worst


def test_hot_word_reaches_reducers_once_per_map_task():
    logdir = tempfile.mkdtemp(prefix="wordmill-skew-")
    r = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, logdir], capture_output=True,
                       text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    worst = max_reduce_records(logdir)
    # 300,000 "hot" tokens. With a filter on the word (pushed below the
    # aggregation) only the hot word is shuffled: each of the 8 map tasks
    # sends one partial count, and no reduce task reads more than those rows.
    assert 0 < worst["raw"] <= 8 and 0 < worst["normalised"] <= 8, worst
    # The full count: about 600,000 partial rows of rare words spread over 8
    # reducers; without map-side combining the reducer holding "hot" alone
    # would read 300,000 rows.
    assert 0 < worst["full"] < 100_000, worst
