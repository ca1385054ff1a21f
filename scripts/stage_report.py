"""Stage and task times of registered queries, from Spark's event log.

    python scripts/stage_report.py [sf_dir] [name ...]

The event log goes to a fresh scratch folder; no UI or server is used.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from wordmill.plans.registry import QUERIES  # noqa: E402
from wordmill.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["word_count_documents", "token_count_documents", "sorted_counts"]
    logdir = tempfile.mkdtemp(prefix="wordmill-events-")
    spark = build_session("local[8]", "wordmill-stages", {
        "spark.sql.shuffle.partitions": "16",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logdir,
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        spark.sparkContext.setJobDescription(name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stages: dict[int, dict] = {}
    job_of_stage: dict[int, str] = {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "?")
                    for sid in ev.get("Stage IDs", []):
                        job_of_stage[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    sid = ev["Stage ID"]
                    info = ev["Task Info"]
                    st = stages.setdefault(sid, {"tasks": 0, "max_ms": 0, "sum_ms": 0})
                    ms = info["Finish Time"] - info["Launch Time"]
                    st["tasks"] += 1
                    st["sum_ms"] += ms
                    st["max_ms"] = max(st["max_ms"], ms)
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    st = stages.setdefault(info["Stage ID"], {"tasks": 0, "max_ms": 0, "sum_ms": 0})
                    st["name"] = info["Stage Name"].split(" at ")[0]
                    st["wall_ms"] = info.get("Completion Time", 0) - info.get("Submission Time", 0)
    print(f"{'query':24s} {'stage':>5s} {'tasks':>5s} {'wall':>7s} {'max task':>8s} {'sum':>7s}")
    for sid in sorted(stages):
        st = stages[sid]
        print(f"{job_of_stage.get(sid, '?')[:24]:24s} {sid:5d} {st['tasks']:5d} "
              f"{st.get('wall_ms', 0):6d}ms {st['max_ms']:6d}ms {st['sum_ms']:6d}ms")


if __name__ == "__main__":
    main()
