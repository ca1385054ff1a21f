"""Write PLANS.md: the final physical plans of every registered query.

    python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from wordmill.plans.inspect import explain_string  # noqa: E402
from wordmill.plans.registry import QUERIES  # noqa: E402
from wordmill.session import build_session  # noqa: E402

NOTES = {
    "word_count_documents": "A1: the strip regex runs after the first shuffle, on distinct tokens only; "
                            "the pinned filter sits on the final sum.",
    "word_count_conversations": "A1 on conversations: same plan.",
    "word_count_benchmark": "A1 on benchmark: same plan.",
    "word_count_pages": "A1 on the page HTML: same plan.",
    "word_count_line_first": "A1, single-shuffle form: strip per character of the text, one "
                             "aggregation (the streaming form).",
    "token_count_documents": "A2: one hash shuffle; `partial_count` runs before it (map-side combine).",
    "merge_counts": "A3: four raw counts, one merge, and the normalisation of the merged set only.",
    "line_scan": "S2: no shuffle; lines split on LF by the JDK fast path.",
    "text_source_lines": "S1: the text file written from documents, read back by the text source.",
    "counts_round_trip": "K1 then S4: A1 written as TSV, read back (the write is a separate job).",
    "tokenize": "P1: per-row projection, no shuffle.",
    "word_normalize": "P2/P3: distinct raw tokens (partial dedupe before the shuffle), then the strip.",
    "token_rows": "P4: per-row generator, no shuffle.",
    "sorted_counts": "O1: counts sent to literal key ranges once (sizes and rows share the exchange); the "
                     "broadcast side is one row per range.",
    "sorted_tokens": "O1 over A2: same numbering plan over raw tokens.",
    "top_words": "O2: `TakeOrderedAndProject` keeps k rows per task.",
    "rank_words": "O2 over the whole result: the distributed numbering, in rank order.",
    "top_tokens": "O2 over A2.",
    "replace_output": "K2: written, replaced, read back (the writes are separate jobs).",
    "stage_if_absent": "K3: staged twice, the first copy is read back.",
    "append_records": "K4: one record per table appended, read back and parsed.",
    "extract_counters": "P5: the marker test is pushed into the parquet scan; no shuffle.",
    "parse_kv": "P6: per-row regex extraction; no shuffle.",
    "counter_default": "P7: per-row; no shuffle.",
    "elapsed_fraction": "P8: min/max per user, partially aggregated before the shuffle.",
    "elapsed_text": "P9: same shape as P8.",
    "capacity": "P10/P11: per-row arithmetic; no shuffle.",
    "count_matching": "A5: lines of each document, then conditional counts per language, "
                      "partially aggregated.",
    "run_status": "A6: `bool_or` per conversation, partially aggregated.",
    "block_footprint": "R5: one scan, one aggregate column per block size, no join.",
    "block_footprint_kb": "R5 with block sizes in KiB.",
    "replica_footprint": "R6: one scan, one aggregate, rows per factor by `explode`; no join.",
    "numbered_report": "O3: a tiny aggregate numbered by literal key ranges.",
    "run_report": "R7: R5 records written as K=V strings, parsed back, numbered.",
    "report_node_memory": "R7: records of the node-memory layout, parsed and numbered.",
    "report_task_memory": "R7: the task-memory layout.",
    "report_replication": "R7: the replication layout.",
    "report_vcores": "R7: the vcores layout.",
    "log_summary": "R8: one grouped pass; every metric is a partial aggregate.",
    "record_log": "K4 with arrival numbers: commits joined with the records by folder, then R7.",
    "report_arrival": "R7 in order of arrival.",
    "run_summary": "R8, rows of fixed size: one grouped pass, every metric a partial aggregate.",
    "run_numbers": "R8, the numbers as rows: ranked per (run, key range), shifted by the ranges before.",
    "split_report": "R9: a row per split size (each size is a scan of its own, run before).",
    "stage_after_crash": "K3: the staged copy, read back.",
    "merge_into": "A3 into a bucketed set: the set read back (the merge is a separate job; its plan is tested).",
    "kv_rows": "P6 without a field list: per-row, no shuffle.",
    "discover_keys": "P6: keys of a set, partially aggregated.",
    "top_ranked": "O2 for a large k: the cut-off filters the counts, what passes is numbered by ranges.",
    "corpus_generate": "S3: per-row md5 draws keyed by event id; no shuffle.",
    "corpus_word_count": "S3 then A1.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", "wordmill-plans", {"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# PLANS", "",
           "Final physical plans (after adaptive re-planning; `*(n)` marks a whole-stage "
           f"codegen span) of every registered query, run on `{sf_dir}` and written by "
           "`scripts/dump_plans.py`.", ""]
    for name, note in NOTES.items():
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # small at this scale; runs the plan so the final one is shown
        text = explain_string(df, "simple").strip()
        final = text.split("+- == Initial Plan ==")[0].rstrip()
        out += [f"## {name}", "", note, "", "```", final, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
