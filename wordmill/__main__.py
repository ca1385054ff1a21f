"""Command line: ``python -m wordmill <command> ...``

    wordcount <input_path> <output_path> [--raw] [--overwrite] [--partitions N]
    run <source> <input_path> <output_path> [-k 10] [--normalized] [--partitions N]
    corpus <output_path> [--lines N] [--seed S]
    sweep <input_path> <split_mb> [<split_mb> ...]
    merge <output_path> <counts_path> [<counts_path> ...] [--overwrite]
    append <records_path> <record> [<record> ...] [--first] [--key KEY]
    report <layout> <records_path>
    summary <log_path> [<log_path> ...]

``--conf key=value`` (before the command, may be repeated) sets a Spark option.
"""

from __future__ import annotations

import argparse
import sys

USAGE = "usage: python -m wordmill [--conf K=V] {wordcount,run,corpus,sweep,merge,append,report,summary} ..."


# `run` prints its report on the driver, so k is bounded; larger rankings are
# written by `wordcount` and ranked with `rank_words`.
MAX_REPORT_WORDS = 10_000
# What a job log holds on its counter, retry, failure and success lines.
LOG_COUNTERS = {"map_tasks": "Launched map tasks", "reduce_tasks": "Launched reduce tasks"}
LOG_LINES = {"reexec": "Resubmitting", "failed": "failed"}


def _session(conf: dict[str, str]):
    from .session import build_session
    spark = build_session(conf=conf)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="wordmill", usage=USAGE)
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    sub = parser.add_subparsers(dest="cmd")
    wc = sub.add_parser("wordcount")
    wc.add_argument("input_path")
    wc.add_argument("output_path")
    wc.add_argument("--raw", action="store_true", help="raw tokens (no lower-case / strip)")
    wc.add_argument("--overwrite", action="store_true")
    wc.add_argument("--partitions", type=int, default=None, help="deal the lines out first")
    run = sub.add_parser("run")
    run.add_argument("source")
    run.add_argument("input_path")
    run.add_argument("output_path")
    run.add_argument("-k", type=int, default=10)
    run.add_argument("--normalized", action="store_true")
    run.add_argument("--partitions", type=int, default=None)
    gen = sub.add_parser("corpus")
    gen.add_argument("output_path")
    gen.add_argument("--lines", type=int, default=None)
    gen.add_argument("--seed", type=int, default=0)
    sw = sub.add_parser("sweep")
    sw.add_argument("input_path")
    sw.add_argument("sizes", nargs="+", type=int)
    mg = sub.add_parser("merge")
    mg.add_argument("output_path")
    mg.add_argument("inputs", nargs="+")
    mg.add_argument("--overwrite", action="store_true")
    ap = sub.add_parser("append")
    ap.add_argument("records_path")
    ap.add_argument("records", nargs="+")
    ap.add_argument("--first", action="store_true", help="start a new set of records")
    ap.add_argument("--key", default=None, help="name of this append: a retry with it adds nothing twice")
    rp = sub.add_parser("report")
    rp.add_argument("layout")
    rp.add_argument("records_path")
    sm = sub.add_parser("summary")
    sm.add_argument("logs", nargs="+")
    try:
        args = parser.parse_args(argv)
    except SystemExit:
        return 1
    bad = (not args.cmd or not all("=" in c for c in args.conf)
           or args.cmd == "run" and not 0 < args.k <= MAX_REPORT_WORDS)
    if not bad and args.cmd == "report":
        from .operators.runlog import RECORD_LAYOUTS
        bad = args.layout not in RECORD_LAYOUTS
    if bad:
        print(USAGE, file=sys.stderr)
        return 1

    from .sources.text import InputNotFound
    spark = _session(dict(c.split("=", 1) for c in args.conf))
    try:
        if args.cmd == "wordcount":
            from .plans.jobs import wordcount_job
            wordcount_job(spark, args.input_path, args.output_path, normalized=not args.raw,
                          mode="overwrite" if args.overwrite else "errorifexists",
                          partitions=args.partitions)
        elif args.cmd == "run":
            from .plans.jobs import run_wordcount
            res = run_wordcount(spark, args.source, args.input_path, args.output_path,
                                k=args.k, normalized=args.normalized, partitions=args.partitions)
            print(f"job time: {res.elapsed_text}")
            print(f"staging time: {res.staging_seconds:.3f}s")
            print(f"total time: {res.total_text}")
            for r in res.top.orderBy("rank").collect():  # k rows
                print(f"{r['word']}\t{r['count']}")
        elif args.cmd == "corpus":
            from .sources.corpus import TOTAL_LINES, corpus
            n = args.lines or TOTAL_LINES
            corpus(spark, n, seed=args.seed).write.mode("overwrite").text(args.output_path)
        elif args.cmd == "merge":
            from .operators.rank import sorted_counts
            from .operators.text import merge_counts
            from .sinks.text import write_counts
            from .sources.text import read_counts
            merged = merge_counts(*[read_counts(spark, p) for p in args.inputs])
            write_counts(sorted_counts(merged, rank_col=None), args.output_path,
                         mode="overwrite" if args.overwrite else "errorifexists")
        elif args.cmd == "sweep":
            from .plans.sweeps import split_size_sweep
            report = split_size_sweep(spark, args.input_path, args.sizes, stage_input=True)
            for r in report.orderBy("i").collect():  # one row per setting
                print(f"Result {r['i']}: " + ", ".join(
                    f"{k}={r[k]}" for k in report.columns if k not in ("i", "seq")))
        elif args.cmd == "append":
            from .sinks.records import append_records
            rows = spark.createDataFrame(list(enumerate(args.records)), "seq int, value string")
            number = append_records(rows, args.records_path, key=args.key, first=args.first, order=["seq"])
            print(f"append {number}")
        elif args.cmd == "report":
            from .operators.runlog import run_report
            from .sinks.records import is_record_log, read_records
            from .sources.text import read_lines_in_order
            if is_record_log(spark, args.records_path):
                records, order = read_records(spark, args.records_path), ["number", "pos"]
            else:  # a text file of records, one per line
                records, order = read_lines_in_order(spark, args.records_path, "record"), ["at"]
            report = run_report(records, RECORD_LAYOUTS[args.layout], order=order)
            for r in report.orderBy("i").toLocalIterator():
                print(f"Result {r['i']}: " + ", ".join(
                    f"{k}={r[k]}" for k in report.columns if k not in ("i", *order)))
        elif args.cmd == "summary":
            from .operators.runlog import Counter, log_summary
            from .sources.text import read_lines_in_order
            logs = read_lines_in_order(spark, args.logs, at_col="line_no").withColumnRenamed("file", "run")
            summary = log_summary(logs, counters=[Counter(n, m) for n, m in LOG_COUNTERS.items()],
                                  line_counts=LOG_LINES)
            for r in summary.orderBy("run").toLocalIterator():  # one row per log file
                print(", ".join(f"{k}={r[k]}".replace("\n", " ") for k in summary.columns))
    except InputNotFound as exc:
        print(f"input not found: {exc}", file=sys.stderr)
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
