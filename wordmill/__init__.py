"""wordmill: word-frequency and run-log analytics as Spark DataFrame operators."""

from .operators.rank import numbered, rank_words, sorted_counts, top_words
from .operators.runlog import (Counter, Field, block_footprint, count_matching, extract_counters,
                               log_summary, parse_kv, replica_footprint, run_report, status,
                               to_record)
from .operators.text import (explode_tokens, lines, merge_counts, token_count, word_count,
                             word_count_line_first)
from .sinks.text import append_run, stage, write_counts
from .sources.corpus import corpus, corpus_for
from .sources.text import InputNotFound, read_counts, read_lines

__version__ = "0.1.0"

__all__ = [
    "Counter", "Field", "InputNotFound", "append_run", "block_footprint", "corpus", "corpus_for",
    "count_matching", "explode_tokens", "extract_counters", "lines", "log_summary",
    "merge_counts", "numbered", "parse_kv", "rank_words", "read_counts", "read_lines", "replica_footprint",
    "run_report", "sorted_counts", "stage", "status", "to_record", "token_count", "top_words",
    "word_count", "word_count_line_first", "write_counts",
]
