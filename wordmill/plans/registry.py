"""The registered queries (one per operator of the inventory) and, for each,
an equivalent SQL text that DuckDB runs on the same parquet tables.

Every query reads the given tables (or frames Spark derives from them), so
its work grows with them. Column names and types are aligned with the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import runlog as R
from ..functions import text as T
from ..operators import rank, runlog
from ..operators import text as ops
from ..sources import corpus as corpus_src
from ..sinks.buckets import merge_into, read_bucketed, write_bucketed
from ..sinks.records import append_records, read_records
from ..sinks.text import append_run, stage, write_counts
from ..session import scratch_path
from ..sources.splits import split_report
from ..sources.tables import read_table, scan_partitions
from ..sources.text import read_counts, read_lines

Query = Callable[[SparkSession, str], DataFrame]

# Text column of each table that the word counts read.
TEXT_TABLES = {
    "documents": "text",
    "conversations": "text",
    "benchmark": "text",
    "pages": "html",
}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
          spread: bool = False) -> DataFrame:
    """A driver table; the rows of text-heavy queries (``spread``) are dealt
    out first if the session asks for it (``sources.tables.SCAN_PARTITIONS``)."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", columns,
                      scan_partitions(spark) if spread else None)


def _page_query(url_col: str = "url"):
    return F.regexp_extract(F.col(url_col), r"\?([^#]*)", 1)


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def q_word_count(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        col = TEXT_TABLES[name]
        return ops.word_count(table(spark, sf_dir, name, [col], True), col)
    return run


def q_token_count_documents(spark, sf_dir):
    return ops.token_count(table(spark, sf_dir, "documents", ["text"], True), "text")


def q_line_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"], True)
    return ops.lines(docs, "text", keep=["doc_id"])


def q_tokenize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"], True)
    return docs.select("doc_id", ops.tokens_per_row("text").cast("long").alias("n_tokens"))


def q_word_normalize(spark, sf_dir):
    tokens = ops.explode_tokens(table(spark, sf_dir, "documents", ["text"], True), "text", keep=[])
    return tokens.distinct().select("token", T.normalize("token").alias("word"))


def q_token_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"], True)
    return ops.explode_tokens(docs, "text", keep=["doc_id"], pos_col="pos")


def q_merge_counts(spark, sf_dir):
    # Raw counts of four tables are merged, and only the merged set is normalised.
    parts = [ops.token_count(table(spark, sf_dir, t, [c], True), c) for t, c in TEXT_TABLES.items()]
    return ops.normalize_counts(ops.merge_counts(*parts))


def q_sorted_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"], True)
    return rank.sorted_counts(ops.word_count(docs, "text"))


def q_top_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"], True)
    return rank.top_words(ops.word_count(docs, "text"), k=10)


def q_rank_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"], True)
    return rank.rank_words(ops.word_count(docs, "text"))


def q_word_count_line_first(spark, sf_dir):
    return ops.word_count_line_first(table(spark, sf_dir, "documents", ["text"], True), "text")


def q_sorted_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"], True)
    return rank.sorted_counts(ops.token_count(docs, "text"))


def q_top_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"], True)
    return rank.top_words(ops.token_count(docs, "text"), k=10)


def q_counts_round_trip(spark, sf_dir):
    # K1 then S4: the counts go through a tab-separated file and back.
    path = f"{scratch_path(spark, 'counts')}/out"
    write_counts(ops.word_count(table(spark, sf_dir, "documents", ["text"], True), "text"), path)
    return read_counts(spark, path)


def q_replace_output(spark, sf_dir):
    # K2: the counts of one table are replaced by those of another.
    path = f"{scratch_path(spark, 'replace')}/out"
    write_counts(ops.word_count(table(spark, sf_dir, "benchmark", ["text"]), "text"), path)
    write_counts(ops.word_count(table(spark, sf_dir, "conversations", ["text"], True), "text"), path,
                 mode="overwrite")
    return read_counts(spark, path)


def q_stage_if_absent(spark, sf_dir):
    # K3: the first staged input stays; staging another one is a no-op.
    path = f"{scratch_path(spark, 'stage')}/in"
    stage(table(spark, sf_dir, "conversations", ["text"]), path)
    stage(table(spark, sf_dir, "benchmark", ["text"]), path)
    return read_lines(spark, path, line_col="line")


def q_append_records(spark, sf_dir):
    # K4: one record per text table, the first replacing an earlier set.
    path = f"{scratch_path(spark, 'records')}/records"
    first = next(iter(TEXT_TABLES))
    for name, col in [(first, TEXT_TABLES[first]), *TEXT_TABLES.items()]:  # the second one starts anew
        size = table(spark, sf_dir, name, [col]).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(col)), F.lit(0)).alias("b"))
        record = size.select(runlog.to_record(
            [("TABELA", F.lit(name)), ("LINHAS", "n"), ("BYTES", "b")]).alias("value"))
        append_run(record, path, first=(name == first))
    fields = [runlog.Field("TABELA"), runlog.Field("LINHAS", "bigint"), runlog.Field("BYTES", "bigint")]
    return runlog.parse_kv(read_lines(spark, path, line_col="record"), fields)


def q_text_source_lines(spark, sf_dir):
    # The documents written as a text file (one value per row, each
    # followed by LF), then read back line by line by the text source.
    path = f"{scratch_path(spark, 'text')}/out"
    table(spark, sf_dir, "documents", ["text"]).write.text(path)
    return read_lines(spark, path, line_col="line")


def q_extract_counters(spark, sf_dir):
    # Stand-in log lines: a page's URL and its number, marker "page="
    # (FIXTURES.md §7), so a line holds two numbers.
    pages = table(spark, sf_dir, "pages").select("page_id", _numbered_url().alias("line"))
    return runlog.extract_counters(pages, "page=", col="line", keep=["page_id"])


def _numbered_url():
    return F.concat("url", F.lit(" n="), F.col("page_id").cast("string"))


def q_parse_kv(spark, sf_dir):
    # Stand-in records: URL query strings, pairs joined by "&".
    pages = table(spark, sf_dir, "pages").select("page_id", _page_query().alias("query"))
    fields = [runlog.Field("page", "int"), runlog.Field("ref"), runlog.Field("utm_source")]
    return runlog.parse_kv(pages, fields, col="query", pair_sep="&", kv_sep="=", keep=["page_id"])


def q_counter_default(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", _page_query().alias("query"))
    fields = [runlog.Field("page", "bigint", default=1, name="page_no")]
    return runlog.parse_kv(pages, fields, col="query", pair_sep="&", kv_sep="=", keep=["page_id"])


def q_elapsed_fraction(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    spans = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                      F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return spans.select("user_id", "n_events", R.elapsed_seconds("t0", "t1").alias("elapsed_s"))


def q_elapsed_text(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    spans = ev.groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return spans.select("user_id",
                        R.elapsed_whole_seconds("t0", "t1").alias("elapsed_s"),
                        R.elapsed_text("t0", "t1").alias("elapsed"))


def q_capacity(spark, sf_dir):
    # Stand-in setting: each document's n_chars is read as a node memory (MB)
    # and as a vcore count, so the arithmetic runs over a whole table.
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("n_chars").alias("memory_mb"),
                       R.max_containers("n_chars").alias("containers"),
                       R.vcores_total("n_chars").alias("vcores_total"))


def _doc_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["lang", "text"], True)
    return ops.lines(docs, "text", keep=["lang"], pos_col=None)


def q_count_matching(spark, sf_dir):
    markers = {"license_lines": "License", "released_lines": runlog.starts_with("Released")}
    return runlog.count_matching(_doc_lines(spark, sf_dir), markers, col="line", by=["lang"])


def q_run_status(spark, sf_dir):
    # Stand-in runs: conversations; a run succeeds when a turn holds "The ".
    conv = table(spark, sf_dir, "conversations")
    return runlog.status(conv, "The ", col="text", by=["conv_id"])


# Block sizes small against the texts, so that each gives its own block count.
SMALL_BLOCKS_KB = (1, 4, 16)


def q_block_footprint(spark, sf_dir):
    return runlog.block_footprint(table(spark, sf_dir, "documents"), "text", by=["lang"])


def q_block_footprint_kb(spark, sf_dir):
    return runlog.block_footprint(table(spark, sf_dir, "documents"), "text", sizes=SMALL_BLOCKS_KB,
                                  by=["lang"], size_col="block_size_kb", unit_bytes=1024)


def q_replica_footprint(spark, sf_dir):
    return runlog.replica_footprint(table(spark, sf_dir, "documents"), "text", by=["lang"])


def q_numbered_report(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    report = labels.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n_docs"))
    return rank.numbered(report, ["quality", "toxic"], "i")


def q_run_report(spark, sf_dir):
    # Records written from the block-size sweep over documents (R5 -> K4),
    # then parsed back and numbered.
    sweep = runlog.block_footprint(table(spark, sf_dir, "documents"), "text", sizes=SMALL_BLOCKS_KB,
                                   size_col="size", unit_bytes=1024)
    records = sweep.select(
        F.col("size").alias("seq"),
        runlog.to_record([("BLOCKSIZE", "size"), ("BLOCOS", "blocks"),
                          ("METADATA", "metadata_bytes")]).alias("record"))
    fields = [
        runlog.Field("BLOCKSIZE", "int"),
        runlog.Field("BLOCOS", "int"),
        # `|| echo "$NUM_BLOCOS"`: a missing map-task count falls back to the blocks.
        runlog.Field("MAP_TASKS", "int", default=R.kv_value("record", "BLOCOS")),
        runlog.Field("METADATA", "bigint"),
    ]
    return runlog.run_report(records, fields, order=["seq"])


# One setting per language: its documents stand in for a run, their number for
# the map tasks, their characters for a memory or vcore setting.
def _settings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"),
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
        F.count_if(F.col("text").contains("License")).alias("reexec"),
        F.count_if(F.col("text").contains("the")).alias("failed")).withColumns({
            "setting": (F.col("chars") % 10_000).cast("long"),
            "seconds": (F.col("n") / F.lit(8)).cast("decimal(20,3)")})


def q_layout(layout: str, columns: Callable[[], dict]) -> Query:
    """R7 for one of the record layouts: write the records, parse, number."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = runlog.RECORD_LAYOUTS[layout]
        given = columns()  # expressions need a session
        values = [(f.key, given[f.key]) for f in fields if f.key in given]
        records = _settings(spark, sf_dir).select("lang", runlog.to_record(values).alias("record"))
        return runlog.run_report(records, fields, order=["lang"])
    return run


def q_log_summary(spark, sf_dir):
    # Stand-in job logs: the page URLs of each host in page order; a run
    # succeeds when it has an .html page.
    host = F.regexp_extract("url", r"//([^/]*)", 1)
    logs = table(spark, sf_dir, "pages").select(
        host.alias("host"), F.col("page_id").alias("line_no"), _numbered_url().alias("line"))
    return runlog.log_summary(
        logs, by=["host"], col="line", order_col="line_no",
        counters=[runlog.Counter("pages", "page=", default="N/A"), runlog.Counter("feeds", "=feed", default=0)],
        line_counts={"tops": "#top", "resubmits": "Resubmitting"}, success_marker=".html")


def q_record_log(spark, sf_dir):
    # K4 with arrival numbers: records of unequal length, one append each; the
    # first starts a new set, and every append is tried twice.
    path = f"{scratch_path(spark, 'log')}/records"
    append_records(table(spark, sf_dir, "benchmark", ["text"]).limit(1).select(F.lit("OLD=1").alias("value")), path)
    for i, name in enumerate(ARRIVAL):
        col = TEXT_TABLES[name]
        size = table(spark, sf_dir, name, [col]).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(col)), F.lit(0)).alias("b"))
        record = size.select(runlog.to_record([("TABELA", F.lit(name)), ("LINHAS", "n"), ("BYTES", "b")]).alias("value"))
        for _ in range(2):
            append_records(record, path, key=name, first=i == 0)
    fields = [runlog.Field("TABELA"), runlog.Field("LINHAS", "bigint"), runlog.Field("BYTES", "bigint")]
    return runlog.run_report(read_records(spark, path), fields, order=["number", "pos"]).drop("pos")


def q_report_arrival(spark, sf_dir):
    # R7 in order of arrival: one append per block size, in no sorted order,
    # with a record per language.
    path = f"{scratch_path(spark, 'log')}/records"
    docs = table(spark, sf_dir, "documents")
    for size in ARRIVAL_KB:
        sweep = runlog.block_footprint(docs, "text", sizes=[size], by=["lang"], size_col="size", unit_bytes=1024)
        append_records(sweep.select("lang", runlog.to_record(
            [("BLOCKSIZE", "size"), ("LANG", "lang"), ("BLOCOS", "blocks"), ("METADATA", "metadata_bytes")]
        ).alias("value")), path, order=["lang"])
    fields = [runlog.Field("BLOCKSIZE", "int"), runlog.Field("LANG"), runlog.Field("BLOCOS", "int"),
              runlog.Field("MAP_TASKS", "int", default=R.kv_value("record", "BLOCOS")), runlog.Field("METADATA", "bigint")]
    return runlog.run_report(read_records(spark, path), fields, order=["number", "pos"]).drop("number", "pos")


# Tables and block sizes in the order in which their records arrive.
ARRIVAL = ("pages", "benchmark", "documents", "conversations")
ARRIVAL_KB = (16, 1, 4)


def _host_logs(spark, sf_dir):
    # The stand-in job logs of q_log_summary.
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"//([^/]*)", 1).alias("host"), F.col("page_id").alias("line_no"), _numbered_url().alias("line"))


_HOST_COUNTERS = [runlog.Counter("pages", "page=", default="N/A"), runlog.Counter("feeds", "=feed", default=0)]


def q_run_summary(spark, sf_dir):
    return runlog.run_summary(
        _host_logs(spark, sf_dir), by=["host"], counters=_HOST_COUNTERS,
        line_counts={"tops": "#top", "resubmits": "Resubmitting"}, success_marker=".html")


def q_run_numbers(spark, sf_dir):
    return runlog.run_numbers(_host_logs(spark, sf_dir), _HOST_COUNTERS, by=["host"])


# The documents as text files of 200 lines each, and split sizes smaller than them.
FILE_DOCS, SPLIT_KB = 200, (64, 128, 256)


def q_split_report(spark, sf_dir):
    # R9 over a written copy. How many tasks Spark plans depends on the
    # cluster; the splits that held rows do not.
    path = f"{scratch_path(spark, 'splits')}/in"
    one_line = F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    (docs.select(F.floor(F.col("doc_id") / FILE_DOCS).alias("file"), "doc_id", one_line.alias("value"))
     .repartition("file").sortWithinPartitions("file", "doc_id").drop("doc_id")
     .write.partitionBy("file").text(path))
    return split_report(spark, path, SPLIT_KB, size_col="split_kb", unit_bytes=1024).drop("tasks")


def q_stage_after_crash(spark, sf_dir):
    # K3: a folder without a marker, as a job leaves that dies while it
    # commits, is staged again; after that nothing is.
    path = f"{scratch_path(spark, 'stage')}/in"
    (table(spark, sf_dir, "benchmark", ["text"]).write
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(path))
    stage(table(spark, sf_dir, "conversations", ["text"]), path)
    stage(table(spark, sf_dir, "benchmark", ["text"]), path)
    return read_lines(spark, path, line_col="line")


def q_merge_into(spark, sf_dir):
    # A3: the raw counts of the other tables merged into the bucketed set of one.
    path = f"{scratch_path(spark, 'set')}/counts"
    raw = {t: ops.token_count(table(spark, sf_dir, t, [c], True), c) for t, c in TEXT_TABLES.items()}
    write_bucketed(raw.pop("documents"), path, buckets=16)
    merge_into(path, *raw.values())
    return read_bucketed(spark, path)


def _unlisted_records(spark, sf_dir):
    # Stand-in records with unknown and repeated keys: URL query strings and more.
    number = F.col("page_id").cast("string")
    return table(spark, sf_dir, "pages").select("page_id", F.concat(
        _page_query(), F.lit("&page=0&k"), (F.col("page_id") % 7).cast("string"), F.lit("="), number,
        F.lit("&ref=again&empty=&word")).alias("record"))


def q_kv_rows(spark, sf_dir):
    return runlog.kv_rows(_unlisted_records(spark, sf_dir), pair_sep="&", keep=["page_id"])


def q_discover_keys(spark, sf_dir):
    return runlog.discover_keys(_unlisted_records(spark, sf_dir), pair_sep="&")


LARGE_K = 20_000


def q_top_ranked(spark, sf_dir):
    return rank.top_ranked(ops.word_count(table(spark, sf_dir, "documents", ["text"], True), "text"), LARGE_K)


def q_corpus_generate(spark, sf_dir):
    # One corpus line per event id, so the corpus grows with the table.
    return corpus_src.corpus_for(table(spark, sf_dir, "events"), "event_id")


def q_corpus_word_count(spark, sf_dir):
    lines = corpus_src.corpus_for(table(spark, sf_dir, "events"), "event_id")
    return ops.word_count(lines, "value")


QUERIES: dict[str, Query] = {
    "word_count_documents": q_word_count("documents"),
    "word_count_conversations": q_word_count("conversations"),
    "word_count_benchmark": q_word_count("benchmark"),
    "word_count_pages": q_word_count("pages"),
    "token_count_documents": q_token_count_documents,
    "line_scan": q_line_scan,
    "tokenize": q_tokenize,
    "word_normalize": q_word_normalize,
    "token_rows": q_token_rows,
    "merge_counts": q_merge_counts,
    "sorted_counts": q_sorted_counts,
    "top_words": q_top_words,
    "rank_words": q_rank_words,
    "word_count_line_first": q_word_count_line_first,
    "sorted_tokens": q_sorted_tokens,
    "top_tokens": q_top_tokens,
    "counts_round_trip": q_counts_round_trip,
    "replace_output": q_replace_output,
    "stage_if_absent": q_stage_if_absent,
    "append_records": q_append_records,
    "text_source_lines": q_text_source_lines,
    "extract_counters": q_extract_counters,
    "parse_kv": q_parse_kv,
    "counter_default": q_counter_default,
    "elapsed_fraction": q_elapsed_fraction,
    "elapsed_text": q_elapsed_text,
    "capacity": q_capacity,
    "count_matching": q_count_matching,
    "run_status": q_run_status,
    "block_footprint": q_block_footprint,
    "block_footprint_kb": q_block_footprint_kb,
    "replica_footprint": q_replica_footprint,
    "numbered_report": q_numbered_report,
    "run_report": q_run_report,
    "report_node_memory": q_layout("node_memory", lambda: {
        "MEMORIA": "setting", "MAP_TASKS": "n", "TEMPO_WC": "seconds",
        "CONTAINERS_MAX": R.max_containers("setting")}),
    "report_task_memory": q_layout("task_memory", lambda: {
        "MAP_MB": "setting", "REDUCE_MB": F.col("setting") * 2, "MAP_TASKS": "n", "REDUCE_TASKS": F.lit(1),
        "REEXEC": "reexec", "FAILED": "failed", "TEMPO_WC": "seconds"}),
    "report_replication": q_layout("replication", lambda: {
        "REPLICACAO": F.lit(2), "UPLOAD": "seconds", "LEITURA": "seconds",
        "ESPACO_USADO": F.concat(F.col("bytes").cast("string"), F.lit(" B")),
        "ESPACO_TOTAL": F.concat((F.col("bytes") * 2).cast("string"), F.lit(" B")), "DATANODES": F.lit(2)}),
    "report_vcores": q_layout("vcores", lambda: {
        "VCORES": "setting", "MAP_TASKS": "n", "REDUCE_TASKS": F.lit(1), "TEMPO_WC": "seconds",
        "VCORES_TOTAL": R.vcores_total("setting")}),
    "log_summary": q_log_summary,
    "record_log": q_record_log,
    "report_arrival": q_report_arrival,
    "run_summary": q_run_summary,
    "run_numbers": q_run_numbers,
    "split_report": q_split_report,
    "stage_after_crash": q_stage_after_crash,
    "merge_into": q_merge_into,
    "kv_rows": q_kv_rows,
    "discover_keys": q_discover_keys,
    "top_ranked": q_top_ranked,
    "corpus_generate": q_corpus_generate,
    "corpus_word_count": q_corpus_word_count,
}


# --------------------------------------------------------------------------
# DuckDB side (written from the semantics, literal per-token form)
# --------------------------------------------------------------------------

WS = r"[ \t\n\r\f]+"
STRIP = "[^a-zA-Z0-9]"


def _tokens_sql(table_name: str, col: str) -> str:
    return f"SELECT unnest(regexp_split_to_array({col}, '{WS}')) AS tok FROM {table_name}"


def _word_count_sql(table_name: str, col: str) -> str:
    return (
        "SELECT word, count(*) AS count FROM ("
        f"SELECT regexp_replace(lower(tok), '{STRIP}', '', 'g') AS word "
        f"FROM ({_tokens_sql(table_name, col)}) t) w "
        "WHERE word <> '' GROUP BY word"
    )


def _lines_array_sql(col: str) -> str:
    return (f"CASE WHEN {col} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array("
            f"regexp_replace({col}, '(\\r\\n|\\n|\\r)$', ''), '\\r\\n|\\n|\\r') END")


def _kv_sql(col: str, key: str, sep: str) -> str:
    s = "\\|" if sep == "|" else sep
    return f"NULLIF(regexp_extract({col}, '(?:^|{s}){key}=([^{s}]*)', 1), '')"


# What the text sink writes for one row: the value (a null as an empty
# string) followed by LF.
_TEXT_FILE_VALUE = "(coalesce(text, '') || chr(10))"
_PAGES_Q = "SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages"
_SIZES = "(VALUES (32), (64), (128)) s(sz)"
_SMALL_SIZES = "(VALUES " + ", ".join(f"({k})" for k in SMALL_BLOCKS_KB) + ") s(sz)"
_NUMBERED_URL = "(url || ' n=' || CAST(page_id AS VARCHAR))"
_SETTINGS = (
    "SELECT lang, count(*) AS n, CAST(sum(n_chars) % 10000 AS BIGINT) AS setting, "
    "CAST(round(count(*) / 8, 3) AS DOUBLE) AS seconds, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS bytes, "
    "count(*) FILTER (WHERE contains(text, 'License')) AS reexec, "
    "count(*) FILTER (WHERE contains(text, 'the')) AS failed FROM documents GROUP BY lang")


def _footprint_sql(sizes: str, unit: int, name: str) -> str:
    return (f"SELECT lang, CAST(sz AS INTEGER) AS {name}, files, bytes, blocks, "
            "blocks * 150 AS metadata_bytes FROM ("
            "SELECT d.lang, s.sz, count(*) AS files, "
            "CAST(coalesce(sum(strlen(d.text)), 0) AS BIGINT) AS bytes, "
            f"CAST(coalesce(sum(ceil(strlen(d.text) / (s.sz * {unit}))), 0) AS BIGINT) AS blocks "
            f"FROM documents d CROSS JOIN {sizes} GROUP BY d.lang, s.sz) g")


def _layout_sql(columns: str) -> str:
    return f"SELECT lang, {columns}, row_number() OVER (ORDER BY lang) AS i FROM ({_SETTINGS}) s"


def _counter_sql(name: str, marker: str, default: str) -> str:
    """All numbers of a host's marker lines in page order, and the first."""
    found = (f"array_to_string(flatten(list(regexp_extract_all({_NUMBERED_URL}, '=(\\d+)', 1) ORDER BY page_id) "
             f"FILTER (WHERE contains({_NUMBERED_URL}, '{marker}'))), chr(10))")
    text = f"coalesce(nullif({found}, ''), '{default}')"
    return f"{text} AS {name}, TRY_CAST(string_split({text}, chr(10))[1] AS BIGINT) AS {name}_value"


def _numbers_sql(marker: str) -> str:
    return (f"flatten(list(regexp_extract_all({_NUMBERED_URL}, '=(\\d+)', 1) ORDER BY page_id) "
            f"FILTER (WHERE contains({_NUMBERED_URL}, '{marker}')))")


def _first_sql(name: str, marker: str, default: str) -> str:
    """The first number of a host, as text and BIGINT, and how many it has."""
    found = _numbers_sql(marker)
    return (f"coalesce(({found})[1], '{default}') AS {name}, "
            f"TRY_CAST(coalesce(({found})[1], '{default}') AS BIGINT) AS {name}_value, "
            f"CAST(coalesce(len({found}), 0) AS BIGINT) AS {name}_count")


_HOST = "regexp_extract(url, '//([^/]*)', 1)"
_UNLISTED = (
    "SELECT page_id, e.nth AS nth, substr(e.pair, 1, strpos(e.pair, '=') - 1) AS key, "
    "nullif(substr(e.pair, strpos(e.pair, '=') + 1), '') AS value FROM ("
    "SELECT page_id, unnest([{'pair': x, 'nth': i} FOR x, i IN string_split(regexp_extract(url, '\\?([^#]*)', 1) "
    "|| '&page=0&k' || (page_id % 7) || '=' || page_id || '&ref=again&empty=&word', '&')]) AS e FROM pages) u "
    "WHERE contains(e.pair, '=')")
_UNLISTED_ROWS = (f"SELECT page_id, key, value FROM ({_UNLISTED}) p "
                  "QUALIFY row_number() OVER (PARTITION BY page_id, key ORDER BY nth) = 1")

_FACTORS = "(VALUES (1), (2), (3)) f(r)"


def _corpus_sql(ids_sql: str) -> str:
    vocab = "[" + ", ".join(f"'{w}'" for w in corpus_src.VOCABULARY) + "]"
    n = len(corpus_src.VOCABULARY)
    words = ", ".join(
        f"{vocab}[(('0x' || substr(md5('0:' || CAST(block AS VARCHAR) || ':{j}'), 1, 8))"
        f"::BIGINT % {n}) + 1]"
        for j in range(corpus_src.WORDS_PER_LINE))
    return (f"SELECT line_id, block, ' ' || concat_ws(' ', {words}) AS value FROM ("
            f"SELECT id AS line_id, CAST(floor(id / {corpus_src.BLOCK_LINES}) AS BIGINT) AS block "
            f"FROM ({ids_sql}) i) b")


_CORPUS_EVENTS = _corpus_sql("SELECT event_id AS id FROM events")

ORACLE_SQL: dict[str, str] = {
    **{f"word_count_{t}": _word_count_sql(t, c) for t, c in TEXT_TABLES.items()},
    "token_count_documents": (
        f"SELECT tok AS word, count(*) AS count FROM ({_tokens_sql('documents', 'text')}) t "
        "WHERE tok <> '' GROUP BY tok"),
    "line_scan": (
        "SELECT doc_id, generate_subscripts(arr, 1) AS line_no, unnest(arr) AS line FROM ("
        f"SELECT doc_id, {_lines_array_sql('text')} AS arr FROM documents) s"),
    "tokenize": (
        "SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, "
        f"'{WS}'), lambda x: x <> '')) AS BIGINT) AS n_tokens FROM documents"),
    "word_normalize": (
        f"SELECT DISTINCT tok AS token, regexp_replace(lower(tok), '{STRIP}', '', 'g') AS word "
        f"FROM ({_tokens_sql('documents', 'text')}) t WHERE tok <> ''"),
    "token_rows": (
        "SELECT doc_id, generate_subscripts(arr, 1) AS pos, unnest(arr) AS token FROM ("
        f"SELECT doc_id, list_filter(regexp_split_to_array(text, '{WS}'), lambda x: x <> '') "
        "AS arr FROM documents) s"),
    "merge_counts": (
        "SELECT word, CAST(sum(count) AS BIGINT) AS count FROM ("
        + " UNION ALL ".join(f"({_word_count_sql(t, c)})" for t, c in TEXT_TABLES.items())
        + ") u GROUP BY word"),
    "sorted_counts": (
        "SELECT word, count, row_number() OVER (ORDER BY word) AS rank FROM ("
        f"{_word_count_sql('documents', 'text')}) c"),
    "top_words": (
        "SELECT word, count, row_number() OVER (ORDER BY count DESC, word || chr(9) DESC) AS rank "
        f"FROM ({_word_count_sql('documents', 'text')}) c "
        "ORDER BY count DESC, word || chr(9) DESC LIMIT 10"),
    "word_count_line_first": _word_count_sql("documents", "text"),
    "sorted_tokens": (
        "SELECT word, count, row_number() OVER (ORDER BY word) AS rank FROM ("
        f"SELECT tok AS word, count(*) AS count FROM ({_tokens_sql('documents', 'text')}) t "
        "WHERE tok <> '' GROUP BY tok) c"),
    "top_tokens": (
        "SELECT word, count, row_number() OVER (ORDER BY count DESC, word || chr(9) DESC) AS rank "
        f"FROM (SELECT tok AS word, count(*) AS count FROM ({_tokens_sql('documents', 'text')}) t "
        "WHERE tok <> '' GROUP BY tok) c ORDER BY count DESC, word || chr(9) DESC LIMIT 10"),
    "counts_round_trip": _word_count_sql("documents", "text"),
    "text_source_lines": (
        f"SELECT unnest({_lines_array_sql(_TEXT_FILE_VALUE)}) AS line FROM documents"),
    "extract_counters": (
        "SELECT page_id, pos, TRY_CAST(v AS BIGINT) AS value FROM ("
        "SELECT page_id, generate_subscripts(arr, 1) AS pos, unnest(arr) AS v FROM ("
        f"SELECT page_id, regexp_extract_all({_NUMBERED_URL}, '=(\\d+)', 1) AS arr FROM pages "
        "WHERE contains(url, 'page=')) a) b"),
    "parse_kv": (
        f"SELECT page_id, TRY_CAST({_kv_sql('q', 'page', '&')} AS INTEGER) AS page, "
        f"{_kv_sql('q', 'ref', '&')} AS ref, {_kv_sql('q', 'utm_source', '&')} AS utm_source "
        f"FROM ({_PAGES_Q}) p"),
    "counter_default": (
        f"SELECT page_id, "
        f"TRY_CAST(COALESCE({_kv_sql('q', 'page', '&')}, '1') AS BIGINT) AS page_no "
        f"FROM ({_PAGES_Q}) p"),
    "elapsed_fraction": (
        "SELECT user_id, count(*) AS n_events, "
        "CAST(date_diff('microsecond', min(ts), max(ts)) AS DOUBLE) / 1e6 AS elapsed_s "
        "FROM events GROUP BY user_id"),
    "elapsed_text": (
        "SELECT user_id, d AS elapsed_s, CAST(d // 60 AS VARCHAR) || 'm ' || "
        "CAST(d % 60 AS VARCHAR) || 's' AS elapsed FROM ("
        "SELECT user_id, (epoch_us(max(ts)) // 1000000) - (epoch_us(min(ts)) // 1000000) AS d "
        "FROM events GROUP BY user_id) s"),
    "capacity": (
        "SELECT doc_id, n_chars AS memory_mb, "
        "greatest(CAST(floor((n_chars * 2 - 512) / 1024) AS BIGINT), 1) AS containers, "
        "n_chars * 2 AS vcores_total FROM documents"),
    "count_matching": (
        "SELECT lang, count(*) AS n_lines, "
        "count(*) FILTER (WHERE contains(line, 'License')) AS license_lines, "
        "count(*) FILTER (WHERE starts_with(line, 'Released')) AS released_lines FROM ("
        f"SELECT lang, unnest({_lines_array_sql('text')}) AS line FROM documents) l GROUP BY lang"),
    "run_status": (
        "SELECT conv_id, CASE WHEN bool_or(contains(text, 'The ')) THEN 'SUCCESS' "
        "ELSE 'FAILURE' END AS status FROM conversations GROUP BY conv_id"),
    "block_footprint": _footprint_sql(_SIZES, 1048576, "block_size_mb"),
    "block_footprint_kb": _footprint_sql(_SMALL_SIZES, 1024, "block_size_kb"),
    "replica_footprint": (
        "SELECT lang, CAST(r AS INTEGER) AS replication, logical_bytes, "
        "logical_bytes * r AS total_bytes FROM ("
        "SELECT d.lang, f.r, CAST(coalesce(sum(strlen(d.text)), 0) AS BIGINT) AS logical_bytes "
        f"FROM documents d CROSS JOIN {_FACTORS} GROUP BY d.lang, f.r) g"),
    "numbered_report": (
        "SELECT quality, toxic, count(*) AS n_docs, "
        "row_number() OVER (ORDER BY quality NULLS FIRST, toxic NULLS FIRST) AS i "
        "FROM labels GROUP BY quality, toxic"),
    "run_report": (
        "WITH fp AS (SELECT s.sz, "
        "CAST(coalesce(sum(ceil(strlen(d.text) / (s.sz * 1024))), 0) AS BIGINT) "
        f"AS blocks FROM documents d CROSS JOIN {_SMALL_SIZES} GROUP BY s.sz), "
        "rec AS (SELECT CAST(sz AS INTEGER) AS seq, 'BLOCKSIZE=' || sz || '|BLOCOS=' || blocks || "
        "'|METADATA=' || (blocks * 150) AS record FROM fp) "
        f"SELECT seq, TRY_CAST({_kv_sql('record', 'BLOCKSIZE', '|')} AS INTEGER) AS BLOCKSIZE, "
        f"TRY_CAST({_kv_sql('record', 'BLOCOS', '|')} AS INTEGER) AS BLOCOS, "
        f"TRY_CAST(COALESCE({_kv_sql('record', 'MAP_TASKS', '|')}, "
        f"{_kv_sql('record', 'BLOCOS', '|')}) AS INTEGER) AS MAP_TASKS, "
        f"TRY_CAST({_kv_sql('record', 'METADATA', '|')} AS BIGINT) AS METADATA, "
        "row_number() OVER (ORDER BY seq) AS i FROM rec"),
    "log_summary": (
        "SELECT regexp_extract(url, '//([^/]*)', 1) AS host, count(*) AS n_lines, "
        + _counter_sql("pages", "page=", "N/A") + ", " + _counter_sql("feeds", "=feed", "0") + ", "
        "count(*) FILTER (WHERE contains(url, '#top')) AS tops, "
        "count(*) FILTER (WHERE contains(url, 'Resubmitting')) AS resubmits, "
        "CASE WHEN bool_or(contains(url, '.html')) THEN 'SUCCESS' ELSE 'FAILURE' END AS status "
        "FROM pages GROUP BY 1"),
    "rank_words": (
        "SELECT word, count, row_number() OVER (ORDER BY count DESC, word || chr(9) DESC) AS rank "
        f"FROM ({_word_count_sql('documents', 'text')}) c"),
    "replace_output": _word_count_sql("conversations", "text"),
    "stage_if_absent": (
        f"SELECT unnest({_lines_array_sql(_TEXT_FILE_VALUE)}) AS line FROM conversations"),
    "append_records": " UNION ALL ".join(
        f"SELECT '{t}' AS TABELA, count(*) AS LINHAS, CAST(coalesce(sum(strlen({c})), 0) AS BIGINT) AS BYTES FROM {t}"
        for t, c in TEXT_TABLES.items()),
    "report_node_memory": _layout_sql(
        "CAST(setting AS INTEGER) AS MEMORIA, CAST(n AS INTEGER) AS MAP_TASKS, CAST(NULL AS INTEGER) AS REDUCE_TASKS, "
        "seconds AS TEMPO_WC, greatest(CAST(floor((setting * 2 - 512) / 1024) AS BIGINT), 1) AS CONTAINERS_MAX"),
    "report_task_memory": _layout_sql(
        "CAST(setting AS INTEGER) AS MAP_MB, CAST(setting * 2 AS INTEGER) AS REDUCE_MB, "
        "CAST(n AS INTEGER) AS MAP_TASKS, 1 AS REDUCE_TASKS, reexec AS REEXEC, failed AS FAILED, seconds AS TEMPO_WC"),
    "report_replication": _layout_sql(
        "2 AS REPLICACAO, seconds AS UPLOAD, seconds AS LEITURA, bytes || ' B' AS ESPACO_USADO, "
        "(bytes * 2) || ' B' AS ESPACO_TOTAL, 2 AS DATANODES"),
    "report_vcores": _layout_sql(
        "CAST(setting AS INTEGER) AS VCORES, CAST(n AS INTEGER) AS MAP_TASKS, 1 AS REDUCE_TASKS, "
        "seconds AS TEMPO_WC, setting * 2 AS VCORES_TOTAL"),
    "record_log": (
        "SELECT *, i + 1 AS number FROM (" + " UNION ALL ".join(
            f"SELECT '{t}' AS TABELA, count(*) AS LINHAS, CAST(coalesce(sum(strlen({TEXT_TABLES[t]})), 0) AS BIGINT) "
            f"AS BYTES, CAST({i} AS BIGINT) AS i FROM {t}" for i, t in enumerate(ARRIVAL, 1)) + ") r"),
    "report_arrival": (
        "SELECT CAST(sz AS INTEGER) AS BLOCKSIZE, lang AS LANG, CAST(blocks AS INTEGER) AS BLOCOS, "
        "CAST(blocks AS INTEGER) AS MAP_TASKS, blocks * 150 AS METADATA, "
        "row_number() OVER (ORDER BY seq, lang NULLS FIRST) AS i FROM ("
        "SELECT s.seq, s.sz, d.lang, CAST(coalesce(sum(ceil(strlen(d.text) / (s.sz * 1024))), 0) AS BIGINT) AS blocks "
        "FROM documents d CROSS JOIN (VALUES "
        + ", ".join(f"({i}, {kb})" for i, kb in enumerate(ARRIVAL_KB)) + ") s(seq, sz) GROUP BY s.seq, s.sz, d.lang) g"),
    "run_summary": (
        f"SELECT {_HOST} AS host, count(*) AS n_lines, " + _first_sql("pages", "page=", "N/A") + ", "
        + _first_sql("feeds", "=feed", "0") + ", count(*) FILTER (WHERE contains(url, '#top')) AS tops, "
        "count(*) FILTER (WHERE contains(url, 'Resubmitting')) AS resubmits, "
        "CASE WHEN bool_or(contains(url, '.html')) THEN 'SUCCESS' ELSE 'FAILURE' END AS status "
        "FROM pages GROUP BY 1"),
    "run_numbers": " UNION ALL ".join(
        f"SELECT host, '{name}' AS counter, CAST(generate_subscripts(found, 1) AS BIGINT) AS pos, "
        "unnest(found) AS number, TRY_CAST(unnest(found) AS BIGINT) AS value FROM ("
        f"SELECT {_HOST} AS host, {_numbers_sql(marker)} AS found FROM pages GROUP BY 1) f"
        for name, marker in (("pages", "page="), ("feeds", "=feed"))),
    "split_report": (
        "WITH f AS (SELECT doc_id // " + str(FILE_DOCS) + " AS file, strlen(coalesce(text, '')) + 1 AS n, "
        "sum(strlen(coalesce(text, '')) + 1) OVER (PARTITION BY doc_id // " + str(FILE_DOCS)
        + " ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM documents) "
        "SELECT CAST(kb AS INTEGER) AS split_kb, count(DISTINCT (file, CASE WHEN upto = n THEN 0 "
        "ELSE CAST((upto - n - 1) // (kb * 1024) AS BIGINT) END)) AS splits, count(*) AS rows FROM f CROSS JOIN (VALUES "
        + ", ".join(f"({kb})" for kb in SPLIT_KB) + ") s(kb) GROUP BY kb"),
    "stage_after_crash": (
        f"SELECT unnest({_lines_array_sql(_TEXT_FILE_VALUE)}) AS line FROM conversations"),
    "merge_into": (
        "SELECT tok AS word, count(*) AS count FROM ("
        + " UNION ALL ".join(_tokens_sql(t, c) for t, c in TEXT_TABLES.items()) + ") u WHERE tok <> '' GROUP BY tok"),
    "kv_rows": _UNLISTED_ROWS,
    "discover_keys": (
        "SELECT key, count(*) AS n_records, count(value) AS n_values, "
        f"count(TRY_CAST(value AS DECIMAL(38, 10))) AS n_numbers FROM ({_UNLISTED_ROWS}) r GROUP BY key"),
    "top_ranked": (
        "SELECT word, count, row_number() OVER (ORDER BY count DESC, word || chr(9) DESC) AS rank "
        f"FROM ({_word_count_sql('documents', 'text')}) c "
        f"ORDER BY count DESC, word || chr(9) DESC LIMIT {LARGE_K}"),
    "corpus_generate": _CORPUS_EVENTS,
    "corpus_word_count": (
        "SELECT word, count(*) AS count FROM ("
        f"SELECT regexp_replace(lower(tok), '{STRIP}', '', 'g') AS word FROM ("
        f"SELECT unnest(regexp_split_to_array(value, '{WS}')) AS tok "
        f"FROM ({_CORPUS_EVENTS}) c) t) w "
        "WHERE word <> '' GROUP BY word"),
}
