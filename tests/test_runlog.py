"""P5-P11, A5, A6, R5-R8 on fixture records and job-log lines."""

from __future__ import annotations

import datetime as dt

import pytest

from wordmill.functions import runlog as R
from wordmill.operators import runlog as ops

LOG = [
    ("r1", 1, "INFO Job started"),
    ("r1", 2, "\t\tLaunched map tasks=15"),
    ("r1", 3, "\t\tLaunched reduce tasks=1"),
    ("r1", 4, "Resubmitting task attempt_1"),
    ("r1", 5, "task failed once"),
    ("r1", 6, "Task Failed badly"),
    ("r1", 7, "Job job_1 completed successfully"),
    ("r2", 1, "Launched map tasks=8 of=9"),
    ("r2", 2, "Name: 10.0.0.1"),
    ("r2", 3, " Name: not anchored"),
]


def logs(spark):
    return spark.createDataFrame(LOG, "run string, line_no int, line string")


def test_extract_counters_all_matches(spark):
    got = ops.extract_counters(logs(spark), "Launched map tasks", keep=["run"])
    rows = sorted((r["run"], r["pos"], r["value"]) for r in got.collect())
    assert rows == [("r1", 1, 15), ("r2", 1, 8), ("r2", 2, 9)]


def test_parse_kv_fixture_record(spark):
    rec = "BLOCKSIZE=32|BLOCOS=15|MAP_TASKS=15|TEMPO_WC=12.5|UPLOAD=3.2|METADATA=2250"
    df = spark.createDataFrame([(rec,)], "record string")
    fields = [ops.Field("BLOCKSIZE", "int"), ops.Field("BLOCOS", "int"),
              ops.Field("MAP_TASKS", "int"), ops.Field("TEMPO_WC", "decimal(20,9)"),
              ops.Field("UPLOAD", "double"), ops.Field("METADATA", "int"),
              ops.Field("REEXEC", "int")]
    r = ops.parse_kv(df, fields).first()
    assert (r["BLOCKSIZE"], r["BLOCOS"], r["MAP_TASKS"], r["METADATA"]) == (32, 15, 15, 2250)
    assert float(r["TEMPO_WC"]) == 12.5 and r["UPLOAD"] == 3.2
    assert r["REEXEC"] is None  # missing key


def test_parse_kv_stops_at_separator_and_prefix_keys(spark):
    rec = "REPLICACAO=2|ESPACO_TOTAL=1.2 G|DATANODES=2|VCORES_TOTAL=16|VCORES=8"
    df = spark.createDataFrame([(rec,)], "record string")
    r = ops.parse_kv(df, [ops.Field("ESPACO_TOTAL"), ops.Field("VCORES", "int"),
                          ops.Field("VCORES_TOTAL", "int"), ops.Field("DATANODES", "int")]).first()
    assert r["ESPACO_TOTAL"] == "1.2 G"
    assert (r["VCORES"], r["VCORES_TOTAL"], r["DATANODES"]) == (8, 16, 2)


def test_or_default(spark):
    df = spark.createDataFrame([("BLOCOS=7",), ("BLOCOS=7|MAP_TASKS=",), ("MAP_TASKS=3",)],
                               "record string")
    fields = [ops.Field("MAP_TASKS", "int", default=R.kv_value("record", "BLOCOS")),
              ops.Field("REDUCE_TASKS", "int", default=1),
              ops.Field("MAP2", "string", default="N/A")]
    got = [(r["MAP_TASKS"], r["REDUCE_TASKS"], r["MAP2"]) for r in ops.parse_kv(df, fields).collect()]
    assert got == [(7, 1, "N/A"), (7, 1, "N/A"), (3, 1, "N/A")]


def test_elapsed(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    t1 = dt.datetime(2024, 1, 1, 0, 2, 5, 100000)
    df = spark.createDataFrame([(t0, t1)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(R.elapsed_seconds("a", "b").alias("f"), R.elapsed_whole_seconds("a", "b").alias("d"),
                  R.elapsed_text("a", "b").alias("t")).first()
    assert abs(r["f"] - 124.2) < 1e-9
    assert r["d"] == 125  # date +%s floors each end: 125 - 0
    assert r["t"] == "2m 5s"


def test_capacity_formulas(spark):
    df = spark.createDataFrame([(2048, 2), (4096, 4), (8192, 8), (512, 1), (0, 0)], "m int, v int")
    got = [(r[0], r[1]) for r in df.select(R.max_containers("m"), R.vcores_total("v")).collect()]
    assert got == [(3, 4), (7, 8), (15, 16), (1, 2), (1, 0)]


def test_count_matching_case_and_anchor(spark):
    markers = {"failed": "failed", "resubmits": "Resubmitting",
               "names": ops.starts_with("Name:"), "blocks": ops.matches("tasks=\\d+$")}
    got = {r["run"]: r.asDict() for r in
           ops.count_matching(logs(spark), markers, by=["run"]).collect()}
    assert got["r1"]["failed"] == 1  # "Failed" does not count
    assert got["r1"]["resubmits"] == 1
    assert got["r2"]["names"] == 1   # the indented one is not anchored
    assert got["r1"]["n_lines"] == 7 and got["r1"]["blocks"] == 2


def test_status(spark):
    got = {r["run"]: r["status"] for r in
           ops.status(logs(spark), "completed successfully", by=["run"]).collect()}
    assert got == {"r1": "SUCCESS", "r2": "FAILURE"}


def test_log_summary(spark):
    s = ops.log_summary(
        logs(spark), by=["run"],
        counters=[ops.Counter("map_tasks", "Launched map tasks", default=0),
                  ops.Counter("reduce_tasks", "Launched reduce tasks", default=1)],
        line_counts={"reexec": "Resubmitting", "failed": "failed"})
    got = {r["run"]: r.asDict() for r in s.collect()}
    assert got["r1"] == {"run": "r1", "n_lines": 7, "map_tasks": "15", "map_tasks_value": 15,
                         "reduce_tasks": "1", "reduce_tasks_value": 1,
                         "reexec": 1, "failed": 1, "status": "SUCCESS"}
    assert got["r2"]["map_tasks"] == "8\n9" and got["r2"]["map_tasks_value"] == 8
    assert got["r2"]["reduce_tasks_value"] == 1 and got["r2"]["status"] == "FAILURE"


def test_log_summary_keeps_every_number_and_text_defaults(spark):
    rows = [("r", 2, "Launched map tasks=4 of=9"), ("r", 1, "Launched map tasks=3"), ("r", 2, "Launched map tasks=4 of=7"),
            ("s", 1, "nothing here")]
    df = spark.createDataFrame(rows, "run string, line_no int, line string")
    got = {r["run"]: r for r in ops.log_summary(
        df, by=["run"], counters=[ops.Counter("m", "Launched map tasks", default="N/A")],
        success_marker=None).collect()}
    assert (got["r"]["m"], got["r"]["m_value"]) == ("3\n4\n7\n4\n9", 3)
    assert (got["s"]["m"], got["s"]["m_value"]) == ("N/A", None)


def test_block_and_replica_footprint(spark):
    mb = 1024 * 1024
    df = spark.createDataFrame([("a" * (40 * mb),), ("",), ("b" * 10,)], "text string")
    got = {r["block_size_mb"]: (r["files"], r["blocks"], r["metadata_bytes"])
           for r in ops.block_footprint(df).collect()}
    assert got == {32: (3, 3, 450), 64: (3, 2, 300), 128: (3, 2, 300)}
    rep = {r["replication"]: (r["logical_bytes"], r["total_bytes"])
           for r in ops.replica_footprint(df).collect()}
    n = 40 * mb + 10
    assert rep == {1: (n, n), 2: (n, 2 * n), 3: (n, 3 * n)}


def test_run_report_numbers_records_in_arrival_order(spark):
    recs = [(3, "BLOCKSIZE=128|BLOCOS=4|MAP_TASKS=4|TEMPO_WC=9.1"),
            (1, "BLOCKSIZE=32|BLOCOS=15|MAP_TASKS=15|TEMPO_WC=12.5"),
            (2, "BLOCKSIZE=64|BLOCOS=8|TEMPO_WC=10.0")]
    df = spark.createDataFrame(recs, "seq int, record string")
    fields = [ops.Field("BLOCKSIZE", "int"),
              ops.Field("MAP_TASKS", "int", default=R.kv_value("record", "BLOCOS")),
              ops.Field("TEMPO_WC", "double")]
    got = [(r["i"], r["BLOCKSIZE"], r["MAP_TASKS"], r["TEMPO_WC"])
           for r in ops.run_report(df, fields, order=["seq"]).orderBy("i").collect()]
    assert got == [(1, 32, 15, 12.5), (2, 64, 8, 10.0), (3, 128, 4, 9.1)]


def test_to_record_round_trip(spark):
    df = spark.createDataFrame([(32, 15)], "bs int, blocks int")
    rec = df.select(ops.to_record([("BLOCKSIZE", "bs"), ("BLOCOS", "blocks")]).alias("record"))
    assert rec.first()["record"] == "BLOCKSIZE=32|BLOCOS=15"
    r = ops.parse_kv(rec, [ops.Field("BLOCOS", "int")]).first()
    assert r["BLOCOS"] == 15


def test_no_cross_join_in_sweeps(spark):
    from wordmill.plans.inspect import physical_lines
    df = spark.createDataFrame([("x",)], "text string")
    plan = physical_lines(ops.block_footprint(df))
    assert not any("CartesianProduct" in ln or "NestedLoop" in ln for ln in plan)


def test_grouped_operators_combine_map_side(spark):
    from wordmill.plans.inspect import below_first
    df = logs(spark)
    plans = {
        "count_matching": ops.count_matching(df, {"f": "failed"}, by=["run"]),
        "status": ops.status(df, "completed successfully", by=["run"]),
        "log_summary": ops.log_summary(df, by=["run"],
                                       counters=[ops.Counter("m", "Launched map tasks")]),
        "block_footprint": ops.block_footprint(df.withColumnRenamed("line", "text"), by=["run"]),
    }
    for name, plan in plans.items():
        below = below_first(plan, "Exchange")
        assert any("partial_" in ln for ln in below), name


def test_log_summary_marker_line_without_number(spark):
    df = spark.createDataFrame([("r", 1, "Launched map tasks"), ("r", 2, "Launched map tasks=4")],
                               "run string, line_no int, line string")
    got = ops.log_summary(df, by=["run"], counters=[ops.Counter("m", "Launched map tasks")],
                          success_marker=None).first()
    assert (got["m"], got["m_value"]) == ("4", 4)
    only_bare = df.where("line_no = 1")
    assert ops.log_summary(only_bare, by=["run"], counters=[ops.Counter("m", "Launched map tasks")],
                           success_marker=None).first()["m_value"] == 0


def test_elapsed_with_zoned_timestamps(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")  # a +05:30 zone
    try:
        df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00.900 UTC' AS a, "
                       "TIMESTAMP'2024-01-01 00:02:05.100 UTC' AS b")
        r = df.select(R.elapsed_seconds("a", "b").alias("f"),
                      R.elapsed_whole_seconds("a", "b").alias("d"),
                      R.elapsed_text("a", "b").alias("t")).first()
        assert abs(r["f"] - 124.2) < 1e-9 and r["d"] == 125 and r["t"] == "2m 5s"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_elapsed_over_daylight_saving_changes(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The clocks of New York change at 07:00 UTC on 2024-03-10 and 06:00 UTC on 2024-11-03.
        spans = spark.sql(
            "SELECT * FROM VALUES (TIMESTAMP'2024-03-10 06:59:00 UTC', TIMESTAMP'2024-03-10 07:01:00 UTC'),"
            "(TIMESTAMP'2024-11-03 05:59:00 UTC', TIMESTAMP'2024-11-03 06:01:00 UTC') AS t(a, b)")
        for r in spans.select(R.elapsed_seconds("a", "b"), R.elapsed_whole_seconds("a", "b"),
                              R.elapsed_text("a", "b")).collect():
            assert tuple(r) == (120.0, 120, "2m 0s")
        walls = spark.sql(
            "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00', TIMESTAMP_NTZ'2024-03-10 03:30:00'),"
            "(TIMESTAMP_NTZ'2024-11-03 00:30:00', TIMESTAMP_NTZ'2024-11-03 01:30:00'),"
            "(TIMESTAMP_NTZ'1969-12-31 23:59:59.5', TIMESTAMP_NTZ'1970-01-01 00:59:59.5') AS t(a, b)")
        for r in walls.select(R.elapsed_seconds("a", "b"), R.elapsed_whole_seconds("a", "b"),
                              R.elapsed_text("a", "b")).collect():
            assert tuple(r) == (3600.0, 3600, "60m 0s")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("sep", ["; ", "||", "|", ";"])
def test_kv_value_with_longer_separators(spark, sep):
    record = sep.join(["A=hello world", "AB=1;2|3" if len(sep) > 1 else "AB=123", "B=2"])
    df = spark.createDataFrame([(record,)], "record string")
    got = df.select(*[R.kv_value("record", k, pair_sep=sep) for k in ("A", "AB", "B", "C")]).first()
    assert tuple(got) == ("hello world", "1;2|3" if len(sep) > 1 else "123", "2", None)


def test_whole_numbers_are_exact(spark):
    df = spark.createDataFrame([(2 ** 61 + 1,)], "m long")
    assert df.select(R.max_containers("m")).first()[0] == (2 * (2 ** 61 + 1) - 512) // 1024


def test_footprints_of_an_empty_input(spark):
    empty = spark.createDataFrame([], "text string")
    got = [(r["block_size_mb"], r["files"], r["bytes"], r["blocks"], r["metadata_bytes"])
           for r in ops.block_footprint(empty).orderBy("block_size_mb").collect()]
    assert got == [(32, 0, 0, 0, 0), (64, 0, 0, 0, 0), (128, 0, 0, 0, 0)]
    rep = [(r["replication"], r["logical_bytes"], r["total_bytes"])
           for r in ops.replica_footprint(empty).orderBy("replication").collect()]
    assert rep == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]


def test_kv_value_matches_a_plain_parser(spark):
    import random
    rng = random.Random(3)
    keys = ["V", "VC", "VCORES", "VCORES_TOTAL", "MAP_TASKS", "TASKS", "X.Y", "A+B"]

    def parse(record, key):
        for pair in record.split("|"):
            k, sep, v = pair.partition("=")
            if sep and k == key:
                return v or None
        return None

    records = []
    for _ in range(400):
        pairs = [(rng.choice(keys), rng.choice(["", "1", "22", "1.5 G", "a=b", "x"]))
                 for _ in range(rng.randint(0, 5))]
        records.append("|".join(f"{k}={v}" for k, v in pairs))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, record string")
    cols = [R.kv_value("record", k).alias(f"k{j}") for j, k in enumerate(keys)]
    got = {r["i"]: r for r in df.select("i", *cols).collect()}
    for i, rec in enumerate(records):
        for j, k in enumerate(keys):
            assert got[i][f"k{j}"] == parse(rec, k), (rec, k)


def test_extract_counters_matches_findall(spark):
    import random
    import re
    rng = random.Random(4)
    parts = ["=", "12", "a", " ", "x=", "=7", "MARK", "==", "9"]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(500)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, line string")
    got = sorted((r["id"], r["pos"], r["value"]) for r in
                 ops.extract_counters(df, "MARK", keep=["id"]).collect())
    want = sorted((i, p + 1, int(v)) for i, s in enumerate(lines) if "MARK" in s
                  for p, v in enumerate(re.findall(r"=(\d+)", s)))
    assert got == want


def test_elapsed_matches_shell_arithmetic(spark):
    import random
    rng = random.Random(8)
    epoch = dt.datetime(1970, 1, 1)
    pairs = []
    for _ in range(400):
        a = epoch + dt.timedelta(microseconds=rng.randint(-10**15, 2 * 10**15))
        b = a + dt.timedelta(microseconds=rng.randint(-10**10, 10**11))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    rows = df.select("a", "b", R.elapsed_seconds("a", "b").alias("f"),
                     R.elapsed_whole_seconds("a", "b").alias("d"),
                     R.elapsed_text("a", "b").alias("t")).collect()

    def floor_s(x):  # date +%s: whole seconds, floored
        return ((x - epoch) // dt.timedelta(microseconds=1)) // 10**6

    for r in rows:
        us = (r["b"] - r["a"]) // dt.timedelta(microseconds=1)
        assert r["f"] == us / 1e6
        d = floor_s(r["b"]) - floor_s(r["a"])
        assert r["d"] == d
        q = int(d / 60)  # shell: truncate toward zero
        assert r["t"] == f"{q}m {d - 60 * q}s"


def test_extract_counter_after_a_phrase(spark):
    # P5 also reads the number after "replication factor" and blanks.
    df = spark.createDataFrame([(1, "Average block replication factor   2"),
                                (2, "replication factor: none"),
                                (3, "default replication factor 3, max 5")],
                               "run int, line string")
    got = ops.extract_counters(df, "replication factor", keep=["run"],
                               pattern=r"replication factor\s+(\d+)")
    assert sorted((r["run"], r["value"]) for r in got.collect()) == [(1, 2), (3, 3)]
