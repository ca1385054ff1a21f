"""Numbering by literal ranges: model tests, laziness, reuse, skew."""

from __future__ import annotations

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from wordmill.operators.rank import numbered, rank_words, sorted_counts
from wordmill.operators.text import word_count
from wordmill.plans import ordering
from wordmill.plans.inspect import explain_string
from wordmill.plans.ordering import Descending, global_index, grouped_index
from tests.conftest import SF_SMALL


class Jobs:
    """Counts the jobs that a block starts."""

    def __init__(self, spark):
        self.sc, self.group = spark.sparkContext, f"jobs-{random.random()}"

    def __enter__(self):
        self.sc.setJobGroup(self.group, "")
        return self

    def __exit__(self, *_):
        self.n = len(self.sc.statusTracker().getJobIdsForGroup(self.group))
        self.sc.setJobGroup("rest", "")


def values(rng):
    return (rng.choice([None, "", "a", "é", "z\x01", "日本"]), rng.choice([None, -3, 0, 7, 2**40]),
            rng.choice([None, float("nan"), -1.5, 0.0, float("inf")]), rng.choice([None, True, False]),
            rng.choice([None, decimal.Decimal("1.50"), decimal.Decimal("-2.25")]),
            rng.choice([None, datetime.date(2020, 1, 1), datetime.date(1969, 5, 5)]), rng.choice([None, bytearray(b""), bytearray(b"\xff\x00")]))


SCHEMA = "s string, n bigint, d double, b boolean, m decimal(10,2), t date, x binary"


ORDERS = [lambda: ["s", "n"], lambda: [Descending("n"), "s"], lambda: ["d", Descending("t")],
          lambda: [Descending("m"), "b", Descending("x")],
          lambda: [Descending(F.concat("s", F.lit("!"))), F.col("n") + 1]]


@pytest.mark.parametrize("order", ORDERS)
def test_equals_a_single_sort(spark, order):
    order = order()
    rng = random.Random(4)
    df = spark.createDataFrame([values(rng) for _ in range(700)], SCHEMA).repartition(5)
    out = global_index(df, order, "i", num_partitions=9)
    got = out.orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(1, 701))
    names = [f"k{i}" for i in range(len(order))]
    want = (df.select(*[ordering._col(k).alias(n) for k, n in zip(order, names)])
            .orderBy(*[ordering._sort(F.col(n), k) for k, n in zip(order, names)]).collect())
    have = out.orderBy("i").select(*[ordering._col(k).alias(n) for k, n in zip(order, names)]).collect()
    assert list(map(str, have)) == list(map(str, want))
    # Within a partition and from one to the next the rows are in order.
    flat = [i for part in out.select("i").rdd.map(lambda r: r[0]).glom().collect() for i in part]
    assert flat == list(range(1, 701))


def test_building_runs_the_sampling_job_only(spark, scratch):
    path = f"{scratch}/counts"
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    word_count(docs).write.parquet(path)
    counts = spark.read.parquet(path)
    with Jobs(spark) as jobs:
        frame = sorted_counts(counts)
    # One query: its shuffle stages run as jobs of their own under adaptive execution.
    assert jobs.n <= 3
    with Jobs(spark) as none:
        frame.select("rank")
    assert none.n == 0
    want = sorted((r["word"] for r in counts.collect()), key=str.encode)
    assert [r["word"] for r in frame.orderBy("rank").collect()] == want


def test_sizes_and_rows_share_one_exchange(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    frame = sorted_counts(word_count(docs))
    frame.collect()
    plan = explain_string(frame)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1 or "ReusedExchange" in final


def test_rows_are_numbered_alike_without_the_shared_exchange(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    frame = rank_words(word_count(docs))
    want = {(r["word"], r["rank"]) for r in frame.collect()}
    assert {r["rank"] for r in frame.select("rank").collect()} == set(range(1, len(want) + 1))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert {(r["word"], r["rank"]) for r in rank_words(word_count(docs)).collect()} == want
        assert {(r["word"], r["rank"]) for r in frame.select("word", "rank").collect()} == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_other_keys_take_the_checkpoint(spark):
    df = spark.createDataFrame([(datetime.datetime(2020, 1, i % 28 + 1), [i % 3]) for i in range(60)], "at timestamp, a array<int>")
    for order in (["at"], ["a", "at"], [F.col("a").desc()]):
        assert sorted(r["i"] for r in numbered(df, order).collect()) == list(range(1, 61))
    got = numbered(df, [Descending("at")]).orderBy("i").collect()
    assert [r["at"] for r in got] == sorted((r["at"] for r in got), reverse=True)


def model(rows, key, weight):
    out, at = [], {}
    for r in sorted(rows, key=key):
        out.append((r, at.get(r[0], 0) + 1))
        at[r[0]] = at.get(r[0], 0) + weight(r)
    return sorted(out, key=str)


def test_positions_in_groups(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.randint(0, 4)) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, o int, w bigint").repartition(4)
    got = grouped_index(df, ["g"], ["o"], num_ranges=7)
    assert model(rows, lambda r: r[1], lambda r: 1) == sorted(
        (((r["g"], r["o"], r["w"]), r["pos"]) for r in got.collect()), key=str)
    got = grouped_index(df, ["g"], [Descending("o")], weight="w", num_ranges=7)
    assert model(rows, lambda r: -r[1], lambda r: r[2]) == sorted(
        (((r["g"], r["o"], r["w"]), r["pos"]) for r in got.collect()), key=str)
    with pytest.raises(TypeError):
        grouped_index(df.withColumn("a", F.array("o")), ["g"], ["a"])
    assert grouped_index(df.limit(0), ["g"], ["o"]).collect() == []


def test_a_hot_group_is_in_many_ranges(spark):
    df = spark.range(9000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    keys = [F.xxhash64("g"), "o"]
    keyed = df.select("g", "o", F.xxhash64("g").alias("k0"), F.col("o").alias("k1"))
    bounds = ordering.range_bounds(keyed, keys, ["k0", "k1"], 6)
    sizes = [r["count"] for r in keyed.groupBy(ordering.range_of(keyed, keys, ["k0", "k1"], bounds)).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 3000
