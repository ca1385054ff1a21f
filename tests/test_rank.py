"""O1-O3."""

from __future__ import annotations

from wordmill.operators.rank import numbered, rank_words, sorted_counts, top_words
from wordmill.plans.inspect import physical_lines


def counts(spark, rows):
    return spark.createDataFrame(rows, "word string, count bigint")


def test_top_k_ties_like_sort_nr(spark):
    df = counts(spark, [("b", 5), ("a", 5), ("ab", 5), ("z", 10), ("q", 9)])
    got = [(r["word"], r["rank"]) for r in top_words(df, k=10).orderBy("rank").collect()]
    assert got == [("z", 1), ("q", 2), ("b", 3), ("ab", 4), ("a", 5)]


def test_top_k_compares_the_whole_line(spark):
    # "a\x01<TAB>5" sorts below "a<TAB>5" bytewise, so "a" ranks first under -r.
    df = counts(spark, [("a\x01", 5), ("a", 5)])
    got = [r["word"] for r in top_words(df, k=2).orderBy("rank").collect()]
    assert got == ["a", "a\x01"]


def test_top_k_limits_and_plans_take_ordered(spark):
    df = counts(spark, [(f"w{i}", i) for i in range(50)])
    top = top_words(df, k=10)
    assert top.count() == 10
    assert any("TakeOrderedAndProject" in ln for ln in physical_lines(top))


def test_sorted_counts_rank_is_global_byte_order(spark):
    words = ["b", "a", "é", "Z", "aa", "1", "~", "zz"] + [f"w{i:04d}" for i in range(500)]
    df = counts(spark, [(w, 1) for w in words]).repartition(7)
    got = [r["word"] for r in sorted_counts(df, num_partitions=5).orderBy("rank").collect()]
    assert got == sorted(words, key=lambda w: w.encode("utf-8"))
    ranks = [r["rank"] for r in sorted_counts(df, num_partitions=5).collect()]
    assert sorted(ranks) == list(range(1, len(words) + 1))


def test_sorted_counts_partitions_are_in_order(spark):
    df = counts(spark, [(f"w{i:05d}", i) for i in range(2000)])
    out = sorted_counts(df, rank_col=None, num_partitions=4)
    parts = out.rdd.glom().map(lambda rows: [r["word"] for r in rows]).collect()
    flat = [w for p in parts for w in p]
    assert flat == sorted(flat) and len(parts) == 4


def test_numbered_in_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "seq int, v string")
    got = [(r["seq"], r["i"]) for r in numbered(df, ["seq"]).orderBy("i").collect()]
    assert got == [(1, 1), (2, 2), (3, 3)]


def test_numbering_edge_cases(spark):
    empty = counts(spark, [])
    assert sorted_counts(empty).count() == 0
    one = sorted_counts(counts(spark, [("a", 1)])).collect()
    assert [(r["word"], r["rank"]) for r in one] == [("a", 1)]


def test_numbering_spreads_a_hot_key(spark):
    # one key holds a third of the rows: the range partitioner must still split it
    rows = [(0, i) for i in range(3000)] + [(k, i) for k in range(1, 6001) for i in (0,)]
    df = spark.createDataFrame(rows, "k int, v int")
    out = numbered(df, ["k"], num_partitions=6)
    sizes = out.rdd.glom().map(len).collect()
    assert max(sizes) < 3000 and sum(sizes) == 9000
    got = out.select("i").rdd.map(lambda r: r[0]).collect()
    assert sorted(got) == list(range(1, 9001))
    firsts = [r["i"] for r in out.where("k = 0").collect()]
    assert sorted(firsts) == list(range(1, 3001))


def test_numbering_frame_with_map_column(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2})], "seq int, m map<string,int>")
    got = [(r["seq"], r["i"]) for r in numbered(df, ["seq"]).orderBy("i").collect()]
    assert got == [(1, 1), (2, 2)]


def test_numbering_splits_identical_rows(spark):
    rows = [(0, 0)] * 3000 + [(k, 0) for k in range(1, 6001)]
    out = numbered(spark.createDataFrame(rows, "k int, v int"), ["k"], num_partitions=6)
    parts = out.rdd.glom().map(lambda part: [(r["k"], r["i"]) for r in part]).collect()
    assert max(sum(k == 0 for k, _ in part) for part in parts) < 3000
    flat = [x for part in parts for x in part]
    assert sorted(i for _, i in flat) == list(range(1, 9001))
    assert sorted(i for k, i in flat if k == 0) == list(range(1, 3001))
    assert [k for k, _ in flat] == sorted(k for k, _ in flat)  # the order is kept


def test_rank_words_ranks_the_whole_set(spark):
    df = counts(spark, [("b", 5), ("a", 5), ("ab", 5), ("z", 10), ("q", 9)])
    got = [(r["word"], r["rank"]) for r in rank_words(df, num_partitions=3).orderBy("rank").collect()]
    assert got == [("z", 1), ("q", 2), ("b", 3), ("ab", 4), ("a", 5)]


def test_top_k_matches_sort_nr_model(spark):
    import random
    rng = random.Random(9)
    alphabet = ["a", "b", "Z", "\x01", "\x08", "\x0b", "é", "~", "0"]
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4)))
                    for _ in range(600)})
    rows = [(w, rng.randint(1, 6)) for w in words]  # many ties
    df = counts(spark, rows)
    # sort -t$'\t' -k2 -nr in the C locale: count descending, then the whole
    # line "word<TAB>count" compared bytewise, reversed.
    model = sorted(rows, key=lambda r: (r[1], (r[0] + "\t" + str(r[1])).encode()), reverse=True)
    got = [(r["word"], r["count"]) for r in top_words(df, k=25).orderBy("rank").collect()]
    assert got == model[:25]
