"""A1-A7, O1, O2 on the fixture pairs and tokens, and A7 against brute force."""

import random

from conftest import rows
from pyspark.sql import functions as F

from quern.operators import agg

# The token fixture (F1) and the number-pair fixture (F2), in file order.
TOKEN_LINES = ["apache spark", "spark streaming", "structured streaming", "dataframe",
               "spark sql", "mapreduce", "map reduce"]
PAIRS = [(3, 1), (3, 3), (3, 2), (2, 2), (2, 1), (1, 1)]
G1 = [("apache", 1), ("dataframe", 1), ("map", 1), ("mapreduce", 1), ("reduce", 1), ("spark", 3),
      ("sql", 1), ("streaming", 2), ("structured", 1)]


def _pairs(spark):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(PAIRS)],
                                 "ord long, first_num long, second_num long")


def test_token_counts_g1(spark):
    df = spark.createDataFrame([(v,) for v in TOKEN_LINES], "value string")
    assert rows(agg.token_count(df, "value")) == G1
    assert rows(agg.token_count(df, "value", splitter="space")) == G1


def test_space_tokens_count_empty(spark):
    df = spark.createDataFrame([("a  b",), ("  a",)], "value string")
    assert rows(agg.token_count(df, "value", splitter="space")) == [("", 3), ("a", 2), ("b", 1)]


def test_merge_counts(spark):
    df = spark.createDataFrame([("x", "a b"), ("y", "b b")], "src string, value string")
    per = agg.token_count(df, "value", by=["src"])
    assert rows(agg.merge_counts(per, "word")) == [("a", 1), ("b", 3)]


def test_sorted_rows_o1(spark):
    out = agg.sorted_rows(_pairs(spark).drop("ord"), ["first_num"]).collect()
    assert [r.first_num for r in out] == [1, 2, 2, 3, 3, 3]
    assert sorted(tuple(r) for r in out) == sorted(PAIRS)


def test_distinct_pairs_a5(spark):
    out = [tuple(r) for r in agg.distinct_pairs(_pairs(spark), ["first_num", "second_num"]).collect()]
    assert out == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3)]


def test_min_per_key_a4(spark):
    assert rows(agg.min_per_key(_pairs(spark), "first_num", "second_num")) == [(1, 1), (2, 1), (3, 1)]


def test_first_per_key_a6(spark):
    out = agg.first_per_key(_pairs(spark), "first_num", ["second_num"], ["second_num", "ord"])
    assert rows(out) == [(1, 1, 5), (2, 1, 4), (3, 1, 0)]


def test_first_of_run_a7_file_order(spark):
    out = agg.first_of_run(_pairs(spark), ["first_num"], ["ord"])
    assert rows(out.select("first_num", "second_num")) == [(1, 1), (2, 2), (3, 1)]


def _brute_first_of_run(data, by_user):
    data = sorted(data, key=lambda r: (r[0], r[1]) if by_user else r[1])
    out, prev = [], object()
    for user, ts, typ in data:
        key = (user, typ) if by_user else typ
        if key != prev:
            out.append((user, ts, typ))
        prev = key
    return sorted(out)


def test_first_of_run_many_partitions_vs_brute_force(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 4) if rnd.random() > 0.5 else 0, t, rnd.choice("ab"))
            for t in rnd.sample(range(5000), 600)]
    df = spark.createDataFrame(data, "user long, ts long, typ string")
    got = agg.first_of_run(df, ["typ"], ["ts"], num_partitions=7)
    assert rows(got) == _brute_first_of_run(data, by_user=False)
    got = agg.first_of_run(df, ["typ"], ["ts"], partition_cols=["user"], num_partitions=5)
    assert rows(got) == _brute_first_of_run(data, by_user=True)
    flagged = agg.first_of_run(df, ["typ"], ["ts"], num_partitions=3, flag_col="first")
    assert flagged.count() == len(data)
    assert flagged.filter(F.col("first")).count() == len(_brute_first_of_run(data, by_user=False))


def test_token_count_observed_a8(spark):
    df = spark.createDataFrame([(v,) for v in TOKEN_LINES], "value string")
    counts, lines_obs, groups_obs = agg.token_count_observed(df, "value")
    assert rows(counts) == G1
    assert lines_obs.get == {"lines_in": 7}
    assert groups_obs.get == {"groups_out": 9, "tokens": 12}


def test_sorted_rows_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    # Key 7 holds a third of the rows, spread over the input partitions; a third
    # of all rows are identical copies (7, 0).
    data = [(7, 0) if i % 3 == 0 else (i % 50, i) for i in range(6000)]
    df = spark.createDataFrame(data, "k long, v long").repartition(6)
    out = agg.sorted_rows(df, ["k"], num_partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 2000 and sum(sizes) == 6000
    keys = [r.k for r in out.collect()]
    assert keys == sorted(keys)


def test_first_of_run_spreads_a_hot_user(spark):
    from pyspark.sql import functions as F

    data = [(0 if i % 3 == 0 else i % 40, i, "ab"[(i // 7) % 2]) for i in range(6000)]
    df = spark.createDataFrame(data, "user long, ts long, typ string")
    out = agg.first_of_run(df, ["typ"], ["ts"], partition_cols=["user"], num_partitions=8, flag_col="first")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2000
    assert out.filter(F.col("first")).count() == len(_brute_first_of_run(data, by_user=True))
