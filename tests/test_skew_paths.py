"""Salted, split and many-partition paths forced on the driver tables, checked against DuckDB."""

import os
import random

import pytest
from conftest import rows
from oracle_compare import duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quern.operators import agg, bloom, joins, ranges
from quern.plans import QUERIES
from quern.plans.queries import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")


def _sql_rows(sql):
    con = duck(SF)
    return sorted(tuple(r) for r in con.execute(sql).fetchall())


def test_secondary_sort_join_salted_matches_oracle(spark):
    cust = table(spark, SF, "customer", "c_custkey", "c_name", "c_mktsegment") \
        .filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    orders = table(spark, SF, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    out = joins.secondary_sort_join(cust, orders, "c_custkey", "o_custkey", ["c_name"],
                                    ["o_orderkey", "o_totalprice"], dim_order="c_custkey", max_group_rows=3,
                                    strategy="window")
    got = rows(out.select(F.col("o_custkey").alias("c_custkey"), "c_name", "o_orderkey", "o_totalprice"))
    assert got == _sql_rows(entry.oracle_sql()["secondary_sort_join"])


def test_cogroup_keeps_every_pair_and_spreads_a_hot_key(spark):
    left = spark.createDataFrame([(0 if i < 900 else None if i < 1000 else i, i) for i in range(1100)], "lk long, lv long")
    right = spark.createDataFrame([(0, i) for i in range(50)] + [(None, 99), (7777, 1)], "rk long, rv long")
    out = joins.cogroup(left, right, "lk", "rk", ["lv"], ["rv"], num_partitions=6)
    got = out.collect()
    assert sorted(r.left_row.lv for r in got if r.side == 0) == list(range(1100))
    assert {(r.n_left, r.n_right) for r in got if r.key == 0} == {(900, 50)}
    assert {(r.n_left, r.n_right) for r in got if r.key is None} == {(100, 1)}
    assert [r.right_row.rv for r in got if r.key is None and r.side == 1] == [99]
    order = [(r.key is not None, r.key or 0, r.side) for r in got]
    assert order == sorted(order)                  # a key's rows are contiguous, left before right
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 600     # no task holds the hot key


@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_cogroup_lists_equal_brute_force(spark, monkeypatch, buckets):
    monkeypatch.setattr(ranges, "BUCKET_ROWS", 150)                     # several buckets, found by rows, without a number
    rnd = random.Random(6)
    left = [(rnd.choice([0, 0, 0, None, 1, 2, 3, rnd.randrange(9, 60)]), i, f"l{i}") for i in range(1500)]
    right = [(rnd.choice([0, 0, None, 2, 5, rnd.randrange(9, 60)]), i % 1000, i) for i in range(700)]
    ldf = spark.createDataFrame(left, "lk long, lid long, name string").repartition(5)
    rdf = spark.createDataFrame(right, "rk long, rid long, v long").repartition(3)
    out = joins.cogroup_lists(ldf, rdf, "lk", "rk", ["lid", "name"], ["rid"], ["lid"], ["rid", "v"], chunk_rows=40, buckets=buckets)
    got = {(r.key, r.chunk): r for r in out.collect()}
    assert len(got) == out.count()
    for key in {k for k, *_ in left} | {k for k, *_ in right}:
        ls = sorted((i, n) for k, i, n in left if k == key)
        rs = sorted((i, v) for k, i, v in right if k == key)
        chunks = -(-max(len(ls), len(rs)) // 40)
        assert (key, chunks) not in got
        for c in range(chunks):
            r = got.pop((key, c))
            assert (r.n_left, r.n_right) == (len(ls), len(rs))
            assert [tuple(x) for x in r.left_rows] == ls[40 * c:40 * c + 40]
            assert [x.rid for x in r.right_rows] == [i for i, _ in rs[40 * c:40 * c + 40]]
        if key == 0:
            assert len(ls) > 80 and len(rs) > 80                        # a hot key: several chunks on each side
    assert not got


def test_cogroup_lists_spread_a_hot_key_over_tasks(spark):
    # Every row one key: its rows are numbered in several tasks, and no list passes its bound.
    left = spark.range(6000).selectExpr("1L AS lk", "id AS lid").repartition(4)
    right = spark.range(3000).selectExpr("1L AS rk", "id AS rid").repartition(4)
    out = joins.cogroup_lists(left, right, "lk", "rk", ["lid"], ["rid"], ["lid"], ["rid"], chunk_rows=100, buckets=8)
    rows_ = out.orderBy("chunk").collect()
    assert [r.chunk for r in rows_] == list(range(60)) and {(r.n_left, r.n_right) for r in rows_} == {(6000, 3000)}
    assert [x.lid for r in rows_ for x in r.left_rows] == list(range(6000))
    assert [x.rid for r in rows_ for x in r.right_rows] == list(range(3000))
    flow = spark.range(6000).select(F.lit(1).alias("k"), "id")
    placed = ranges.bucketed(flow, ranges.sketch(flow, ["k", "id"], 8), ["k", "id"], most=8)
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_first_of_run_shuffles_once_and_runs_no_job_early(spark, tiny_partitions):
    ev = table(spark, SF, "events", "user_id", "ts", "event_id", "event_type")
    for n in (None, 6):
        spark.sparkContext.setJobGroup("plan a7", "building")
        out = agg.first_of_run(ev, ["event_type"], ["ts", "event_id"], partition_cols=["user_id"], num_partitions=n)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan a7")) == []
        spark.sparkContext.setJobGroup("run", "running")
        tree = _tree(spark, out)
        assert _exchanges_of_first_input(tree) == 1, tree
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["sorted_pairs", "sorted_pairs_by_two", "lookup_join_sorted", "cogroup"])
def test_total_order_runs_its_input_once(spark, name):
    plan = _final_plan(spark, QUERIES[name](spark, SF))
    # No range exchange: that one would run everything below it a second time, for its sample.
    assert "rangepartitioning" not in plan.lower() and "shufflepartitionidpassthrough" in plan.lower()
    # Nor does the subquery that finds the bounds run the joins: their input's keys are enough.
    df = QUERIES[name](spark, SF)
    _tree(spark, df)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    subqueries = df._jdf.queryExecution().explainString(mode).split("===== Subqueries =====")[1]
    assert "Scan parquet" in subqueries and "Join" not in subqueries


def test_sorted_outputs_hold_their_order_across_partitions(spark):
    rnd = random.Random(1)
    pairs = spark.createDataFrame([(rnd.randrange(5), rnd.randrange(50)) for _ in range(3000)], "a long, b long").repartition(7)
    by_two = agg.sorted_rows(pairs, ["a", "b"], 9)
    assert by_two.rdd.getNumPartitions() == 9
    got = [(r.a, r.b) for r in by_two.collect()]
    assert got == sorted(got)
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k long, name string")
    out = joins.lookup_join(pairs, dim, "a", "k", ["name"], order="name", sort_output=True, num_partitions=9)
    keys = [r.k for r in out.collect()]
    assert keys == sorted(keys) and len(keys) == 3000


def _final_plan(spark, df):
    df.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode).split("Initial Plan")[0]


@pytest.fixture
def tiny_partitions(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split_in_every_shuffled_join(spark, tiny_partitions):
    # Two input partitions, so that a hot key comes in pieces that can be dealt to several tasks.
    big = spark.createDataFrame([(0 if i % 2 else i % 50, i) for i in range(20000)], "bk long, v long").repartition(8)
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(50)], "k long, name string")
    keys = spark.createDataFrame([(i,) for i in range(0, 50)], "key long")
    for name, df in {
        "lookup": joins.lookup_join(big, dim, "bk", "k", ["name"], order="name"),
        "prefiltered": joins.prefiltered_join(big, dim, "bk", "k", keys),
        "bloom exact": joins.bloom_join(big, dim, "bk", "k", keys, m=4096, k=3),
        "bloom inexact": joins.bloom_join(big, dim, "bk", "k", keys, exact=False, m=4096, k=3),
        "secondary sort": joins.secondary_sort_join(dim, big, "k", "bk", ["name"], ["v"]),
    }.items():
        assert "SortMergeJoin(skew=true)" in _final_plan(spark, df), name
        assert df.count() == 20000, name


def test_bloom_answers_do_not_depend_on_the_join(spark, monkeypatch):
    monkeypatch.setattr(bloom, "BITS_PER_PART", 256)
    left = spark.range(5000).selectExpr("id AS lk", "id * 2 AS lv")
    right = spark.range(5000).selectExpr("id AS rk", "id * 3 AS rv")
    keys = spark.range(0, 5000, 50).selectExpr("id AS key")
    got = {}
    for threshold in ("-1", "100MB"):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        try:
            df = joins.bloom_join(left, right, "lk", "rk", keys, exact=False, fpr=0.1)
            plan = _final_plan(spark, df)
            assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
            got[threshold] = sorted(r.lk for r in df.collect())
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert got["-1"] == got["100MB"]
    listed = set(range(0, 5000, 50))
    extra = len(set(got["-1"]) - listed)
    assert listed <= set(got["-1"]) and 0 < extra < 0.25 * 4900  # a superset, at about the expected rate


def test_bloom_join_shuffles_the_left_once_and_runs_no_job_early(spark, tiny_partitions, monkeypatch):
    # Both forms: the filter as a value in the left's scan, and (m given, over the bound) as slices for the right.
    left = spark.range(5000).selectExpr("id AS lk", "id * 2 AS lv")
    right = spark.range(5000).selectExpr("id AS rk", "id * 3 AS rv")
    keys = spark.range(0, 5000, 50).selectExpr("id AS key")
    for bound, given in ((bloom.MAX_BITS, {}), (bloom.MAX_BITS, {"m": 4096, "k": 3}), (1 << 10, {"m": 4096, "k": 3})):
        for exact in (True, False):
            monkeypatch.setattr(bloom, "MAX_BITS", bound)
            spark.sparkContext.setJobGroup("plan", "building")
            df = joins.bloom_join(left, right, "lk", "rk", keys, exact=exact, fpr=0.1, **given)
            assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan")) == []
            spark.sparkContext.setJobGroup("run", "running")
            tree = _tree(spark, df)
            assert _exchanges_of_first_input(tree) == 1 and "Broadcast" not in tree, tree
            got = {r.lk for r in df.collect()}
            listed = set(range(0, 5000, 50))
            assert got == listed if exact else listed <= got
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _tree(spark, df):
    """The executed tree of the main query, without its subqueries."""
    df.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode).partition("\n\n\n")[0].split("== Initial Plan ==")[0]


def _exchanges_of_first_input(tree):
    """Exchanges between the root and the first leaf, by the tree's indentation."""
    lines = tree.splitlines()
    at = next(i for i, line in enumerate(lines) if "Scan" in line or "Range" in line)
    depth, count = len(lines[at]) - len(lines[at].lstrip(" :+-*")), 0
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-*"))
        if d < depth:
            depth, count = d, count + ("Exchange" in line)
    return count


@pytest.mark.parametrize("name", ["inner_join", "left_outer_join"])
def test_whole_tables_join_by_shuffle(spark, name):
    plan = _final_plan(spark, QUERIES[name](spark, SF))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_first_of_run_many_partitions_matches_oracle(spark):
    ev = table(spark, SF, "events", "user_id", "ts", "event_id", "event_type")
    out = agg.first_of_run(ev, ["event_type"], ["ts", "event_id"], partition_cols=["user_id"], num_partitions=13)
    assert rows(out.select("user_id", "event_id", "event_type")) == _sql_rows(entry.oracle_sql()["first_of_run_by_user"])
    out = agg.first_of_run(ev, ["event_type"], ["event_id"], num_partitions=29)
    assert rows(out.select("event_id", "event_type")) == _sql_rows(entry.oracle_sql()["first_of_run_global"])
