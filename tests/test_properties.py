"""Operators against brute force on random data with a hot key and NULL keys."""

import random
from collections import Counter

import pytest
from conftest import rows

from quern.operators import agg, joins

SEEDS = [1, 2]


def _data(seed, n_left=40, n_right=300):
    rnd = random.Random(seed)

    def key():
        r = rnd.random()
        return 0 if r < 0.4 else (None if r < 0.45 else rnd.randint(1, 30))

    left = [(key(), f"l{i}") for i in range(n_left)]
    right = [(key(), i) for i in range(n_right)]
    return left, right


def _frames(spark, left, right):
    lf = spark.createDataFrame(left, "lk long, lv string")
    rf = spark.createDataFrame(right, "rk long, rv long")
    return lf, rf


@pytest.mark.parametrize("seed", SEEDS)
def test_left_outer_matches_nested_loop(spark, seed):
    left, right = _data(seed)
    lf, rf = _frames(spark, left, right)
    got = rows(joins.equi_join(lf, rf, "lk", "rk", how="left"))
    assert rows(joins.equi_join(lf, rf, "lk", "rk", how="left", strategy="shuffle")) == got
    expect = []
    for lk, lv in left:
        matches = [(rk, rv) for rk, rv in right if lk is not None and rk == lk]
        expect += [(lk, lv, rk, rv) for rk, rv in matches] or [(lk, lv, None, None)]
    assert got == sorted(expect, key=lambda r: tuple((x is None, x) for x in r))
    inner = rows(joins.equi_join(lf, rf, "lk", "rk"))
    assert inner == sorted([r for r in expect if r[2] is not None])


@pytest.mark.parametrize("seed", SEEDS)
def test_prefiltered_and_bloom_equal_restricted_inner(spark, seed):
    left, right = _data(seed)
    lf, rf = _frames(spark, left, right)
    keys = spark.createDataFrame([(k,) for k in (0, 3, 5, 7, 1000)], "k long")
    expect = rows(joins.equi_join(lf, rf, "lk", "rk").filter("lk in (0, 3, 5, 7, 1000)"))
    assert rows(joins.prefiltered_join(lf, rf, "lk", "rk", keys)) == expect
    assert rows(joins.bloom_join(lf, rf, "lk", "rk", keys, exact=True)) == expect


@pytest.mark.parametrize("seed", SEEDS)
def test_lookup_last_wins(spark, seed):
    left, right = _data(seed)
    dim = [(k, f"d{i}", i) for i, (k, _) in enumerate(left) if k is not None]
    dim_df = spark.createDataFrame(dim, "dk long, name string, ord long")
    _, rf = _frames(spark, left, right)
    got = rows(joins.lookup_join(rf, dim_df, "rk", "dk", ["name"], order="ord"))
    last = {}
    for k, name, _ in dim:
        last[k] = name
    expect = sorted((rk, last[rk], rk, rv) for rk, rv in right if rk in last)
    assert got == expect


@pytest.mark.parametrize("seed", SEEDS)
def test_cogroup_holds_every_row(spark, seed):
    left, right = _data(seed)
    lf, rf = _frames(spark, left, right)
    out = joins.cogroup(lf, rf, "lk", "rk", ["lv"], ["rv"]).collect()
    lcount, rcount = Counter(k for k, _ in left), Counter(k for k, _ in right)
    assert sorted(((r.key, r.left_row.lv) for r in out if r.side == 0), key=str) == sorted(left, key=str)
    assert sorted(((r.key, r.right_row.rv) for r in out if r.side == 1), key=str) == sorted(right, key=str)
    assert all((r.n_left, r.n_right) == (lcount[r.key], rcount[r.key]) for r in out)


@pytest.mark.parametrize("seed", SEEDS)
def test_first_per_key_and_min(spark, seed):
    _, right = _data(seed)
    rf = spark.createDataFrame([(k, v, -v) for k, v in right], "k long, v long, w long")
    got = rows(agg.first_per_key(rf, "k", ["w"], ["v"]))
    best = {}
    for k, v in right:
        best[k] = max(best.get(k, v), v)
    assert got == sorted(best.items(), key=lambda r: (r[0] is None, r[0]))
    mins = rows(agg.min_per_key(rf, "k", "v"))
    low = {}
    for k, v in right:
        low[k] = min(low.get(k, v), v)
    assert mins == sorted(low.items(), key=lambda r: (r[0] is None, r[0]))


def test_secondary_sort_layout_splits_hot_key(spark):
    from pyspark.sql import functions as F

    from quern.operators import layout

    df = spark.createDataFrame([(0 if i % 3 else i, i % 2, i) for i in range(3000)], "k long, tag int, v long")
    plain = layout.secondary_sort(df, "k", ["tag"], num_partitions=6)
    spread = layout.secondary_sort(df, "k", ["tag"], num_partitions=6, split_hot_keys=True)
    per_part = lambda d: [r["count"] for r in d.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(per_part(plain)) >= 2000          # the hot key fills one partition
    assert max(per_part(spread)) < 1000          # and is spread when asked
    got = [(r.k, r.tag) for r in spread.collect()]
    assert got == sorted(got)                    # one global (key, tag) order
    assert sorted(r.v for r in spread.collect()) == list(range(3000))


def test_hot_right_key_is_split_by_aqe(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.createDataFrame([(i % 10, f"l{i}") for i in range(100)], "lk long, lv string")
        right = spark.createDataFrame([(0 if i % 2 else i % 50, i) for i in range(20000)], "rk long, rv long")
        for how, strategy in (("inner", "auto"), ("left", "shuffle")):
            df = joins.equi_join(left, right, "lk", "rk", how=how, strategy=strategy)
            assert df.count() > 0
            df.collect()
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
            final = df._jdf.queryExecution().explainString(mode).split("Initial Plan")[0]
            assert "SortMergeJoin(skew=true)" in final, (how, final)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
