"""No false negatives, a false-positive rate near theory, the sizing rule."""

import math

from pyspark.sql import functions as F

from quern.operators import bloom


def test_size_for_rule():
    m, k = bloom.size_for(1000, 0.01)
    assert m >= math.log2(math.e) * 1000 * math.log2(100) and m % 64 == 0
    assert k == round(math.log(2) * m / 1000) == 7


def test_size_columns_are_the_rule(spark):
    for n in (1, 7, 1000, 12_345_678):
        df = spark.range(1).select(*bloom.size_columns(F.lit(n), 0.01))
        assert tuple(df.first()) == bloom.size_for(n, 0.01)


def test_layout_parts():
    assert bloom.layout(10_000) == (1, 10_048)
    parts, per = bloom.layout(bloom.BITS_PER_PART * 3 + 5)
    assert parts == 4 and per % 64 == 0 and parts * per >= bloom.BITS_PER_PART * 3 + 5


def test_no_false_negatives_and_fpr(spark):
    n = 2000
    keys = spark.range(0, n * 10, 10).select(F.col("id").alias("k"))
    m, k = bloom.size_for(n, 0.01)
    filt = bloom.build(keys, "k", m, k)
    members = bloom.might_contain(keys, "k", filt, m, k)
    assert members.count() == n
    others = spark.range(1, 200_000, 10).select(F.col("id").alias("k"))
    rate = bloom.might_contain(others, "k", filt, m, k).count() / others.count()
    assert rate < 0.03


def test_multi_part_filter(spark, monkeypatch):
    monkeypatch.setattr(bloom, "BITS_PER_PART", 1024)
    keys = spark.range(0, 500).select(F.col("id").cast("string").alias("k"))
    m, k = bloom.size_for(500, 0.05)
    assert bloom.layout(m)[0] > 1
    filt = bloom.build(keys, "k", m, k)
    assert filt.count() == bloom.layout(m)[0]
    assert bloom.might_contain(keys, "k", filt, m, k).count() == 500


def _rate(spark, n, fpr, **kw):
    keys = spark.range(n).select((F.col("id") * 7).alias("k"))
    k = bloom.hashes(fpr)
    filt = bloom.value(keys, "k", k, fpr=fpr, **kw)
    assert bloom.keep(keys, "k", filt, k).count() == n              # no false negative
    others = spark.range(200_000).select((F.col("id") * 7 + 3).alias("k"))
    return bloom.keep(others, "k", filt, k).count() / 200_000


def test_value_filter_sizes_itself_and_keeps_the_rate(spark):
    for n, fpr in ((1, 0.01), (50, 0.05), (3000, 0.01), (50_000, 0.01), (20_000, 0.1), (20_000, 0.0005)):
        rate = _rate(spark, n, fpr)
        assert rate < 2 * fpr + 0.0005, (n, fpr, rate)


def test_value_filter_at_its_bound_loses_no_member(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BITS", 1 << 13)
    assert 0.05 < _rate(spark, 5000, 0.01) < 1                               # it passes more, never less


def test_value_filter_of_no_keys_and_null_keys(spark):
    keys = spark.createDataFrame([(None,), (5,)], "k long")
    none, own, given = (bloom.value(keys.limit(0), "k", 7), bloom.value(keys, "k", 7), bloom.value(keys, "k", 7, m=64))
    assert [bloom.keep(keys, "k", f, 7).collect() for f in (none, own, given)] == [[], [(5,)], [(5,)]]


def test_a_block_is_k_neighbouring_words_with_one_bit_each(spark):
    m, k = bloom.size_for(1, 0.01)[0], 7
    words = bloom.build(spark.createDataFrame([("x",)], "k string"), "k", 4096, k).first()._words
    assert len(words) == -(-4096 // (64 * k)) * k
    hit = [i for i, w in enumerate(words) if w]
    assert len(hit) == k and hit[0] % k == 0 and hit == list(range(hit[0], hit[0] + k))
    assert all(bin(words[i] & (2**64 - 1)).count("1") == 1 for i in hit) and m % 64 == 0


def test_filter_table_comes_from_the_keys_alone(spark):
    # One aggregate over the keys and a row of zeros for each block: the estimate does not multiply.
    keys = spark.range(100_000).select(F.col("id").alias("k"))
    m, k = bloom.size_for(100_000, 0.01)
    plan = bloom.build(keys, "k", m, k)._jdf.queryExecution()
    assert "Join" not in plan.optimizedPlan().toString()
    size = int(plan.optimizedPlan().stats().sizeInBytes())
    assert m / 8 <= size <= 25 * m / 8
