"""Hot-key counts, and what building a plan must not do."""

import pytest

from quern.operators import sizing
from quern.plans import QUERIES

SF = "/root/testdata/sf0.001"


def test_hot_keys_slices(spark):
    df = spark.createDataFrame([(0,)] * 25 + [(1,)] * 3, "k long")
    assert [tuple(r) for r in sizing.hot_keys(df, ["k"], max_rows=10).collect()] == [(0, 3)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_building_a_query_leaves_no_cache(spark, name):
    spark.catalog.clearCache()
    QUERIES[name](spark, SF)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_a_callers_cache_survives(spark):
    from quern.operators import joins

    cust = spark.range(100).withColumnRenamed("id", "k").cache()
    cust.count()
    joins.lookup_join(spark.range(50).withColumnRenamed("id", "b"), cust.selectExpr("k", "k AS v"), "b", "k", ["v"], order="v").count()
    assert cust.is_cached and not spark._jsparkSession.sharedState().cacheManager().isEmpty()
    cust.unpersist()
