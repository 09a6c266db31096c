"""Connected components of a link table, by alternating star contractions.

Each round links every node's larger neighbours to its smallest one (large
star), then each node's smaller neighbours to the smallest (small star),
until the links are one star per component. Only a count and a checksum of
the links reach the driver in each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import checkpointed


def _to_smallest(links: DataFrame) -> DataFrame:
    """``links`` (a, b) with ``m``, the smallest of a and its b's.

    The minimum is a partial aggregate, and both sides of the join are plain
    tables, so a node that holds a large share of the links is split by Spark.
    """
    smallest = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return links.join(checkpointed(smallest).withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).drop("_a")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node with a link to another; root: the component's smallest node.

    ``links`` holds pairs in columns ``a`` and ``b``, in either direction,
    repeated or not; pairs of a node with itself or with NULL are left out.
    No links give no rows.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("_x"), F.col(b).alias("_y"))
    pairs = pairs.filter((F.col("a") != F.col("b")) & F.col("_x").isNotNull() & F.col("_y").isNotNull())
    pairs = checkpointed(pairs.select("a", "b").distinct())
    state = _state(pairs)
    while state[0]:
        both = checkpointed(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        large = _to_smallest(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.filter("a <> b").distinct())
        small = _to_smallest(large)
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        pairs = checkpointed(small.filter("a <> b").distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
