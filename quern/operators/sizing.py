"""Hot-key detection for skew.

No operator forces a broadcast: Spark picks one from file sizes, and its
adaptive execution from the measured bytes of a shuffled side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: list[str], max_rows: int, slices_col: str = "_slices") -> DataFrame:
    """Keys with more than ``max_rows`` rows and how many slices each needs.

    Returns one row per hot key: the key columns and ``slices_col`` =
    ceil(rows / max_rows). The count is a partial (map-side) aggregation, so
    it is cheap even when one key holds a third of the data.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return (counts.filter(F.col("_rows") > F.lit(max_rows))
            .select(*keys, F.ceil(F.col("_rows") / F.lit(max_rows)).cast("int").alias(slices_col)))
