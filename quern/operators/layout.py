"""Output layouts (O4, O5): how rows are spread over tasks and files, and sorted inside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from quern.operators.agg import spread_tiebreak


def partitioned_sorted(df: DataFrame, key: str | Sequence[str], num_partitions: int) -> DataFrame:
    """``num_partitions`` hash partitions by key, each sorted by key.

    Written out, this gives one key-sorted file per partition. Use it after
    an aggregation, where every key is one row, so no partition can be hot.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.repartition(num_partitions, *keys).sortWithinPartitions(*keys)


def secondary_sort(df: DataFrame, key: str, sort_cols: Sequence[str],
                   num_partitions: int | None = None, split_hot_keys: bool = False) -> DataFrame:
    """O3 + O4: route rows by ``key``, sort each partition by (key, sort_cols).

    Default: hash-route by ``key`` alone, so all rows of a key meet in one
    partition in (key, sort_cols) order, the layout a secondary-sort reducer
    reads; a key is never split, so one hot key makes one large task.

    ``split_hot_keys=True``: range-route by (key, sort_cols, input partition,
    row hash) instead (see ``agg.spread_tiebreak``). The rows are in one global (key, sort_cols) order, every key's
    rows are contiguous, and a key larger than a partition continues into
    the next partition rather than filling one task.
    """
    keys = [key, *sort_cols]
    if split_hot_keys:
        ties = ["_quern_tie0", "_quern_tie1"]
        tied = df.select("*", *[c.alias(t) for c, t in zip(spread_tiebreak(df), ties, strict=True)])
        ranged = (tied.repartitionByRange(num_partitions, *keys, *ties) if num_partitions
                  else tied.repartitionByRange(*keys, *ties))
        return ranged.sortWithinPartitions(*keys, *ties).drop(*ties)
    parted = df.repartition(num_partitions, key) if num_partitions else df.repartition(key)
    return parted.sortWithinPartitions(*keys)

