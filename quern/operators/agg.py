"""Counting, grouping, de-duplication and ordering.

All aggregations here are decomposable (count, sum, min, min_by, distinct),
so Spark runs them as a partial aggregate before the shuffle: a key that
holds a third of the rows costs one partial row per input partition, not a
third of the data in one task. What depends on order (``sorted_rows``,
``first_of_run``) is built on ranges with explicit bounds, so that it never
needs a single partition for a group either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quern.functions.text import split_single_space, tokens
from quern.operators import ranges
from quern.operators.metrics import observed

_SPLITTERS = {
    "tokens": tokens,               # P1, StringTokenizer
    "space": split_single_space,    # P2, split(" ")
}


def explode_tokens(df: DataFrame, text_col: str | Column, splitter: str = "tokens",
                   word_col: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per token of ``text_col`` (``keep`` columns are carried along)."""
    split = _SPLITTERS[splitter]
    return df.select(*keep, F.explode(split(text_col)).alias(word_col))


def token_count(df: DataFrame, text_col: str | Column, splitter: str = "tokens",
                word_col: str = "word", count_col: str = "cnt",
                by: Sequence[str] = ()) -> DataFrame:
    """A1 / A2: rows per token (64-bit), optionally per ``by`` group as well.

    ``splitter="tokens"`` never yields an empty token; ``"space"`` yields the
    empty token for each doubled or leading blank, exactly as split(" ").
    """
    words = explode_tokens(df, text_col, splitter, word_col, keep=by)
    return words.groupBy(*by, word_col).agg(F.count(F.lit(1)).alias(count_col))


def token_count_observed(df: DataFrame, text_col: str | Column, splitter: str = "tokens",
                         name: str = "token_count") -> tuple[DataFrame, Observation, Observation]:
    """A1 / A2 with the A8 counts: lines in; then groups out and tokens counted.

    Returns ``(counts, lines_obs, groups_obs)``; after an action on
    ``counts``, ``lines_obs.get`` holds ``lines_in`` and ``groups_obs.get``
    holds ``groups_out`` and ``tokens``. The counts are aggregated on the
    executors while the job runs, nothing is printed per record.
    """
    lines, lines_obs = observed(df, f"{name}_in", lines_in=F.count(F.lit(1)))
    counts = token_count(lines, text_col, splitter=splitter)
    counts, groups_obs = observed(counts, f"{name}_out", groups_out=F.count(F.lit(1)),
                                  tokens=F.coalesce(F.sum("cnt"), F.lit(0)))
    return counts, lines_obs, groups_obs


def merge_counts(counts: DataFrame, key_cols: Sequence[str] | str, count_col: str = "cnt") -> DataFrame:
    """A3: add up counts that arrive already partly aggregated."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return counts.groupBy(*keys).agg(F.sum(count_col).cast("bigint").alias(count_col))


def min_per_key(df: DataFrame, key: str, value: str, out_col: str | None = None) -> DataFrame:
    """A4: the smallest ``value`` of every ``key``."""
    return df.groupBy(key).agg(F.min(value).alias(out_col or value))


def distinct_pairs(df: DataFrame, cols: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """A5 + O2: distinct combinations of ``cols``, in ascending order of all of them.

    The rows are unique after ``distinct`` (a partial aggregate, so copies
    collapse before the shuffle), so range partitioning on all of ``cols``
    cannot meet a hot key.
    """
    cols = list(cols)
    distinct = df.select(*cols).distinct()
    ranged = distinct.repartitionByRange(num_partitions, *cols) if num_partitions else distinct.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def spread_tiebreak(df: DataFrame) -> list[Column]:
    """Sort-key suffix that lets range partitioning split one hot key.

    (input partition id, hash of the whole row): rows that still tie are
    identical copies from one input partition, so at most one input split
    of rows can share a range-partition boundary value. Both parts are
    reproduced exactly when a lost task is re-run, whatever order its rows
    arrive in, so the routing of every row is stable under retries.
    """
    return [F.spark_partition_id(), F.xxhash64(*[F.col(c) for c in df.columns])]


def sorted_rows(df: DataFrame, by: Sequence[str], num_partitions: int | None = None,
                keys_of: DataFrame | None = None) -> DataFrame:
    """O1 / O2: total order on ``by``, every row kept, order inside equal keys undefined.

    Rows go to their range in one shuffle, and ``df`` is run once: the bounds
    come from the ``by`` columns of ``keys_of`` (default: of ``df`` itself,
    which then is run for these columns first). Give ``keys_of``, a table
    whose keys lie about as those of ``df`` do, where ``df`` is dear. A hash
    of (input partition id, row) is appended to the key, so a key, or a block
    of identical rows, that holds a large share of the data is split across
    several partitions; the parts of a row's hash are the same when a lost
    task is re-run. Partitions are ``num_partitions``, or by the number of
    rows and the session's shuffle partitions at most.
    """
    names = [f"_by{i}" for i in range(len(by))]
    spread = F.xxhash64(F.monotonically_increasing_id())
    source = (df if keys_of is None else keys_of).select(*[F.col(b).alias(n) for b, n in zip(by, names, strict=True)])
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bounds = ranges.sketch(source, [*names, spread], num_partitions, most=n, by_row=True)
    tie, place = ranges.free_name("_tie", *df.columns), ranges.free_name("_bucket", *df.columns)
    tied = df.withColumn(tie, F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]))
    placed = ranges.bucketed(tied, bounds, [*by, tie], most=n, name=place)
    return placed.repartitionById(n, F.col(place)).sortWithinPartitions(*by, tie).drop(place, tie)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                  value_cols: Sequence[str]) -> DataFrame:
    """Per key, the values of the row that comes first in ``order``.

    ``min_by`` over a struct of the order columns is a partial aggregate;
    ties in ``order`` are broken by the values themselves, so the result is
    deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    vals = list(value_cols)
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in vals])
    picked = F.min_by(F.struct(*[F.col(c) for c in vals]), ordering).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_first." + c).alias(c) for c in vals])


def first_of_run(df: DataFrame, run_cols: Sequence[str], order: Sequence[str],
                 partition_cols: Sequence[str] = (), num_partitions: int | None = None,
                 flag_col: str | None = None) -> DataFrame:
    """The first row of each run of equal ``run_cols`` along ``order``.

    Runs restart at each new value of ``partition_cols`` (none: one global
    sequence). ``order`` must be unique inside a partition group. Returns the
    first rows, or every row with a boolean ``flag_col`` when it is given.

    No group is ever handled by one task, not even a partition value that
    holds a third of all rows, and the rows are shuffled once:
      1. bounds from a sample of the keys (partition_cols, order) give every
         row the number of its bucket (``num_partitions`` of them, or by rows);
      2. ``lag`` inside each bucket, the only shuffle of the rows;
      3. the last run key of every bucket, at most one row per bucket, comes
         from the rows at its end before that shuffle, and is joined to the
         next bucket as the predecessor of its first row.
    ``df`` is read for its number of rows, its keys, the rows at bucket ends
    and then whole; checkpoint it first if it is dear to compute. It must
    give the same rows each time. No job runs while the plan is built.
    """
    keys = [*partition_cols, *order]
    run_key = F.struct(*[F.col(c) for c in (*partition_cols, *run_cols)])
    bounds = ranges.sketch(df, keys, num_partitions)
    base = ranges.bucketed(df, bounds, keys, most=num_partitions)

    tails = (base.filter(ranges.at_the_end(bounds, keys)).groupBy("_bucket")
             .agg(F.max_by(run_key, ranges.key_struct(keys)).alias("_tail")))
    carry = tails.select("_bucket", F.lag("_tail").over(Window.orderBy("_bucket")).alias("_carry"))

    routed = base
    if num_partitions:  # rows and carries are dealt alike, so the join deals neither again
        routed, carry = (d.repartitionById(num_partitions, F.col("_bucket")) for d in (base, carry))
    with_prev = routed.withColumn("_prev", F.lag(run_key).over(Window.partitionBy("_bucket").orderBy(*keys)))
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    first = prev.isNull() | ~prev.eqNullSafe(run_key)
    out = with_prev.join(carry, "_bucket", "left")
    if flag_col:
        return out.withColumn(flag_col, first).drop("_bucket", "_prev", "_carry")
    return out.filter(first).drop("_bucket", "_prev", "_carry")
