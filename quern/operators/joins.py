"""The reference's five join styles, plus co-group and key lists.

Keys are given as column names; left and right payload names must not
collide (rename first). No side is broadcast by force, no job runs while a
plan is built, and no exact result depends on a size limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from quern.operators import bloom, ranges
from quern.operators.agg import sorted_rows
from quern.operators.sizing import hot_keys


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _condition(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str]) -> Column:
    cond = None
    for lk, rk in zip(left_on, right_on, strict=True):
        term = left[lk] == right[rk]
        cond = term if cond is None else cond & term
    return cond


def _split_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Inner join whose sides are each dealt out for it, so adaptive execution can split a hot key.

    A side that an aggregate or a semi join has already dealt by the key
    would be joined in place, which cannot be split; the key wrapped in a
    struct is dealt anew. Structs of NULLs are equal, so NULL keys go first.
    """
    lf, rf = left.filter(left[left_on].isNotNull()), right.filter(right[right_on].isNotNull())
    return lf.join(rf, F.struct(lf[left_on].alias("k")) == F.struct(rf[right_on].alias("k")), "inner")


def join_keys(df: DataFrame, key: str, out_col: str | None = None) -> DataFrame:
    """The distinct join keys of a table, as a one-column key list."""
    return df.select(F.col(key).alias(out_col or key)).distinct()


def _key_list(keys: DataFrame, keys_col: str | None) -> DataFrame:
    kc = keys_col or keys.columns[0]
    return keys.select(F.col(kc).alias("_key")).distinct()


def _semi(df: DataFrame, key: str, klist: DataFrame) -> DataFrame:
    return df.join(klist, df[key] == klist["_key"], "left_semi")


def filter_by_keys(df: DataFrame, key: str, keys: DataFrame, keys_col: str | None = None) -> DataFrame:
    """Keep the rows of ``df`` whose ``key`` is in the key list.

    A left-semi join; Spark makes it map-side when the list is small.
    """
    return _semi(df, key, _key_list(keys, keys_col))


def equi_join(left: DataFrame, right: DataFrame, left_on: str | Sequence[str],
              right_on: str | Sequence[str], how: str = "inner", strategy: str = "shuffle") -> DataFrame:
    """J8 (``how="inner"``) and J1 (``how="left"``): equi-joins.

    Output: left columns then right columns. For the left outer join an
    unmatched left row gets NULL in every right column (the text sink
    renders that as the single field ``null``).

    Left outer, ``strategy="shuffle"``: inner join UNION (left anti distinct
    right keys). A hot key on the right side can then be split by AQE's skew
    handling (which cannot split the right side of a left outer join), and
    the anti side only sees one row per key. ``strategy="auto"`` is Spark's
    own left outer join: one pass over the left, for a right side without
    hot keys or small enough to be broadcast. The result is the same.
    """
    lo, ro = _names(left_on), _names(right_on)
    if how == "inner":
        return left.join(right, _condition(left, right, lo, ro), "inner")
    if how != "left":
        raise ValueError(f"unsupported join type {how!r}; the reference has inner and left outer")
    if strategy not in ("auto", "shuffle"):
        raise ValueError("strategy must be 'auto' or 'shuffle'")
    if strategy == "auto":
        return left.join(right, _condition(left, right, lo, ro), "left")
    # Both joins read the same non-null-key left input, so its shuffle is
    # planned once and reused; a NULL key never matches, so those rows are
    # unmatched without any join.
    has_key = None
    for k in lo:
        term = F.col(k).isNotNull()
        has_key = term if has_key is None else has_key & term
    keyed = left.filter(has_key)
    matched = keyed.join(right, _condition(keyed, right, lo, ro), "inner")
    rkeys = right.select(*[F.col(k).alias(f"_rk{i}") for i, k in enumerate(ro)]).distinct()
    cond = None
    for i, k in enumerate(lo):
        term = keyed[k] == rkeys[f"_rk{i}"]
        cond = term if cond is None else cond & term
    unmatched = keyed.join(rkeys, cond, "left_anti")
    if any(left.schema[k].nullable for k in lo):
        unmatched = unmatched.unionByName(left.filter(~has_key))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select(*left.columns, *nulls))


def lookup_join(big: DataFrame, dim: DataFrame, big_on: str, dim_on: str,
                dim_cols: Sequence[str], order: str | Sequence[str],
                sort_output: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Dimension lookup; inner; a repeated dimension key keeps its last row.

    "Last" is the greatest ``order`` (the reference's arrival order, made an
    explicit column), and of equal orders the greatest payload. The dimension
    is reduced to one row per key by a partial aggregate; Spark then joins
    map-side or shuffles, splitting a hot key. Output: key, dimension
    columns, then the big table's columns. ``sort_output`` orders by key (O6).
    """
    cols = list(dim_cols)
    ordering = F.struct(*[F.col(c) for c in (*_names(order), *cols)])
    last = (dim.groupBy(F.col(dim_on).alias("_dk"))
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_d"))
            .select("_dk", *[F.col("_d." + c).alias(c) for c in cols]))
    out = _split_join(big, last, big_on, "_dk").select(F.col("_dk").alias(dim_on), *cols, *big.columns)
    if not sort_output:
        return out
    # The order's bounds come from the big table's keys, not from the join, which is run once.
    keys = big.filter(F.col(big_on).isNotNull()).select(F.col(big_on).alias(dim_on))
    return sorted_rows(out, [dim_on], num_partitions, keys_of=keys)


def prefiltered_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                     keys: DataFrame, keys_col: str | None = None) -> DataFrame:
    """Only the rows of both sides whose key is in the key list, inner joined.

    Cutting the right side alone gives that result, as an inner join drops
    the left's other rows; the left is then shuffled once. Unlike an SQL semi
    join, the result has the columns of both tables.
    """
    return _split_join(left, _semi(right, right_on, _key_list(keys, keys_col)), left_on, right_on)


def bloom_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
               keys: DataFrame, keys_col: str | None = None, fpr: float = 0.01,
               exact: bool = True, m: int | None = None, k: int | None = None) -> DataFrame:
    """Drop left rows whose key fails a Bloom test over the key list, then inner join.

    The filter is one value of the query (``bloom.value``): left rows are
    tested where they are read, and only those that pass are shuffled, once,
    by the join. Its bits come from ``fpr`` and a sketch of the number of keys
    inside the query (P15), or are ``m`` with ``k`` hashes. A filter of more
    than ``bloom.MAX_BITS`` bits, which only a given ``m`` can ask for, is a
    table of slices: then the right rows are tested, which leaves the same
    result, as joined rows have one key, and the left is still shuffled once.

    ``exact=True`` also restricts the right side to the key list, which
    removes every false positive from the result; ``exact=False`` keeps the
    reference's behaviour, where a false positive reaches the output if the
    right table has that key. A NULL key matches nothing.
    """
    key_type = left.schema[left_on].dataType
    klist = _key_list(keys, keys_col).select(F.col("_key").cast(key_type).alias("_key"))
    if m is None or k is None:
        m, k = None, bloom.hashes(fpr)
    if m is None or m <= bloom.MAX_BITS:
        left = bloom.keep(left, left_on, bloom.value(klist, "_key", k, m, fpr), k)
    else:
        typed = right.withColumn(right_on, F.col(right_on).cast(key_type))
        right = bloom.might_contain(typed, right_on, bloom.build(klist, "_key", m, k), m, k)
    return _split_join(left, _semi(right, right_on, klist) if exact else right, left_on, right_on)


def _struct_type(df: DataFrame, cols: Sequence[str]) -> DataType:
    """The data type of ``struct(cols)`` over ``df`` (analysis only, no job)."""
    return df.select(F.struct(*[F.col(c) for c in cols])).schema.fields[0].dataType


def tagged_union(dim: DataFrame, facts: DataFrame, dim_key: str, fact_key: str,
                 key_col: str = "key", tag_col: str = "tag") -> DataFrame:
    """S3 / P10: both inputs in one flow, tagged 0 (dimension) and 1 (records).

    Payloads are kept as two struct columns, ``dim`` and ``rec``; the one
    that does not belong to a row is NULL.
    """
    dcols = [c for c in dim.columns if c != dim_key]
    rcols = [c for c in facts.columns if c != fact_key]
    dtype, rtype = _struct_type(dim, dcols), _struct_type(facts, rcols)
    d = dim.select(F.col(dim_key).alias(key_col), F.lit(0).alias(tag_col),
                   F.struct(*[F.col(c) for c in dcols]).alias("dim"),
                   F.lit(None).cast(rtype).alias("rec"))
    r = facts.select(F.col(fact_key).alias(key_col), F.lit(1).alias(tag_col),
                     F.lit(None).cast(dtype).alias("dim"),
                     F.struct(*[F.col(c) for c in rcols]).alias("rec"))
    return d.unionByName(r)


def secondary_sort_join(dim: DataFrame, facts: DataFrame, dim_key: str, fact_key: str,
                        dim_cols: Sequence[str], fact_cols: Sequence[str],
                        dim_order: str | Sequence[str] | None = None,
                        max_group_rows: int = 1_000_000,
                        spread: Column | None = None, strategy: str = "auto") -> DataFrame:
    """Records enriched with the first dimension row of their key; inner.

    The dimension is first reduced to one row per key, the first in
    ``dim_order`` (a partial ``min_by`` aggregate). ``strategy="auto"`` joins
    it, map-side if Spark finds it small. ``strategy="window"`` is the
    secondary-sort mechanism: both sides go into one flow (dimension tag 0,
    records tag 1), partitioned by key and sorted by (key, tag), and every
    record takes the dimension row of its key by a running
    ``first(..., ignorenulls)`` window, one shuffle and one sort, with no
    per-key list. A record whose key has no dimension row is dropped.

    Keys with more than ``max_group_rows`` records are salted: their records
    are spread over ceil(n / max_group_rows) slices by ``spread`` (default: a
    hash of the record), and their dimension rows are copied to each slice,
    so no window partition grows past ``max_group_rows`` records.
    """
    if strategy not in ("auto", "window"):
        raise ValueError("strategy must be 'auto' or 'window'")
    dcols, fcols = list(dim_cols), list(fact_cols)
    ord_cols = _names(dim_order) if dim_order else dcols
    # One row per key: the first in order, and of equal orders the least payload.
    dim = (dim.filter(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("_dk"))
           .agg(F.min_by(F.struct(*[F.col(c) for c in dcols]),
                         F.struct(*[F.col(c) for c in (*ord_cols, *dcols)])).alias("_d"))
           .select("_dk", *[F.col("_d." + c).alias(c) for c in dcols]))
    if strategy == "auto":
        return _split_join(facts, dim, fact_key, "_dk").select(F.col(fact_key), *dcols, *fcols)
    dim_type, rec_type = _struct_type(dim, dcols), _struct_type(facts, fcols)
    # A NULL key matches nothing in a join; a window would group NULLs together.
    facts = facts.filter(F.col(fact_key).isNotNull())
    hot = hot_keys(facts.select(F.col(fact_key).alias("_k")), ["_k"], max_group_rows)
    spread = spread if spread is not None else F.xxhash64(*[F.col(c) for c in fcols])

    f = facts.join(hot, facts[fact_key] == hot["_k"], "left")
    f = f.select(F.col(fact_key).alias("_key"),
                 F.when(F.col("_slices").isNull(), F.lit(0))
                 .otherwise(F.pmod(spread, F.col("_slices"))).cast("int").alias("_salt"),
                 F.lit(1).alias("_tag"),
                 F.lit(None).cast(dim_type).alias("_dim"),
                 F.struct(*[F.col(c) for c in fcols]).alias("_rec"))

    d = dim.join(hot, dim["_dk"] == hot["_k"], "left")
    d = d.select(F.col("_dk").alias("_key"),
                 F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)).alias("_salt"),
                 F.lit(0).alias("_tag"),
                 F.struct(*[F.col(c) for c in dcols]).alias("_dim"),
                 F.lit(None).cast(rec_type).alias("_rec"))

    flow = d.unionByName(f)
    w = (Window.partitionBy("_key", "_salt").orderBy("_tag")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = flow.withColumn("_station", F.first("_dim", ignorenulls=True).over(w))
    joined = joined.filter((F.col("_tag") == 1) & F.col("_station").isNotNull())
    return joined.select(F.col("_key").alias(fact_key),
                         *[F.col("_station." + c).alias(c) for c in dcols],
                         *[F.col("_rec." + c).alias(c) for c in fcols])


def cogroup(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
            left_cols: Sequence[str], right_cols: Sequence[str], key_col: str = "key",
            num_partitions: int | None = None) -> DataFrame:
    """The left rows and the right rows of each key together, in key order.

    One output row per input row: ``key_col``, ``side`` (0 left, 1 right),
    ``left_row`` and ``right_row`` (structs; the other side's is NULL), and
    ``n_left`` and ``n_right``, the rows of the key on each side. A key's
    rows are contiguous, left before right, over range partitions; a key of
    any size continues into the next partition, so no list, task or row holds
    a group. NULL is a key like any other here.
    """
    lcols, rcols = list(left_cols), list(right_cols)
    ltype, rtype = _struct_type(left, lcols), _struct_type(right, rcols)
    one = left.select(F.col(left_on).alias(key_col), F.lit(0).alias("side"),
                      F.struct(*[F.col(c) for c in lcols]).alias("left_row"), F.lit(None).cast(rtype).alias("right_row"))
    two = right.select(F.col(right_on).alias(key_col), F.lit(1).alias("side"),
                       F.lit(None).cast(ltype).alias("left_row"), F.struct(*[F.col(c) for c in rcols]).alias("right_row"))
    flow = one.unionByName(two)
    counts = flow.groupBy(F.col(key_col).alias("_k")).agg(
        F.count_if(F.col("side") == 0).alias("n_left"), F.count_if(F.col("side") == 1).alias("n_right"))
    # Structs of NULLs are equal; both sides are dealt anew, so a hot key can be split.
    met = flow.join(counts, F.struct(flow[key_col].alias("k")) == F.struct(counts["_k"].alias("k")))
    out = met.select(key_col, "side", "left_row", "right_row", "n_left", "n_right")
    return sorted_rows(out, [key_col, "side"], num_partitions, keys_of=flow)


def cogroup_lists(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                  left_cols: Sequence[str], right_cols: Sequence[str],
                  left_order: Sequence[str], right_order: Sequence[str], key_col: str = "key",
                  chunk_rows: int = 1000, buckets: int | None = None) -> DataFrame:
    """The list of left rows and the list of right rows of each key, in numbered chunks.

    One row per key and chunk: ``key_col``, ``chunk`` (from 0), ``n_left`` and
    ``n_right`` (rows of the key on each side), ``left_rows`` and
    ``right_rows``: arrays of structs, the side's rows from place chunk *
    ``chunk_rows`` on in its order, ``chunk_rows`` at most. A key's chunks end
    with its longer side; a side's list put together from its chunks is whole
    and in order. ``left_order`` and ``right_order`` should tell a key's rows
    of that side apart; rows that tie come in either order. NULL is a key like
    any other.

    No task, list or row holds a key: rows are placed by ranges of (key, side,
    order), numbered inside each range, and the numbers go on from one range
    to the next by the count of the range's last key, which is taken from the
    rows at range ends before the rows are shuffled.
    """
    lcols, rcols = list(left_cols), list(right_cols)
    ltype, rtype = _struct_type(left, lcols), _struct_type(right, rcols)
    lorder, rorder = _struct_type(left, left_order), _struct_type(right, right_order)
    one = left.select(F.col(left_on).alias("_key"), F.lit(0).alias("_side"),
                      F.struct(*[F.col(c) for c in left_order]).alias("_lo"), F.lit(None).cast(rorder).alias("_ro"),
                      F.struct(*[F.col(c) for c in lcols]).alias("_left"), F.lit(None).cast(rtype).alias("_right"))
    two = right.select(F.col(right_on).alias("_key"), F.lit(1).alias("_side"),
                       F.lit(None).cast(lorder).alias("_lo"), F.struct(*[F.col(c) for c in right_order]).alias("_ro"),
                       F.lit(None).cast(ltype).alias("_left"), F.struct(*[F.col(c) for c in rcols]).alias("_right"))
    flow, keys = one.unionByName(two), ["_key", "_side", "_lo", "_ro"]
    bounds = ranges.sketch(flow, keys, buckets)
    base = ranges.bucketed(flow, bounds, keys, most=buckets)

    # The last (key, side) of each bucket and its rows there; added up along its buckets, they come
    # before the next bucket's rows of that (key, side).
    ends = (base.filter(ranges.at_the_end(bounds, keys, 2)).groupBy("_bucket", "_key", "_side").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("_bucket").agg(F.max_by("_n", F.struct("_key", "_side")).alias("_n"), F.max(F.struct("_key", "_side")).alias("_g")))
    along = Window.partitionBy("_g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ends.select((F.col("_bucket") + 1).alias("_b"), F.col("_g").alias("_bg"), F.sum("_n").over(along).alias("_before"))

    routed = base.repartition("_bucket")
    if buckets:  # rows and counts are dealt alike, so the join deals neither again
        routed, before = base.repartitionById(buckets, F.col("_bucket")), before.repartitionById(buckets, F.col("_b"))
    inside = F.row_number().over(Window.partitionBy("_bucket", "_key", "_side").orderBy("_lo", "_ro"))
    met = routed.withColumn("_in", inside).join(before, F.col("_bucket") == F.col("_b"), "left")
    # Structs of NULLs are equal, so a NULL key finds its count as well.
    going_on = F.when(F.struct(F.col("_key"), F.col("_side")) == F.col("_bg"), F.col("_before"))
    at = F.coalesce(going_on, F.lit(0)) + F.col("_in") - 1
    rows = met.select("_key", "_side", "_left", "_right", at.alias("_at")).withColumn("_chunk", F.floor(F.col("_at") / chunk_rows))

    def listed(side: int, row: str) -> Column:
        own = F.collect_list(F.when(F.col("_side") == side, F.struct("_at", row)))
        return F.transform(F.array_sort(own), lambda r: r[row])

    chunks = rows.groupBy("_key", "_chunk").agg(listed(0, "_left").alias("left_rows"), listed(1, "_right").alias("right_rows"))
    counts = flow.groupBy(F.col("_key").alias("_k")).agg(
        F.count_if(F.col("_side") == 0).alias("n_left"), F.count_if(F.col("_side") == 1).alias("n_right"))
    # Both sides are dealt anew, so the many chunks of a hot key can be split.
    out = chunks.join(counts, F.struct(chunks["_key"].alias("k")) == F.struct(counts["_k"].alias("k")))
    return out.select(F.col("_key").alias(key_col), F.col("_chunk").alias("chunk"), "n_left", "n_right", "left_rows", "right_rows")
