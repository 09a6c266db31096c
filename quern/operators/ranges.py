"""Ranges of a total order with explicit bounds: the basis of O1, O2, O6, A7 and J6.

``sketch`` is one value of the query that uses it (a scalar subquery): the
bounds that cut a table's rows, in the order of their keys, into buckets of
about equal size, found from a sample of the keys alone. ``bucket`` finds a
row's bucket by binary search. The number of a row's bucket then is a column
like any other: rows are shuffled by it once, buckets are summed up by it, and
nothing depends on which task a row happens to be in. No job runs while a plan
is built, and the rows themselves are not read for sampling, only their keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a bucket, as far as no number of buckets is given; most buckets; sampled keys for each bucket.
BUCKET_ROWS, MAX_BUCKETS, SAMPLES = 50_000, 1 << 16, 16


def most_buckets(df: DataFrame) -> int:
    """Buckets that are worth having: 64 for each of the session's shuffle partitions, ``MAX_BUCKETS`` at most."""
    return min(MAX_BUCKETS, 64 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def free_name(name: str, *taken: str) -> str:
    """``name``, with as many underscores after it as keep it from every column in ``taken`` (in any case of letters)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def key_struct(keys: Sequence[str | Column]) -> Column:
    """The keys as one struct, compared field by field, NULLs first."""
    return F.struct(*[(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)])


def sketch(df: DataFrame, keys: Sequence[str | Column], buckets: int | None = None, most: int | None = None,
           by_row: bool = False) -> Column:
    """Bounds for the keys of ``df``: a struct of the arrays ``bounds`` and ``lasts``.

    ``buckets`` of them, or one for every ``BUCKET_ROWS`` rows, ``most``
    (``most_buckets``) at most. Keys are sampled by their hash, so the same table gives the same
    bounds wherever the value is used; a key counts once, however often it is
    there. ``by_row`` samples rows instead, for keys that repeat, where no two
    uses must agree. ``lasts`` holds the last sampled key of each bucket: the
    bucket's greatest key is not below it.
    """
    rows, most = F.count(F.lit(1)), most or most_buckets(df)
    wanted = F.lit(buckets) if buckets else F.least(F.lit(most), F.ceil(rows / F.lit(BUCKET_ROWS)))
    every = df.agg(F.greatest(F.lit(1).cast("long"), F.call_function(
        "div", rows, F.greatest(F.lit(1), wanted).cast("long") * SAMPLES))).scalar()
    found = df.select(key_struct(keys).alias("key"))
    if by_row:
        found = found.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), every) == 0)
    else:
        found = found.filter(F.pmod(F.xxhash64("key"), every) == 0).distinct()
    sample = found.agg(F.array_sort(F.collect_list("key")).alias("s")).select("s", F.size("s").cast("long").alias("n"))
    w = F.lit(buckets) if buckets else F.least(F.lit(most), F.round(F.col("n") / SAMPLES))
    # Places in the sample where a bucket begins, each once; the generator computes them once.
    cuts = F.when((w > 1) & (F.col("n") > 0), F.sequence(F.lit(1).cast("long"), w.cast("long") - 1))
    cuts = F.coalesce(cuts, F.array().cast("array<long>"))
    at = F.array_distinct(F.transform(cuts, lambda i: F.call_function("div", i * F.col("n"), w.cast("long"))))
    placed = sample.select("s", "n", F.explode(F.array(at)).alias("at"))
    return placed.select(F.struct(
        F.transform("at", lambda p: F.get("s", p.cast("int"))).alias("bounds"),
        F.transform(F.concat("at", F.array("n")), lambda p: F.get("s", (p - 1).cast("int"))).alias("lasts"),
    ).alias("ranges")).scalar()


def bucketed(df: DataFrame, ranges: Column, keys: Sequence[str | Column], most: int | None = None, name: str = "_bucket") -> DataFrame:
    """``df`` with the number of bounds that are not above each row's keys: 0 for the first bucket, ``most`` - 1 at most.

    Each step of the binary search is a column that the next one refers to,
    so that each is computed once; past the last bound ``get`` gives NULL and
    the step stays. The generator keeps the search from being repeated where
    the column is used.
    """
    most = most or most_buckets(df)
    bits = list(reversed(range(max(1, most - 1).bit_length())))
    key, *low = (free_name(n, *df.columns, name) for n in ("_range_key", *(f"_range_low{b}" for b in [*bits, "_0"])))
    steps = [key_struct(keys).alias(key), F.lit(0).alias(low[0])]
    for b, before, after in zip(bits, low, low[1:], strict=False):
        ahead = F.get(ranges["bounds"], F.col(before) + F.lit((1 << b) - 1)) <= F.col(key)
        steps.append((F.col(before) + F.when(ahead, F.lit(1 << b)).otherwise(F.lit(0))).alias(after))
    out = df.select(*df.columns, *steps)
    return out.select(*df.columns, F.explode(F.array(low[-1])).alias(name))


def at_the_end(ranges: Column, keys: Sequence[str | Column], fields: int | None = None, name: str = "_bucket") -> Column:
    """True for the rows among which each bucket's greatest is: those not below its last sampled key, in the first ``fields`` keys."""
    last = F.get(ranges["lasts"], F.col(name))
    if fields:
        last = F.struct(*[last[f"k{i}"].alias(f"k{i}") for i in range(fields)])
        return F.get(ranges["lasts"], F.col(name)).isNull() | (key_struct(keys[:fields]) >= last)
    return F.coalesce(key_struct(keys) >= last, F.lit(True))
