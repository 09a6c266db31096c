"""Blocked Bloom filter as DataFrame expressions.

The bits are cut into blocks of k 64-bit words. A key belongs to one block, by
one hash, and sets one bit in each of its k words, by six bits each of another
hash: a test reads k neighbouring words. A filter comes in two forms.

* ``value``: one array of words, a scalar subquery of the query that uses it.
  Rows are tested where they are read, with no join and no shuffle. Its size
  is found inside the query, by P15 from a sketch of the number of keys, and
  bounded by ``MAX_BITS``: beyond the keys which that many bits serve, more
  rows pass, never fewer.
* ``build``: a table ``(_part INT, _words ARRAY<BIGINT>)`` for a filter of any
  size, cut into slices by a hash of the key, probed by an equi-join.

The exact bit layout of the reference's hash is not reproduced; any good hash
gives the same answers for members and a similar false-positive rate.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits per slice (128 KiB); one slice is one array value in the table.
BITS_PER_PART = 1 << 20
# Most bits of a filter that travels as one value (8 MiB, what Spark's own runtime filters have at most).
MAX_BITS = 1 << 26
# Six bits pick a bit of a word; a 64-bit hash has ten times six.
_FIELDS = 10


def size_for(n: int, fpr: float) -> tuple[int, int]:
    """Bits m and hash count k for n keys at false-positive rate ``fpr``.

    m >= log2(e) * n * log2(1 / fpr) and k = ln 2 * m / n, the rule the
    reference states; m is rounded up to whole 64-bit words.
    """
    if n <= 0 or not 0 < fpr < 1:
        raise ValueError("need n > 0 and 0 < fpr < 1")
    m = math.ceil(math.log2(math.e) * n * math.log2(1.0 / fpr))
    m = max(64, -(-m // 64) * 64)
    k = max(1, round(math.log(2) * m / n))
    return m, k


def size_columns(n: Column, fpr: float) -> tuple[Column, Column]:
    """P15 as columns: ``size_for`` of a key count (at least 1) that the query itself computes."""
    keys = F.greatest(n, F.lit(1)).cast("double")
    bits = F.ceil(F.lit(math.log2(math.e) * math.log2(1.0 / fpr)) * keys)
    m = F.greatest(F.lit(64).cast("long"), (F.ceil(bits / 64) * 64).cast("long"))
    return m, F.greatest(F.lit(1), F.round(F.lit(math.log(2)) * m / keys).cast("int"))


def layout(m: int) -> tuple[int, int]:
    """(parts, bits per part) for a filter of m bits; bits per part is a multiple of 64."""
    parts = max(1, -(-m // BITS_PER_PART))
    per = -(-m // parts)
    per = -(-per // 64) * 64
    return parts, per


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.hash(F.lit("quern-bloom-part"), key), F.lit(parts)).cast("int")


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _bit(key: Column, i: int) -> Column:
    """Which of its 64 bits the key sets in word i of its block."""
    return _field(F.xxhash64(F.lit(i // _FIELDS), key), i)


def _field(hashed: Column, i: int) -> Column:
    return F.shiftrightunsigned(hashed, 6 * (i % _FIELDS) + 4).bitwiseAND(F.lit(63)).cast("int")


def _blocks(keys: DataFrame, key_col: str, blocks: Column, k: int, sized: DataFrame, parts: int = 1) -> DataFrame:
    """``(_part, _block, _w0, ...)``: the words of every block of every part, by one aggregate.

    The keys' own bits and a row of zeros for every block are one input, so a
    block without keys is there too (``sized``: one row with the number of
    ``blocks``). Rows are bounded by the filter's blocks.
    """
    key, words = F.col(key_col), [f"_w{i}" for i in range(k)]
    own = keys.filter(key.isNotNull()).select(
        _part(key, parts).alias("_part"), _block(key, blocks).alias("_block"),
        *[F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key, i)).alias(w) for i, w in enumerate(words)])
    empty = (sized.select("blocks", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
             .select("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("_block"),
                     *[F.lit(0).cast("long").alias(w) for w in words]))
    return own.unionByName(empty).groupBy("_part", "_block").agg(*[F.bit_or(w).alias(w) for w in words])


def _words(k: int) -> Column:
    """All words of the blocks of a group, in block order, as one array."""
    in_order = F.array_sort(F.collect_list(F.struct("_block", F.array(*[f"_w{i}" for i in range(k)]).alias("w"))))
    return F.flatten(F.transform(in_order, lambda b: b["w"]))


def _bits_set(first: Column, words: Column, key_bits: list[Column]) -> Column:
    return reduce(Column.__and__, [F.getbit(F.get(words, (first + i).cast("int")), b) == F.lit(1) for i, b in enumerate(key_bits)])


def hashes(fpr: float) -> int:
    """The hash count for a rate; the rule's k = ln 2 * m / n, which does not depend on n but for m's rounding."""
    return size_for(1 << 20, fpr)[1]


def value(keys: DataFrame, key_col: str, k: int, m: int | None = None, fpr: float = 0.01) -> Column:
    """P14 as one value of the query: a struct of the number of blocks and the words.

    ``m`` bits; if not given, what P15 says for a sketch of the number of
    different keys, ``MAX_BITS`` at most. No job runs before the query does.
    """
    one = keys.sparkSession.range(1).select(F.lit(m).cast("long").alias("bits")) if m is not None else keys.agg(
        F.least(size_columns(F.approx_count_distinct(key_col, 0.02), fpr)[0], F.lit(MAX_BITS).cast("long")).alias("bits"))
    sized = one.select(F.ceil(F.col("bits") / (64 * k)).alias("blocks"))
    blocks = F.lit(-(-m // (64 * k))).cast("long") if m is not None else sized.scalar()
    return (_blocks(keys, key_col, blocks, k, sized).agg(F.struct(F.count(F.lit(1)).alias("blocks"), _words(k).alias("words"))).scalar())


def keep(df: DataFrame, key_col: str, filt: Column, k: int) -> DataFrame:
    """P13 on a ``value``: the rows of ``df`` whose key may be in it; a NULL key is not.

    The filter stands in the plan once, as an element of a one-element array
    that the test looks into, beside the key's two hashes.
    """
    key = F.col(key_col)
    hashes_ = [F.xxhash64(F.lit(i), key).alias(f"h{i}") for i in range(-(-k // _FIELDS))]
    tried = F.struct(F.col("_filter").alias("f"), F.xxhash64(key).alias("h"), *hashes_)

    def test(x: Column) -> Column:
        bits = [_field(x[f"h{i // _FIELDS}"], i) for i in range(k)]
        return _bits_set(F.pmod(x["h"], x["f"]["blocks"]) * k, x["f"]["words"], bits)

    held = df.filter(key.isNotNull()).select("*", filt.alias("_filter"))
    return held.filter(F.exists(F.array(tried), test)).select(*df.columns)


def _slice_blocks(m: int, k: int) -> tuple[int, Column]:
    parts, per = layout(m)
    return parts, F.lit(-(-per // (64 * k))).cast("long")


def build(keys: DataFrame, key_col: str, m: int, k: int) -> DataFrame:
    """P14 as a table: one row per slice, its words in one array. NULL keys are left out."""
    parts, blocks = _slice_blocks(m, k)
    sized = keys.sparkSession.range(1).select(blocks.alias("blocks"))
    return _blocks(keys, key_col, blocks, k, sized, parts).groupBy("_part").agg(_words(k).alias("_words"))


def might_contain(df: DataFrame, key_col: str, filt: DataFrame, m: int, k: int) -> DataFrame:
    """P13 on a table: keep the rows whose key may be in the filter (no false negatives).

    The key column must have the type the filter was built from: hashes of
    an int and of a bigint or string differ.
    """
    parts, blocks = _slice_blocks(m, k)
    tagged = df.filter(F.col(key_col).isNotNull()).select("*", _part(F.col(key_col), parts).alias("_part"))
    # The slice number in a struct: both sides are dealt for this join, so a hot key's slice can be split.
    slices = filt.withColumnRenamed("_part", "_slice")
    probe = tagged.join(slices, F.struct(F.col("_part").alias("p")) == F.struct(F.col("_slice").alias("p")), "inner")
    key = F.col(key_col)
    test = _bits_set(_block(key, blocks) * k, F.col("_words"), [_bit(key, i) for i in range(k)])
    return probe.filter(test).select(*df.columns)
