"""Operator 7, best-fit packing: documents into as few fixed-size token sequences as possible.

Every document becomes its token ids and a closing id; one longer than a
sequence is cut into full pieces behind a shorter first piece. Packing then
only needs the number of pieces of each length, a table of at most
``capacity`` rows however large the corpus is:

- large items (over a third of the capacity) are matched greedily, the
  largest left with the largest that still fits beside it, two to a bin;
- smaller items, longest first, go where the remaining gap is tightest, and
  open a new bin only where no gap is left for them.

Items of one length are interchangeable, so each step places a whole count
at once and the plan is a short list of slots: "the pieces of length l with
ranks r0.. go into the bins from b0 on, q to a bin, from offset o". Spark
ranks the pieces within their length (a count per partition, summed over
partitions) and looks the slots up by length and rank. No task ever holds
the pieces of a length, and only the length table reaches the driver.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import byte_symbols, checkpointed, distinct_pieces, gather_ranges, row_sums, slices, tidied, token_pieces
from quern.operators.ranges import free_name

CAPACITY = 2048
CLOSING_ID = 0
MEMORY_PIECES = 250_000   # distinct pieces whose ids a task remembers; bounds its memory


def added_token_ids(tokenizer_json: str) -> dict[str, int]:
    """The tokenizer's added tokens, which its encoding cuts out of a text before all else, with their ids."""
    found = json.loads(tokenizer_json)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in found):
        raise ValueError("added tokens that take blanks with them, or are whole words only, are not supported")
    return {t["content"]: t["id"] for t in found}


def pieces_with_added(text: Column, added: dict[str, int]) -> Column:
    """``token_pieces`` of what stands between the added tokens of a text, and these tokens as pieces, in order."""
    if not added:
        return token_pieces(text)
    # Java's quoting; of tokens that begin alike the longest.
    any_token = "|".join(r"\Q" + t.replace(r"\E", r"\E\\E\Q") + r"\E" for t in sorted(added, key=lambda t: (-len(t), t)))
    text = F.coalesce(text, F.lit(""))
    met = F.regexp_extract_all(text, F.lit(any_token), F.lit(0))
    between = F.transform(F.split(text, any_token, -1), lambda part, i: F.concat(token_pieces(part), F.slice(met, i + 1, 1)))
    some = reduce(Column.__or__, [text.contains(t) for t in added])
    return F.when(some, F.flatten(between)).otherwise(token_pieces(text))


def token_id_pieces(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID,
                    id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` for each piece of each document.

    The tokenizer works within the pattern's pieces, so encoding each
    distinct piece of a batch once gives the ids of every whole text. With
    ``added_tokens`` the tokenizer's added tokens in a text get their own ids,
    as its ``encode`` does; without, they are text like any other.
    """
    added = added_token_ids(tokenizer_json) if added_tokens else {}
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        # The pieces are cut as the tokenizer's own byte-level step cuts them; its
        # model takes them in that step's symbols.
        model = Tokenizer.from_str(spec.value).model
        symbols = byte_symbols()
        known: dict[str, int] = {}
        flat, size = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        for batch in slices(batches, "_pieces"):
            distinct, index, bounds = distinct_pieces(batch.column(1))
            strings = distinct.to_pylist()
            if len(known) > MEMORY_PIECES:
                known, flat, size = {}, flat[:0], size[:0]
            new = [w for w in strings if w not in known]
            coded = [[added[w]] if w in added else [t.id for t in model.tokenize(w.encode().decode("latin-1").translate(symbols))]
                     for w in new]
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            size = np.append(size, np.fromiter(map(len, coded), np.int64, len(coded)))
            flat = np.append(flat, np.fromiter(chain.from_iterable(coded), "<u4"))
            index = np.fromiter(map(known.__getitem__, strings), np.int64, len(strings))[index]
            first = np.cumsum(size) - size
            n_tokens = row_sums(size[index], bounds)
            ids = gather_ranges(flat, first[index], size[index]).astype("<u4")
            at, rows = 0, ([], [], [], [], [])
            for i, n in enumerate(n_tokens.tolist()):
                own = np.append(ids[at:at + n], np.array([closing_id], "<u4"))
                at += n
                n += 1
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for col, v in zip(rows, (i, k, a, b - a, zlib.crc32(own[a:b].tobytes())), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in rows[2:])],
                names=[id_col, "piece", "start", "length", "ids_crc32"])

    cut = docs.select(docs[id_col], pieces_with_added(docs[text_col], added).alias("_pieces"))
    return cut.mapInArrow(
        tidied(run), f"`{id_col}` {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long")


class Slots(NamedTuple):
    """Pieces of ``length`` with ranks ``rank`` .. ``rank + count - 1``: ``per_bin`` to each bin from ``bin`` on, from ``offset``."""
    length: int
    rank: int
    count: int
    bin: int
    per_bin: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slots], int]:
    """Slots for ``counts`` items of each length, and the number of bins they take."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("lengths must be between 1 and the capacity")
    used = dict.fromkeys(left, 0)
    slots: list[Slots] = []
    gaps: list[int] = []                       # sorted distinct gaps with open bins
    bins: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first bin, number of bins)]
    n_bins = 0

    def put(length: int, count: int, at: int, per_bin: int, offset: int) -> None:
        slots.append(Slots(length, used[length], count, at, per_bin, offset))
        used[length] += count
        left[length] -= count

    def leave(gap: int, at: int, n: int) -> None:
        if gap > 0 and n > 0:
            if gap not in bins:
                insort(gaps, gap)
            bins.setdefault(gap, []).append((at, n))

    large = sorted(n for n in left if 3 * n > capacity)
    for a in reversed(large):
        while left[a]:
            b = next((b for b in reversed(large[:bisect_left(large, capacity - a + 1)])
                      if left[b] > (a == b)), None)
            n = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
            put(a, n, n_bins, 1, 0)
            if b is not None:
                put(b, n, n_bins, 1, a)
            leave(capacity - a - (b or 0), n_bins, n)
            n_bins += n
    for a in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[a]:
            k = bisect_left(gaps, a)
            if k == len(gaps):                 # no gap is left: as many new bins as these items fill
                fresh = -(-left[a] // (capacity // a))
                leave(capacity, n_bins, fresh)
                n_bins += fresh
                continue
            gap = gaps[k]
            at, n = bins[gap].pop()
            if not bins[gap]:
                del bins[gap]
                gaps.pop(k)
            each = gap // a                    # the tightest gap stays the tightest until it is full
            full = min(n, left[a] // each)
            if full:
                put(a, full * each, at, each, capacity - gap)
                leave(gap - each * a, at, full)
            rest = min(left[a], each) if full < n else 0
            if rest:
                put(a, rest, at + full, each, capacity - gap)
                leave(gap - rest * a, at + full, 1)
                full += 1
            leave(gap, at + full, n - full)
    return slots, n_bins


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: no sequence over ``capacity``, none with a hole.

    Needs a ``length`` column between 1 and ``capacity``. Pieces are ranked by
    the part they were written in, whose number the table written here holds.
    """
    names = pieces.columns
    part = free_name("_part", *names)
    pieces = checkpointed(pieces.withColumn(part, F.spark_partition_id()))
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, _ = plan(counts, capacity)
    # At most a few slots for each of ``capacity`` lengths, whatever the corpus.
    table = F.broadcast(spark.createDataFrame(
        slots or [Slots(0, 0, 0, 0, 1, 0)],
        "_length long, _rank long, _count long, _bin long, _per_bin long, _offset long"))
    in_part = Window.partitionBy(part, "length").orderBy(*names)
    before = (pieces.groupBy(part, "length").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(
                  Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)))
              .select(part, "length", F.coalesce("_before", F.lit(0)).alias("_before")))
    ranked = (pieces.withColumn("_in", F.row_number().over(in_part) - 1)
              .join(before, [part, "length"])
              .withColumn("_r", F.col("_before") + F.col("_in")))
    placed = ranked.join(table, (F.col("length") == F.col("_length")) & (F.col("_r") >= F.col("_rank"))
                         & (F.col("_r") < F.col("_rank") + F.col("_count")))
    k = F.col("_r") - F.col("_rank")
    return placed.select(
        *[F.col(c) for c in names],
        (F.col("_bin") + F.floor(k / F.col("_per_bin"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (k % F.col("_per_bin")) * F.col("length")).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID,
         id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A NULL or empty text is its closing id alone (one piece of length 1).
    Repeated rows and repeated or NULL ids are packed row by row; ties between
    equal lengths are broken by partition, then by the row's columns; an empty table gives no rows;
    other columns are not read. ``capacity`` must be positive. With
    ``added_tokens`` the tokenizer's added tokens in a text get their own ids.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    return assign(token_id_pieces(docs, tokenizer_json, capacity, closing_id, id_col, text_col, added_tokens), capacity)
