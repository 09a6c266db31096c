"""Operator 10, exact top-k search by inner product over an impact-ordered index.

Vectors are quantised to integers. Spark deals the rows out, once, in blocks of
a fixed size and sends the queries past every block; a task indexes a block
once, by posting segments, the rows whose component in one dimension lies in
one quantised level, and runs the queries that stream by, score at a time:

- segments in descending order of impact, the most that the query's weight
  makes of any value of the segment; each adds its exact contribution to its
  rows' accumulators;
- a row that has met s of d dimensions scores at most its accumulator plus
  d - s times the next impact. Processing stops only when all but a few rows
  are proven below the k-th best of the rows rescored so far;
- all rows that may still be members are rescored exactly.

The best k of the blocks of a query are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024     # whose results a task sends back together
LEVELS = 16          # quantised levels of a dimension
POSSIBLE = 0.09      # stop when this share of a block, or fewer rows, are possible members


class ImpactIndex:
    """Posting segments of an integer matrix, one row a vector."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n, d = x.shape
        low, high = x.min(axis=0), x.max(axis=0)
        level = (x - low) * LEVELS // (high - low + 1)
        self.rows, self.values, dims, least, most = [], [], [], [], []
        for j in range(d):
            order = np.argsort(level[:, j], kind="stable")
            cuts = np.searchsorted(level[order, j], np.arange(LEVELS + 1))
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    rows = order[a:b]
                    values = x[rows, j]
                    self.rows.append(rows)
                    self.values.append(values.astype(np.float64))
                    dims.append(j)
                    least.append(values.min())
                    most.append(values.max())
        self.sizes = np.array([len(r) for r in self.rows])
        self.dims, self.least, self.most = np.array(dims), np.array(least), np.array(most)

    def possible(self, q: np.ndarray, k: int) -> np.ndarray:
        """Rows that can be among the k best for ``q``, ties included; all others are proven not to be."""
        n, d = self.x.shape
        if n <= k or not d:
            return np.arange(n)
        weight = q[self.dims]
        impact = np.maximum(weight * self.least, weight * self.most)
        order = np.argsort(-impact, kind="stable")
        total, seen = np.zeros(n), np.zeros(n, np.int64)  # whole numbers, exact in double
        step = max(1, len(order) // 10)
        few = max(k, int(POSSIBLE * n))
        for i in range(0, len(order), step):
            # A run of segments is added up at once: a row may be in several.
            run = order[i:i + step]
            own = run.tolist()
            rows = np.concatenate([self.rows[s] for s in own])
            values = np.concatenate([self.values[s] for s in own])
            total += np.bincount(rows, values * np.repeat(weight[run], self.sizes[run]), n)
            seen += np.bincount(rows, minlength=n)
            if i + step >= len(order):
                break
            if 2 * (i + step) < len(order):  # too soon to prove much
                continue
            bound = total + (d - seen) * impact[order[i + step]]
            best = np.argpartition(-total, k - 1)[:k]
            left = np.flatnonzero(bound >= (self.x[best] @ q).min())
            if len(left) <= few:
                return left
        return np.flatnonzero(total >= np.partition(total, n - k)[n - k])


class Block:
    """A block of rows, indexed once for each length of vector in it."""

    def __init__(self, ids: list[int], vectors: list[list[int]]):
        lengths = np.array([len(v) for v in vectors])
        self.parts = {}
        for d in set(lengths.tolist()):
            own = np.flatnonzero(lengths == d)
            part = np.array([ids[i] for i in own], np.int64)
            index = ImpactIndex(np.array([vectors[i] for i in own], np.int64).reshape(len(own), d))
            self.parts[d] = part, index, int(np.unique(part, return_counts=True)[1].max())

    def best(self, qid: int, query: list[int], k: int) -> list[tuple[int, int, int]]:
        """(query, row, score) of the k best rows; only vectors of the query's length, not of its id."""
        if len(query) not in self.parts:
            return []
        ids, index, copies = self.parts[len(query)]
        q = np.array(query, np.int64)
        left = index.possible(q, k + copies)     # k more than those that the query's own id can take
        left = left[ids[left] != qid]
        scores = index.x[left] @ q
        return [(qid, int(ids[left[i]]), int(scores[i])) for i in np.lexsort((ids[left], -scores))[:k]]


def _searched(flow: DataFrame, k: int) -> DataFrame:
    """``(query_id, vec_id, score)``: the best k of each block for its queries; ``flow`` has (rb, side, id, v), rows (side 0) and queries (1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

        now, ids, vectors, block, found = None, [], [], None, []
        for batch in batches:
            for rb, side, own, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rb != now:
                    now, ids, vectors, block = rb, [], [], None
                if side == 0:
                    ids.append(own)
                    vectors.append(v)
                    continue
                block = block or Block(ids, vectors)   # the rows come first
                found += block.best(own, v, k)
                if len(found) >= BLOCK_QUERIES * k:
                    yield result(found)
                    found = []
        yield result(found)

    return flow.repartition("rb").sortWithinPartitions("rb", "side").mapInArrow(run, "query_id long, vec_id long, score long")


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as double; NULL unless all components are finite numbers."""
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(v, lambda x: F.floor(x * scale)))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows of every row where ``is_query`` holds.

    All rows that do not have the query's id are candidates (all of them are
    returned if they are fewer than k); ties go to the smaller id; a repeated
    query row is asked once, a repeated candidate row counts as often as it
    is there. Rows with a NULL id, or whose vector is NULL or holds NULL or
    non-finite components, take no part; vectors of different lengths are not
    compared (an empty vector scores 0 with another). Other columns are not
    read. Components are up to 2**52 / scale.
    """
    base = rows.select(rows[id_col].cast("long").alias("id"), quantised(rows[vector_col], scale).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
    base = base.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    asked = base.filter("asks").select("id", "v").distinct()
    row_blocks = -(-base.count() // BLOCK_ROWS) or 1
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long")))
    # Copies of one vector spread like any rows: blocks go by row, not by content.
    held = base.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(row_blocks)).alias("rb"), F.lit(0).alias("side"), "id", "v")
    met = _searched(held.unionByName(asked.select(every.alias("rb"), F.lit(1).alias("side"), "id", "v")), k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
