"""Operator 3, embedding near-duplicates through a pivot-permutation index.

Equal vectors of a label are first put together (a partial aggregate, so a
vector that holds a third of the rows is one row). Each different vector is
described by its nearest reference points in order: the first ``near`` of
the pivots, a bounded sample of the vectors. Vectors a small angle apart
order their nearest pivots alike; so the inverted lists are keyed by label
and by each two of a vector's near pivots, a pair is met in a list only once
(at the smallest such key that both have), pairs with fewer than ``shared``
pivots in common are dropped, and the rest are verified by their cosine in
double precision. The number of pivots grows with the square root of the
number of vectors, so the lists (a square of pivots of them) keep their length.

No two pivots are within the link angle, so a large group of different near
copies holds one or a few of them, not its share, and the order of the others
still tells its members apart from the rest. Vectors close to a pivot are in
a list of that pivot alone too, where all pairs are verified, whatever other
pivots they share: block by block inside tasks, by products of matrices, from
which only each vector's count of links and a star of links for what hangs
together come back. So a group of near copies makes no row for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import checkpointed
from quern.llm.graph import components
from quern.llm.icws import stars as stars_of

MIN_COSINE = 0.93
NEAR, NEAR_PIVOTS = 8, 512       # pivots that describe a vector, one more for each doubling of this many pivots
SHARED = 3
CLOSE = 0.75     # cosine with a pivot from which a vector is compared with all others so close to it
MIN_PIVOTS, MAX_PIVOTS = 96, 16_384
BLOCK = 1024     # vectors of a close list that are compared in one task with as many others


def usable(vector: str) -> Column:
    """True for a vector of finite numbers that is not zero."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def largest(vector: str) -> Column:
    """The greatest size of a component, in double precision."""
    return F.array_max(F.transform(F.col(vector), lambda x: F.abs(x.cast("double"))))


def cosine(a: str, b: str, largest_a: str, largest_b: str) -> Column:
    """Cosine of two vectors of equal length, not zero, in double precision; each is divided by its largest component first."""
    def dot(x: str, by_x: str, y: str, by_y: str) -> Column:
        products = F.zip_with(F.col(x), F.col(y), lambda p, q: (p.cast("double") / F.col(by_x)) * (q.cast("double") / F.col(by_y)))
        return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)

    own = [F.sqrt(dot(x, by, x, by)) for x, by in ((a, largest_a), (b, largest_b))]
    return dot(a, largest_a, b, largest_b) / (own[0] * own[1])


def pivot_count(n: int) -> int:
    return min(MAX_PIVOTS, max(MIN_PIVOTS, 2 * math.isqrt(max(n, 0))))


def near_count(pivots: int) -> int:
    """Pivots that describe a vector: more of them where there are more to choose from, so that near vectors share enough."""
    return NEAR + max(0, math.ceil(math.log2(max(1, pivots) / NEAR_PIVOTS)))


def thinned(points: np.ndarray, count: int, max_cosine: float) -> np.ndarray:
    """The first ``count`` of the unit vectors ``points`` that are all less than ``max_cosine`` alike."""
    kept = np.zeros((min(count, len(points)), points.shape[1]))
    n = 0
    for p in points:
        if n == len(kept):
            break
        if not n or (kept[:n] @ p).max() < max_cosine:
            kept[n] = p
            n += 1
    return kept[:n]


def with_pivots(vectors: DataFrame, pivots: np.ndarray, near: int) -> DataFrame:
    """``vectors`` (node, label, vector) with ``order``, the ``near`` pivots of greatest cosine, nearest first,
    and ``close``, those of them with a cosine of at least ``CLOSE``.

    Vectors of another length than the pivots get the pivots 0, 1, ... and
    are told apart by their length at verification.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                rows = part.column(2).to_pylist()
                order = np.tile(np.arange(near, dtype=np.int16), (len(rows), 1))
                close: list[np.ndarray] = [order[0][:0]] * len(rows)
                fit = [i for i, r in enumerate(rows) if len(r) == points.shape[1]]
                if fit:
                    x = np.array([rows[i] for i in fit], np.float64)
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    sims = x @ points.T
                    best = np.argpartition(-sims, near - 1, axis=1)[:, :near]
                    rank = np.argsort(-np.take_along_axis(sims, best, 1), axis=1, kind="stable")
                    order[fit] = np.take_along_axis(best, rank, 1)
                    n_close = (np.take_along_axis(sims, best, 1) >= CLOSE).sum(axis=1)
                    for i, k in zip(fit, n_close.tolist(), strict=True):
                        close[i] = order[i][:k]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(list(c), pa.list_(pa.int16())) for c in (order, close))],
                    names=["node", "label", "order", "close"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select("node", "label", "vector").mapInArrow(run, f"node long, label {label}, order array<smallint>, close array<smallint>")


def candidates(described: DataFrame, shared: int) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of one label that have ``shared`` pivots in common and no close one, each pair once."""
    sets = described.select("node", "label", F.array_sort("order").alias("near"), F.array_sort("close").alias("close"))
    two = F.flatten(F.transform("near", lambda p: F.transform(
        F.filter("near", lambda q: q > p), lambda q: p.cast("int") * 32768 + q)))
    lists = sets.withColumn("key", F.explode(two))
    left = lists.select("label", "key", F.col("node").alias("a"), F.col("near").alias("near_a"), F.col("close").alias("close_a"))
    right = lists.select("label", "key", F.col("node").alias("b"), F.col("near").alias("near_b"), F.col("close").alias("close_b"))
    pairs = left.join(right, ["label", "key"]).filter("a < b")
    common = F.array_intersect("near_a", "near_b")  # in near_a's order, ascending
    smallest = F.element_at(common, 1).cast("int") * 32768 + F.element_at(common, 2)
    met = ~F.arrays_overlap("close_a", "close_b") & (F.size(common) >= max(2, shared)) & (F.col("key") == smallest)
    return pairs.filter(met).select("a", "b")


def first_shared(close: list[list[int]]) -> np.ndarray:
    """``[i, j]``: the smallest number that the lists i and j have in common (none: a large one)."""
    out = np.full((len(close), len(close)), 1 << 20, np.int32)
    for p in sorted({p for own in close for p in own}, reverse=True):
        has = np.array([p in own for own in close])
        out[np.ix_(has, has)] = p
    return out


def close_links(described: DataFrame, nodes: DataFrame, min_cosine: float) -> tuple[DataFrame, DataFrame]:
    """Of all vectors close to one pivot: ``(node, others)``, parts of each one's count of linked vectors, and
    links ``(a, b)`` that connect what is linked.

    A pair is counted in the list of the smallest pivot both are close to. A
    list is cut into blocks, and every two of its blocks meet in one task.
    """
    lists = described.select("node", "label", "close", F.explode("close").alias("pivot"))
    sizes = lists.groupBy("label", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("_n"))
    dealt = (lists.join(sizes.filter("_n > 1").drop("_n"), ["label", "pivot"])
             .withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")))
    # A block meets itself and every other one: the group of blocks (i, j), i <= j.
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.concat_ws(":", F.hash("label"), F.xxhash64("label"), "pivot", F.least("block", "other"), F.greatest("block", "other"))
    members = other.select(group.alias("group"), "pivot", "node", "close", F.col("block").alias("side"))
    rows = (members.join(nodes.select("node", "vector", "n"), "node").select("group", "pivot", "node", "close", "side", "vector", "n")
            .repartition("group").sortWithinPartitions("group"))

    def compared(rows: list[tuple]) -> tuple[list[int], np.ndarray, list[tuple[int, int]]]:
        pivot = rows[0][1]
        nodes, side, n = [r[2] for r in rows], np.array([r[4] for r in rows]), np.array([r[6] for r in rows], np.int64)
        width = np.array([len(r[5]) for r in rows])
        patterns: dict[tuple, int] = {}
        of = np.array([patterns.setdefault(tuple(r[3]), len(patterns)) for r in rows])
        here = first_shared([list(p) for p in patterns]) == pivot
        others, stars = np.zeros(len(rows), np.int64), []
        for w in np.unique(width):
            own = np.flatnonzero(width == w)
            x = np.array([rows[i][5] for i in own], np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            linked = x @ x.T >= min_cosine
            np.fill_diagonal(linked, False)
            counted = linked & here[np.ix_(of[own], of[own])]
            if len(set(side.tolist())) > 1:           # two blocks: only pairs of one with the other
                counted &= side[own][:, None] != side[own][None, :]
            others[own] += counted @ n[own]
            stars += [(nodes[own[a]], nodes[own[b]]) for a, b in stars_of(linked)]
        return nodes, others, stars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(rows: list[tuple]) -> pa.RecordBatch:
            nodes, others, stars = compared(rows) if len(rows) > 1 else ([], np.zeros(0, np.int64), [])
            none = [None] * len(stars)
            return pa.RecordBatch.from_arrays(
                [pa.array([*nodes, *none], pa.int64()), pa.array([*others.tolist(), *none], pa.int64()),
                 pa.array([None] * len(nodes) + [a for a, _ in stars], pa.int64()),
                 pa.array([None] * len(nodes) + [b for _, b in stars], pa.int64())], names=["node", "others", "a", "b"])

        now: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now and row[0] != now[0][0]:
                    yield result(now)
                    now = []
                now.append(row)
        yield result(now)

    found = checkpointed(rows.mapInArrow(run, "node long, others long, a long, b long"))
    return found.filter("others > 0").select("node", "others"), found.filter("a IS NOT NULL").select("a", "b")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = MIN_COSINE, near: int | None = None, shared: int = SHARED) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id``, ``kept``.

    Links join rows of an equal, not NULL label with a cosine of at least
    ``min_cosine``. A vector that is NULL, empty or zero or holds a NULL or
    non-finite component links with nothing (its own component), as does a
    row with a NULL label; vectors of different lengths never link. Repeated
    rows are rows that link with each other. ``component_id`` is the smallest
    id of the component (NULL ids count only if there is no other) and
    ``kept`` says whether it is the row's own (NULL equals NULL). Other
    columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    base = rows.select(rows[id_col].alias("id"), rows[vector_col].alias("vector"), rows[label_col].alias("label"))
    base = base.withColumn("ok", usable("vector") & F.col("label").isNotNull())
    good = base.filter("ok")
    # NaN and -0.0 are gone or normalised by grouping, so equal groups are equal vectors.
    distinct = good.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least_id"))
    nodes = checkpointed(distinct.withColumn("node", F.monotonically_increasing_id()).withColumn("largest", largest("vector")))
    n = nodes.count()
    # The pivots: of a bounded sample, spread over all vectors by a hash, those that are not within the link angle of one
    # before. Four times as many vectors are read, so that a group of most of them does not take the place of the others.
    pool = 4 * pivot_count(n)
    spread = F.pmod(F.xxhash64("vector"), F.lit(1 << 30))
    near_all = nodes.filter(spread <= int((1 << 30) * min(1.0, 2 * pool / max(n, 1))))
    sample = near_all.orderBy(spread, "node").limit(pool).select("vector").collect()
    widths = [len(r["vector"]) for r in sample]
    width = max(set(widths), key=widths.count, default=1)
    points = np.array([r["vector"] for r in sample if len(r["vector"]) == width], np.float64).reshape(-1, width)
    points /= np.maximum(np.abs(points).max(axis=1, keepdims=True), 1e-300)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points = thinned(points, pivot_count(n), min_cosine)
    near = min(near or near_count(len(points)), len(points))
    close = None
    if n and near >= 2:
        described = checkpointed(with_pivots(nodes, points, near))
        pairs = candidates(described, min(shared, near))
        close = close_links(described, nodes, min_cosine)
    elif n:  # one or two different vectors: too few to describe by pivots
        pairs = (nodes.alias("x").join(nodes.alias("y"), "label").filter("x.node < y.node AND size(x.vector) = size(y.vector)")
                 .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    else:
        pairs = spark.createDataFrame([], "a long, b long")
    one = nodes.select(F.col("node").alias("a"), F.col("vector").alias("u"), F.col("largest").alias("m"))
    two = nodes.select(F.col("node").alias("b"), F.col("vector").alias("v"), F.col("largest").alias("w"))
    met = pairs.join(one, "a").join(two, "b").filter(F.size("u") == F.size("v"))
    links = checkpointed(met.filter(cosine("u", "v", "m", "w") >= min_cosine).select("a", "b"))

    weights = nodes.select(F.col("node").alias("b"), "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    if close:
        others = others.unionByName(close[0]).groupBy("node").agg(F.sum("others").alias("others"))
        links = links.unionByName(close[1])
    roots = components(links, "a", "b")
    least = (roots.join(nodes.select("node", "least_id"), "node").groupBy("root")
             .agg(F.min("least_id").alias("component_id")))
    found = (nodes.join(roots, "node", "left").join(least, "root", "left").join(others, "node", "left")
             .select("label", "vector",
                     (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component_id", "least_id").alias("component_id")))
    found = checkpointed(found.withColumn("h", F.xxhash64("label", "vector")))
    own = good.withColumn("h", F.xxhash64("label", "vector"))
    linked = own.join(found, ["h", "label", "vector"]).select("id", "n_links", "component_id")
    alone = base.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
