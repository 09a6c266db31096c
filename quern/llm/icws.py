"""Operator 9, MinHash near-duplicates by improved consistent weighted sampling.

A text is a weighted set: its five-word shingles, weighted by (1 + log of
their count in the text) times a smoothed inverse document frequency, taken
over all documents for each of a fixed number of hash buckets (hashed
TF-IDF), so the frequency table keeps its size. Consistent weighted sampling
draws from each set one shingle and level a hash function, equal for two
sets with the probability of their weighted Jaccard similarity; bands of
samples make bucket keys, and texts that meet in a bucket are verified by
the exact weighted Jaccard similarity of their sets.

Equal texts are one node from the start. The nodes of a bucket are compared
inside a task, all with all, by products of shingle matrices; only a star of
links for each component found leaves it, so a group of copies is not expanded
into its pairs and no text is shuffled once for each pair. A bucket of more
than a block's nodes is cut into blocks, all of which also get a few leaders of
the bucket. After that, a bucket's largest component need not meet itself, and
only the nodes outside it are compared with the other blocks. So the classes
are those of comparing all pairs of each bucket. Components of the links are
the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import checkpointed, tidied, words
from quern.llm.graph import components
from quern.operators.ranges import free_name

WORDS = 5
MIN_SIMILARITY = 0.8
BANDS, BAND_SAMPLES = 10, 3
FREQUENCY_BUCKETS = 1 << 18
SMOOTHING = 3.0      # added to the idf, which lies between 0 and 1
BLOCK_NODES, BLOCK_SHINGLES = 2048, 4_000_000    # of a bucket, compared in one task
LEADERS = 8          # nodes of a bucket of several blocks that are in all of them
FEW = 64          # nodes of a bucket up to which equal buckets of several bands are found and compared once
_CELLS = 4_000_000   # of a matrix held at once
_TABLE = 1 << 16
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Sets(NamedTuple):
    """Row i has the shingles ``ids[bounds[i]:bounds[i + 1]]``, ascending, each ``counts`` times."""
    ids: np.ndarray
    counts: np.ndarray
    bounds: np.ndarray


def word_hashes(text: str | Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingles(arr: pa.ListArray) -> Sets:
    """The 32-bit shingle sets of rows of word hashes; one to four words make one shingle."""
    lengths = np.diff(arr.offsets.to_numpy()) if arr.null_count == 0 else arr.value_lengths().fill_null(0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    n_rows = len(lengths)
    # Rows of fewer words are filled up with zeros to one shingle.
    short = np.flatnonzero((lengths > 0) & (lengths < WORDS))
    if len(short):
        fill = WORDS - lengths[short]
        flat = np.insert(flat, np.repeat(ends[short + 1], fill), np.uint64(0))
        lengths = lengths.copy()
        lengths[short] = WORDS
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    n = max(0, len(flat) - WORDS + 1)
    h = np.zeros(n, np.uint64)
    for j in range(WORDS):
        h = (h ^ flat[j:j + n]) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    row = np.repeat(np.arange(n_rows, dtype=np.uint64), np.maximum(lengths - WORDS + 1, 0))
    first = np.repeat(ends[:-1] - np.concatenate([[0], np.cumsum(np.maximum(lengths - WORDS + 1, 0))[:-1]]),
                      np.maximum(lengths - WORDS + 1, 0)) + np.arange(len(row))
    key = np.sort((row << np.uint64(32)) | (h[first] >> np.uint64(32)))
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([start, [len(key)]]))
    key = key[start]
    bounds = np.searchsorted(key, np.arange(n_rows + 1, dtype=np.uint64) << np.uint64(32))
    return Sets((key & np.uint64(0xFFFFFFFF)).astype(np.uint32), counts.astype(np.int32), bounds)


def document_frequencies(hashed: DataFrame) -> np.ndarray:
    """Documents with a shingle in each hash bucket, over all rows of ``_words``; a table of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(FREQUENCY_BUCKETS, np.int64)
        for batch in slices_of_longs(batches):
            sets = shingles(batch.column(0))
            bucket = (sets.ids % FREQUENCY_BUCKETS).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(sets.bounds))
            counts += np.bincount(np.unique(row * FREQUENCY_BUCKETS + bucket) % FREQUENCY_BUCKETS, minlength=FREQUENCY_BUCKETS)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["bucket", "n"])

    found = (hashed.select("_words").mapInArrow(tidied(run), "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(FREQUENCY_BUCKETS, np.int64)
    out[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def slices_of_longs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Record batches cut to about 600,000 words (the last column), or one row."""
    for batch in batches:
        arr = batch.column(batch.num_columns - 1)
        at = np.concatenate([[0], np.cumsum(arr.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(at, at[start] + 600_000, side="right")) - 1
            stop = min(batch.num_rows, max(start + 1, stop))
            yield batch.slice(start, stop - start)
            start = stop


def idf_table(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    idf = np.log((n_docs + 1) / (frequencies + 1.0)) / np.log(n_docs + 2)
    return (SMOOTHING + np.maximum(idf, 0)).astype(np.float32)


def weights(sets: Sets, idf: np.ndarray) -> np.ndarray:
    w = idf[sets.ids % FREQUENCY_BUCKETS]
    many = sets.counts > 1
    w[many] *= 1 + np.log(sets.counts[many].astype(np.float32))
    return w


class Sampler:
    """Consistent weighted samples; the random numbers of a shingle come from a table it is hashed into."""

    def __init__(self, n: int, seed: int = 9):
        rnd = np.random.default_rng(seed)
        r, c = rnd.gamma(2.0, 1.0, _TABLE), rnd.gamma(2.0, 1.0, _TABLE)
        beta = rnd.uniform(0.0, 1.0, _TABLE)
        self.r, self.per_r, self.beta = (x.astype(np.float32) for x in (r, 1 / r, beta))
        self.base = (np.log(c) - r + r * beta).astype(np.float32)
        self.multiply = rnd.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sample(self, sets: Sets, w: np.ndarray) -> np.ndarray:
        """One 64-bit sample for each row and hash function (rows without shingles: 0)."""
        rows = np.flatnonzero(np.diff(sets.bounds))
        out = np.zeros((len(sets.bounds) - 1, len(self.multiply)), np.uint64)
        if not len(rows):
            return out
        starts, sizes = sets.bounds[rows], np.diff(sets.bounds)[rows]
        log_w = np.log(w)
        for k, m in enumerate(self.multiply):
            at = (sets.ids * m) >> np.uint32(16)
            t = np.floor(log_w * self.per_r[at] + self.beta[at])
            a = self.base[at] - self.r[at] * t
            least = np.repeat(np.minimum.reduceat(a, starts), sizes)
            hits = np.flatnonzero(a == least)
            first = hits[np.searchsorted(hits, starts)]  # of equal values the smallest shingle
            h = (sets.ids[first].astype(np.uint64) << np.uint64(20)) ^ (t[first].astype(np.int64).view(np.uint64) & np.uint64(0xFFFFF))
            h = (h + np.uint64(k + 1)) * _MULTIPLIER
            out[rows, k] = h ^ (h >> np.uint64(31))
        return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    h = np.zeros((len(samples), BANDS), np.uint64)
    for j in range(BAND_SAMPLES):
        h = (h ^ samples[:, j::BAND_SAMPLES]) * _MULTIPLIER
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _described(hashed: DataFrame, idf) -> DataFrame:
    """``(id, digest, bands)`` of each row; texts without words have no bands."""
    sampler = Sampler(BANDS * BAND_SAMPLES)
    id_type = hashed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_of_longs(batches):
            sets = shingles(batch.column(2))
            keys = band_keys(sampler.sample(sets, weights(sets, idf.value)))
            some = np.diff(sets.bounds) > 0
            bands = pa.array([k if s else None for k, s in zip(keys, some)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bands], names=["id", "digest", "bands"])

    return hashed.mapInArrow(tidied(run), f"id {id_type}, digest string, bands array<long>")


def _sets_of(hashed: DataFrame) -> DataFrame:
    """``(node, ids, counts, size)``: the shingle set of each row of ``(node, _words)``, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_of_longs(batches):
            sets = shingles(batch.column(1))
            cut = list(zip(sets.bounds, sets.bounds[1:]))
            counts = sets.counts.astype(np.uint16 if sets.counts.max(initial=0) < 1 << 16 else np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sets.ids[a:b].tobytes() for a, b in cut], pa.binary()),
                 pa.array([counts[a:b].tobytes() if (counts[a:b] > 1).any() else b"" for a, b in cut], pa.binary()),
                 pa.array([b - a for a, b in cut], pa.int64())], names=["node", "ids", "counts", "size"])

    return hashed.mapInArrow(tidied(run), "node long, ids binary, counts binary, size long")


def _counts(ids: np.ndarray, counts: bytes) -> np.ndarray:
    """The counts of a set's shingles from their bytes, of two or four each (none: all 1)."""
    return np.frombuffer(counts, f"u{len(counts) // len(ids)}").astype(np.uint32) if counts else np.ones(len(ids), np.uint32)


def similarity(a: tuple[bytes, bytes], b: tuple[bytes, bytes], idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of ``_sets_of``."""
    ids, w = [], []
    for own, count in (a, b):
        x = np.frombuffer(own, np.uint32)
        c = _counts(x, count)
        ids.append(x)
        w.append(weights(Sets(x, c, None), idf).astype(np.float64))
    at = np.searchsorted(ids[1], ids[0])
    at[at == len(ids[1])] = 0
    common = ids[1][at] == ids[0] if len(ids[1]) else np.zeros(len(ids[0]), bool)
    both = np.minimum(w[0][common], w[1][at[common]]).sum()
    total = w[0].sum() + w[1].sum() - both
    return float(both / total) if total else 0.0


def _columns(sets: list[tuple[bytes, bytes]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, column, worth, total)``: the sets as entries of a 0/1 matrix whose columns have a weight, and their sums.

    The least of two sets' weights of a shingle is the sum of its steps: a
    column for each count of it that occurs, worth what that count adds, and
    an entry in the columns up to a set's own count. Shingles of one set alone
    have no column.
    """
    ids = [np.frombuffer(x, np.uint32) for x, _ in sets]
    row = np.repeat(np.arange(len(sets)), [len(x) for x in ids])
    flat = np.concatenate(ids)
    count = np.concatenate([_counts(x, c) for x, (_, c) in zip(ids, sets, strict=True)])
    total = np.bincount(row, weights(Sets(flat, count, None), idf).astype(np.float64), minlength=len(sets))
    _, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    own = times[at] > 1
    row, flat, count = row[own], flat[own], count[own].astype(np.int64)
    key, column = np.unique(flat.astype(np.int64) << 32 | count, return_inverse=True)    # by shingle, then count
    new = np.concatenate([[True], key[1:] >> 32 != key[:-1] >> 32]) if len(key) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) if len(key) else np.zeros(0, np.int64)
    w = weights(Sets((key >> 32).astype(np.uint32), key & 0xFFFFFFFF, None), idf).astype(np.float64)
    worth = w - np.where(new, 0, np.concatenate([[0], w[:-1]])) if len(key) else w
    steps = column - first[column] + 1
    out = np.repeat(first[column], steps) + np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    return np.repeat(row, steps), out, worth, total


def _common(row: np.ndarray, column: np.ndarray, worth: np.ndarray, n: int) -> np.ndarray:
    """What every two of ``n`` rows have in common, as a matrix: common columns of many rows by products, of few by pairs."""
    order = np.lexsort((row, column))
    row, column = row[order], column[order]
    degree = np.bincount(column, minlength=len(worth))
    start = np.cumsum(degree) - degree
    out = np.zeros((n, n), np.float32)
    wide = np.flatnonzero(degree > max(2, n >> 4))
    step = max(1, _CELLS // n)
    for a in range(0, len(wide), step):
        some = wide[a:a + step]
        size = degree[some]
        entry = np.repeat(start[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cells = np.zeros((n, len(some)), np.float32)
        cells[row[entry], np.repeat(np.arange(len(some)), size)] = 1
        out += (cells * worth[some].astype(np.float32)) @ cells.T
    for d in np.unique(degree[(degree > 1) & (degree <= max(2, n >> 4))]):
        some = np.flatnonzero(degree == d)
        i, j = np.triu_indices(d, 1)
        step = max(1, _CELLS // len(i))
        for a in range(0, len(some), step):
            rows = row[start[some[a:a + step]][:, None] + np.arange(d)]
            # Sums of the pairs met, not a cell for every two rows.
            cell, of = np.unique(rows[:, i].ravel() * n + rows[:, j].ravel(), return_inverse=True)
            more = np.bincount(of, np.repeat(worth[some[a:a + step]], len(i)))
            out[cell // n, cell % n] += more
            out[cell % n, cell // n] += more
    return out


def alike_within(sets: list[tuple[bytes, bytes]], idf: np.ndarray, min_similarity: float) -> np.ndarray:
    """Matrix of which two sets of ``_sets_of`` have a weighted Jaccard similarity of at least ``min_similarity``."""
    row, column, worth, total = _columns(sets, idf)
    common = _common(row, column, worth, len(sets))
    rest = total[:, None] + total[None, :] - common
    value = np.divide(common, rest, out=np.zeros_like(rest), where=rest > 0)
    alike = value >= min_similarity
    # Single precision leaves those near the threshold open.
    for a, b in zip(*np.nonzero(np.triu(np.abs(value - min_similarity) < 1e-4, 1)), strict=True):
        alike[a, b] = alike[b, a] = similarity(sets[a], sets[b], idf) >= min_similarity - 1e-9
    return alike


def stars(alike: np.ndarray) -> list[tuple[int, int]]:
    """A star of links, (first, other), for every component of a symmetric matrix."""
    out, free = [], np.ones(len(alike), bool)
    for first in range(len(alike)):
        if not free[first]:
            continue
        free[first] = False
        edge = np.array([first])
        while len(edge):
            edge = np.flatnonzero(alike[edge].any(axis=0) & free)
            free[edge] = False
            out += [(first, int(e)) for e in edge]
    return out


def _linked(members: DataFrame, sets: DataFrame, idf, min_similarity: float) -> DataFrame:
    """Links (a, b) that connect what is alike among the nodes of each group of ``members`` (group, node).

    Repeated members count once. A group is held by one task, so its size must be bounded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(nodes: list[int], own: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
            found = stars(alike_within(own, idf.value, min_similarity)) if len(own) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[a] for a, _ in found], pa.int64()),
                                               pa.array([nodes[b] for _, b in found], pa.int64())], names=["a", "b"])

        now, nodes, own = None, [], []
        for batch in batches:
            for group, node, x, c in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if group != now:
                    if len(own) > 1:
                        yield links(nodes, own)
                    now, nodes, own = group, [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node)
                    own.append((x, c))
        yield links(nodes, own)

    met = members.join(sets.select("node", "ids", "counts"), "node").select("group", "node", "ids", "counts")
    return met.repartition("group").sortWithinPartitions("group", "node").mapInArrow(tidied(run), "a long, b long")


def _links(buckets: DataFrame, sets: DataFrame, idf, min_similarity: float) -> DataFrame:
    """Links (a, b) whose components are those of all alike pairs that meet in a bucket (band, key, node, n)."""
    few = (buckets.filter(F.col("n") <= FEW).groupBy("band", "key").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
           .select("nodes").distinct())
    small = few.select(F.md5(F.array_join(F.col("nodes").cast("array<string>"), ",")).alias("group"), F.explode("nodes").alias("node"))

    many = buckets.filter(F.col("n") > FEW).join(sets.select("node", "size"), "node")
    spread = [F.min_by("node", F.xxhash64("node", F.lit(i))).alias(f"_l{i}") for i in range(LEADERS)]
    shape = checkpointed(many.groupBy("band", "key").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"), *spread))
    dealt = checkpointed(many.drop("n").join(shape.select("band", "key", "blocks"), ["band", "key"])
                         .withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")))
    several = shape.filter("blocks > 1")
    leaders = several.select("band", "key", F.explode(F.array(*[f"_l{i}" for i in range(LEADERS)])).alias("node"),
                             F.sequence(F.lit(0), F.col("blocks") - 1).alias("b"))
    in_all = leaders.select("band", "key", "node", F.explode("b").alias("block"))
    large = (dealt.select("band", "key", "node", "block").unionByName(in_all)
             .select(F.concat_ws(":", "band", "key", "block").alias("group"), "node"))
    links = checkpointed(_linked(small.unionByName(large), sets, idf, min_similarity))
    if several.isEmpty():
        return links

    # The nodes outside a bucket's largest component, in chunks, meet the bucket's blocks.
    roots = components(links, "a", "b")
    own = checkpointed(dealt.filter("blocks > 1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    main = own.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("band", "key").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    outside = checkpointed(own.join(main, ["band", "key"]).filter("root <> main"))
    chunks = checkpointed(outside.groupBy("band", "key").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("chunks")))
    asked = (outside.join(chunks, ["band", "key"])
             .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int"))
             .select("band", "key", "node", "chunk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    held = (own.join(chunks, ["band", "key"])
            .select("band", "key", "node", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "block"))
    both = asked.unionByName(held).select(F.concat_ws(":", "band", "key", "block", "chunk").alias("group"), "node").distinct()
    return links.unionByName(checkpointed(_linked(both, sets, idf, min_similarity)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """Per row: id, ``class_id`` (the smallest id of its class) and ``kept`` (whether that is its own).

    Equal texts are in one class, as are texts linked by a weighted Jaccard
    similarity of at least ``min_similarity``, directly or through others. A
    NULL text links with nothing; a text without words only with equal
    texts; fewer than five words count as one shingle; texts of any length
    are read whole. Repeated rows are in one class. NULL ids count as the
    smallest only where a class has no other; ``kept`` compares NULL as equal.
    Other columns are not read; an empty table gives no rows.
    """
    classes = classes_of(docs, id_col, text_col, min_similarity)
    return classes.select(F.col("id").alias(id_col), F.col("class_id"),
                          F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def classes_of(docs: DataFrame, id_col: str, text_col: str, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``(id, digest, class_id, class_digest)`` of each row; the class's kept text has that id and digest."""
    context = docs.sparkSession.sparkContext
    base = docs.select(docs[id_col].alias("id"), F.md5(docs[text_col].cast("binary")).alias("digest"),
                       word_hashes(docs[text_col]).alias("_words"))
    frequencies = document_frequencies(base)
    n_docs = base.count()
    idf = context.broadcast(idf_table(frequencies, n_docs))
    described = checkpointed(_described(base, idf))

    # A node for each different text; its content is read from the row of least id.
    nodes = checkpointed(described.filter("digest IS NOT NULL").groupBy("digest")
                         .agg(F.min("id").alias("least_id"), F.first("bands").alias("bands"))
                         .withColumn("node", F.monotonically_increasing_id()))
    met = (nodes.filter("bands IS NOT NULL").select("node", F.posexplode("bands").alias("band", "key")))
    sizes = met.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = checkpointed(met.join(checkpointed(sizes), ["band", "key"]).select("band", "key", "node", "n"))
    # Texts are dealt out by digest and id, which no group of copies shares; repeated rows meet there.
    def place(digest: str, row_id: str) -> Column:
        return F.concat_ws(":", F.col(digest), F.col(row_id).cast("string")).alias("place")

    wanted = buckets.select("node").distinct().join(nodes, "node").select("node", place("digest", "least_id"))
    texts = docs.select(docs[id_col].alias("id"), F.md5(docs[text_col].cast("binary")).alias("digest"), docs[text_col].alias("_text"))
    content = (wanted.join(texts.select(place("digest", "id"), "_text"), "place").groupBy("place")
               .agg(F.first("node").alias("node"), F.first("_text").alias("_text")))
    sets = checkpointed(_sets_of(content.select("node", word_hashes("_text").alias("_words"))))

    links = _links(buckets, sets, idf, min_similarity)
    roots = components(links, "a", "b")
    own = nodes.select("node", "digest", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Of each class the least id, and of texts that share it the least digest; NULL ids come last.
    least = own.groupBy("root").agg(F.min(F.struct(F.col("least_id").isNull(), F.col("least_id"), F.col("digest"))).alias("k"))
    found = checkpointed(own.join(least, "root").select("digest", F.col("k.least_id").alias("class_id"), F.col("k.digest").alias("class_digest")))
    rows = described.select("id", "digest")
    with_text = rows.filter("digest IS NOT NULL").join(found, "digest")
    return with_text.select("id", "digest", "class_id", "class_digest").unionByName(
        rows.filter("digest IS NULL").select("id", "digest", F.col("id").alias("class_id"), F.col("digest").alias("class_digest")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``docs``, all columns, with one row of each class of near-duplicates: the one of least id.

    Of repeated rows one stays; rows with NULL texts all stay.
    """
    classes = checkpointed(classes_of(docs, id_col, text_col, min_similarity))
    id_name, digest_name = (free_name(n, *docs.columns) for n in ("_class_id", "_class_digest"))
    stay = (classes.filter("digest IS NOT NULL").select(F.col("class_id").alias(id_name), F.col("class_digest").alias(digest_name))
            .distinct())
    digest = F.md5(docs[text_col].cast("binary"))
    # The join's keys are the rows' own ids and texts, so no class is a hot key.
    own = docs.filter(docs[text_col].isNotNull())
    kept = own.join(stay, docs[id_col].eqNullSafe(F.col(id_name)) & (digest == F.col(digest_name)))
    names = [F.first(own[c]).alias(c) for c in docs.columns]
    one = kept.groupBy(id_name, digest_name).agg(*names).select(*docs.columns)
    return one.unionByName(docs.filter(docs[text_col].isNull()))
