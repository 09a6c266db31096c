"""Operator 5, quality classifier: naive Bayes support vectors over n-gram indicators.

A document is a sequence of word symbols (a very long word is several): its shape (runs of lower
case, capitals and digits collapsed, other characters kept) and whether the
word, or the pair of it and the word before, repeats. The indicators of a
document are its symbol n-grams of one to three, each at every level of its
share of the document, hashed to a fixed number of columns. On a bounded
sample of labelled documents every indicator gets the class log-count ratio
of naive Bayes; rows scaled by it train a linear hinge-loss model by dual
coordinate descent, and cross-fitted margins calibrate the score. Only the
weights, a fixed-size array, go to the tasks that score every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import distinct_pieces, gather_ranges, slices, tidied, words
from quern.llm.learn import Rows, calibrate, dual_coordinate_descent, fold, labelled, sigmoid
from quern.operators.ranges import free_name

COLUMNS = 1 << 18
TRAIN_ROWS = 3000              # labelled documents of each class that training reads, at most
LEVELS = (0.0, 0.02, 0.1, 0.3)  # shares of a document's n-grams that have an indicator
COST = 1.0
SLICE_WORDS = 250_000          # words whose indicators a task holds at once (or one text's); bounds its memory
CHUNK_CHARS, CHUNK_SYMBOLS = 200, 12  # of a word that is one symbol; longer words are several
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class Model(NamedTuple):
    weights: np.ndarray   # of the indicators, the log-count ratios multiplied in
    bias: float
    slope: float
    offset: float


def shapes(word: str) -> list[tuple[str, str]]:
    """The word's consecutive chunks, each with its shape; words of ordinary length are one chunk.

    Lower-case, capital and digit runs are one a, A (AA if longer) or 9;
    other characters stay, at most two alike. A chunk has at most
    ``CHUNK_CHARS`` characters and ``CHUNK_SYMBOLS`` symbols of shape.
    """
    if len(word) <= CHUNK_CHARS and word.isalpha() and word.islower():
        return [(word, "a")]
    out = []
    for i in range(0, len(word), CHUNK_CHARS):
        part = word[i:i + CHUNK_CHARS]
        kinds = "".join("9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in part)
        start, symbols = 0, ""
        for m in re.finditer(r"(.)\1*", kinds, re.S):
            run = m[0] if len(m[0]) == 1 else "a" if m[1] == "a" else "9" if m[1] == "9" else m[1] * 2
            if len(symbols) + len(run) > CHUNK_SYMBOLS:
                out.append((part[start:m.start()], symbols))
                start, symbols = m.start(), ""
            symbols += run
        out.append((part[start:], symbols))
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[0]
    return h ^ (h >> np.uint64(29))


def _code(text: str) -> int:
    """A 64-bit hash that is the same in every process."""
    h = 1469598103934665603
    for b in text.encode("utf-8", "surrogatepass"):
        h = (h ^ b) * 1099511628211 % (1 << 64)
    return h


def _earlier(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the same value stands earlier in the same row."""
    order = np.lexsort((values, rows))  # stable: positions ascend among equals
    r, v = rows[order], values[order]
    out = np.zeros(len(rows), bool)
    out[order[1:]] = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    return out


def indicators(arr: pa.ListArray, codes: dict[str, int]) -> Rows:
    """The indicator columns of each row's words (values 1); ``codes`` remembers shapes."""
    distinct, index, bounds = distinct_pieces(arr)
    places: dict[str, int] = {}  # of the distinct chunks; the words' own come as they are met
    each, chunks, sizes = [], [], np.empty(len(distinct), np.int64)
    for i, w in enumerate(distinct.to_pylist()):
        parts = shapes(w)
        sizes[i] = len(parts)
        for content, s in parts:
            if content not in places:
                places[content] = len(places)
                if s not in codes:
                    codes[s] = _code(s)
                each.append(codes[s])
            chunks.append(places[content])
    if (n_words := len(index)):
        at = np.concatenate([[0], np.cumsum(sizes[index])])
        index = gather_ranges(np.array(chunks, np.int64), (np.cumsum(sizes) - sizes)[index], sizes[index])
        bounds = at[np.minimum(bounds, n_words)]
    each = np.array(each, np.uint64)
    rows = np.repeat(np.arange(len(arr)), np.diff(bounds))
    n = len(rows)
    same = np.zeros(n, np.uint64)
    if n > 1:
        inner = rows[1:] == rows[:-1]
        pair = index[:-1].astype(np.int64) * len(places) + index[1:]
        again = _earlier(rows[1:], np.where(inner, pair, -np.arange(1, n))) & inner
        same[1:][again] = 1
        same[1:][inner & (index[1:] == index[:-1])] = 2
    symbol = _mix((each[index] if n else np.zeros(0, np.uint64)) + same * _MIX[1])
    total = np.maximum(np.diff(bounds), 1)
    found = []  # row * COLUMNS + column, each once, one order and level at a time
    gram = symbol
    for k in range(3):
        if k:
            gram = _mix(gram[:-1] * _MIX[2] + symbol[k:])
        own = rows[:n - k] if k else rows
        inside = own == rows[k:] if k else np.ones(n, bool)
        key, row = gram[inside] ^ np.uint64(k), own[inside]
        order = np.lexsort((key, row))
        key, row = key[order], row[order]
        start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])])) if len(key) else np.zeros(0, int)
        count = np.diff(np.concatenate([start, [len(key)]]))
        key, row = key[start], row[start]
        share = count / total[row]
        for level, least in enumerate(LEVELS):
            hit = share >= least if level else slice(None)
            column = (_mix(key[hit] + np.uint64(level)) % np.uint64(COLUMNS)).astype(np.int64)
            found.append(np.unique(row[hit] * COLUMNS + column))
    flat = np.unique(np.concatenate(found))
    row, column = flat // COLUMNS, (flat % COLUMNS).astype(np.int32)
    return Rows(np.searchsorted(row, np.arange(len(arr) + 1)), column, np.ones(len(column), np.float32))


def _scaled(x: Rows, ratio: np.ndarray) -> tuple[Rows, np.ndarray]:
    """Rows times the log-count ratios at unit length, with a last column of ones for the bias."""
    values = ratio[x.columns] * x.values
    run = np.concatenate([[0.0], np.cumsum(values.astype(np.float64) ** 2)])
    norm = np.sqrt(np.maximum(run[x.bounds[1:]] - run[x.bounds[:-1]], 1e-12))
    size = np.diff(x.bounds)
    ends = x.bounds[1:]
    return Rows(x.bounds + np.arange(len(x.bounds)), np.insert(x.columns, ends, COLUMNS),
                np.insert(values / np.repeat(norm, size), ends, 1.0)), norm


def train(x: Rows, y: np.ndarray, cost: float = COST) -> Model:
    """The model of rows ``x`` with labels ``y`` (0 or 1); with one class or none, the smoothed share of ones."""
    n, ones = len(y), int(y.sum())
    if ones in (0, n):
        share = (ones + 1) / (n + 2)
        return Model(np.zeros(COLUMNS), 0.0, 1.0, float(np.log(share / (1 - share))))
    sign = np.where(y > 0, 1.0, -1.0)

    def fit(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, label = x.take(which), sign[which]
        row = np.repeat(np.arange(len(which)), np.diff(own.bounds))
        counts = [np.bincount(own.columns[label[row] == s], minlength=COLUMNS) + 1.0 for s in (1, -1)]
        ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
        scaled, _ = _scaled(own, ratio)
        balance = np.where(label > 0, 0.5 / max(1, (label > 0).sum()), 0.5 / max(1, (label < 0).sum())) * len(which)
        return ratio, dual_coordinate_descent(scaled, label, COLUMNS + 1, cost * balance)

    half = np.arange(n) % 2
    if min(len(set(y[half == h])) for h in (0, 1)) == 2:
        margin = np.empty(n)
        for h in (0, 1):
            ratio, w = fit(np.flatnonzero(half != h))
            margin[half == h] = _scaled(x.take(np.flatnonzero(half == h)), ratio)[0].dot(w)
    else:
        ratio, w = fit(np.arange(n))
        margin = _scaled(x, ratio)[0].dot(w)
    slope, offset = calibrate(margin, y)
    ratio, w = fit(np.arange(n))
    return Model(np.stack([ratio, w[:-1]]), float(w[-1]), slope, offset)


def score(x: Rows, model: Model) -> np.ndarray:
    if model.weights.ndim == 1:
        return sigmoid(np.full(len(x.bounds) - 1, model.offset))
    ratio, w = model.weights
    values = ratio[x.columns] * x.values
    unit = Rows(x.bounds, x.columns, values)
    norm = np.sqrt(np.maximum(Rows(x.bounds, x.columns, values ** 2).dot(np.ones(COLUMNS)), 1e-12))
    return sigmoid(model.slope * (unit.dot(w) / norm + model.bias) + model.offset)


def train_on(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 3, held_out: int = 1,
             id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_ROWS) -> Model:
    """The model of the labelled documents, without those whose id's crc32 modulo ``folds`` is ``held_out``.

    Training reads up to ``limit`` documents of each class, chosen by a hash
    of the id.
    """
    sample = F.broadcast(labelled(labels.select(id_col, label_col), label_col, fold(id_col, folds) == held_out, limit, id_col))
    rows = (docs.select(id_col, text_col).join(sample, id_col)
            .select(F.col("y"), F.xxhash64(id_col, text_col).alias("_order"), words(text_col).alias("_words")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        for batch in slices(batches, "_words", SLICE_WORDS):
            x = indicators(batch.column(2), codes)
            own = [x.columns[a:b] for a, b in zip(x.bounds, x.bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32()))],
                                             names=["y", "_order", "columns"])

    got = sorted(rows.mapInArrow(tidied(run), "y int, _order long, columns array<int>").collect(), key=lambda r: (r["_order"], r["y"]))
    own = [np.array(r["columns"], np.int32) for r in got]
    bounds = np.concatenate([[0], np.cumsum([len(o) for o in own], dtype=np.int64)])
    columns = np.concatenate(own) if own else np.zeros(0, np.int32)
    return train(Rows(bounds, columns, np.ones(len(columns), np.float32)), np.array([r["y"] for r in got], int))


def with_score(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows kept, with the score of each whole text in column ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    names, cut = schema.names, free_name("_quality_words", *schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        for batch in slices(batches, cut, SLICE_WORDS):
            if len(codes) > 100_000:
                codes.clear()
            last = batch.num_columns - 1
            scores = score(indicators(batch.column(last), codes), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(scores)], names=names)

    return docs.withColumn(cut, words(text_col)).mapInArrow(tidied(run), schema)


def classify(docs: DataFrame, model: Model, folds: int = 3, held_out: int = 1, threshold: float = 0.5,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score`` in [0, 1], ``predicted`` (1 from ``threshold`` on).

    NULL and empty texts have no indicators and get the score of the bias; a
    row with a NULL id is not held out; repeated rows get equal scores. Labels
    and columns other than the text never enter a score. Without labelled
    documents of both classes every score is the smoothed share of ones.
    """
    scored = with_score(docs.select(docs[id_col], docs[text_col]), model, "score", text_col)
    return scored.select(F.col(id_col), F.coalesce(fold(id_col, folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
