"""Linear hinge-loss models for the classifiers: labelled samples, training, calibration."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rows(NamedTuple):
    """Sparse rows: row i has ``values[j]`` in column ``columns[j]`` for j in ``bounds[i]:bounds[i + 1]``."""
    bounds: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0.0], np.cumsum(w[self.columns] * self.values, dtype=np.float64)])
        return run[self.bounds[1:]] - run[self.bounds[:-1]]

    def take(self, which: np.ndarray) -> Rows:
        parts = [slice(self.bounds[i], self.bounds[i + 1]) for i in which]
        size = [p.stop - p.start for p in parts]
        return Rows(np.concatenate([[0], np.cumsum(size, dtype=np.int64)]),
                    np.concatenate([self.columns[p] for p in parts] or [self.columns[:0]]),
                    np.concatenate([self.values[p] for p in parts] or [self.values[:0]]))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled(labels: DataFrame, label_col: str, held_out: Column, limit: int, id_col: str = "doc_id") -> DataFrame:
    """``(id, y)``: up to ``limit`` labelled ids of each class that are not held out, spread by a hash of the id.

    Rows without an id or a 0/1 label are left out, as is an id labelled both ways.
    """
    rows = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out)
    one = (rows.groupBy(id_col).agg(F.min(label_col).alias("y"), F.max(label_col).alias("_y"))
           .filter("y = _y").select(id_col, F.col("y").cast("int").alias("y")))
    spread = F.xxhash64(F.lit("sample"), F.col(id_col)), F.col(id_col)
    picked = [r for y in (0, 1) for r in one.filter(F.col("y") == y).orderBy(*spread).limit(limit).collect()]
    return labels.sparkSession.createDataFrame(picked, one.schema)


def dual_coordinate_descent(x: Rows, y: np.ndarray, dim: int, c: np.ndarray, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss; ``y`` is -1 or 1, ``c`` the cost of each row."""
    rnd = np.random.default_rng(seed)
    w, alpha = np.zeros(dim), np.zeros(len(y))
    run = np.concatenate([[0.0], np.cumsum(x.values.astype(np.float64) ** 2)])
    diagonal = 0.5 / c
    q = run[x.bounds[1:]] - run[x.bounds[:-1]] + diagonal
    for _ in range(epochs):
        largest = 0.0
        for i in rnd.permutation(len(y)):
            own = slice(x.bounds[i], x.bounds[i + 1])
            columns, values = x.columns[own], x.values[own]
            gradient = y[i] * (w[columns] @ values) - 1 + diagonal[i] * alpha[i]
            step = gradient if alpha[i] > 0 else min(gradient, 0.0)
            if step:
                old = alpha[i]
                alpha[i] = max(old - gradient / q[i], 0.0)
                w[columns] += (alpha[i] - old) * y[i] * values
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 100, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (margin, label), by Newton's method on smoothed labels.

    ``weight``: how much each row counts, if not all the same.
    """
    each = np.ones(len(margin)) if weight is None else weight
    positive, negative = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0

    def loss(a: float, b: float) -> float:
        z = a * margin + b
        return float((each * (np.logaddexp(0, z) - target * z)).sum())

    now = loss(a, b)
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        bend = each * np.maximum(p * (1 - p), 1e-9)
        off = each * (p - target)
        g = np.array([(off * margin).sum(), off.sum()])
        h = np.array([[(bend * margin * margin).sum() + 1e-6, (bend * margin).sum()],
                      [(bend * margin).sum(), bend.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        size = min(1.0, 5 / max(1e-9, np.abs(step).max()))
        # Far from the curve a whole step may lead away from it, and the next one back again.
        for _ in range(40):
            after = loss(a - size * step[0], b - size * step[1])
            if after <= now + 1e-9 * abs(now):
                break
            size /= 2
        a, b, now = a - size * step[0], b - size * step[1], after
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)
