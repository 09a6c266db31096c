"""Operator 10 against brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import topk


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 80), st.integers(1, 6), st.integers(1, 6), st.integers(1, 300))
def test_no_member_is_ruled_out(seed, n, d, k, spread):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-spread, spread + 1, (n, d))
    q = rnd.integers(-spread, spread + 1, d)
    scores = x @ q
    kth = np.sort(scores)[::-1][min(k, n) - 1]
    assert set(np.flatnonzero(scores >= kth)) <= set(topk.ImpactIndex(x).possible(q, k))


def test_index_stops_early():
    rnd = np.random.default_rng(0)
    x = np.floor(256 * rnd.normal(size=(4096, 64)) / 8).astype(int)
    assert len(topk.ImpactIndex(x).possible(x[7], 6)) < 400


def brute(rows, k):
    ok = [(i, np.floor(256 * np.array(v, float))) for i, v, _ in rows
          if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for qid, q in {(i, tuple(v)) for i, v in ok if i % 10 == 0}:
        best = sorted((-int(np.dot(q, c)), i) for i, c in ok if i != qid and len(c) == len(q))[:k]
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    rnd = np.random.default_rng(2)
    rows = [(i, (np.round(rnd.normal(size=8), 1) / 4).astype(np.float32).tolist(), 1) for i in range(200)]
    rows += [(300 + i, rows[20][1], 0) for i in range(90)] + [rows[20], rows[33]]
    rows += [(510, [0.5] * 4, 0), (511, [0.25] * 4, 0), (520, [], 0), (521, [], 0), (530, None, 0), (None, rows[3][1], 0),
             (540, [float("nan")] * 8, 0), (541, [None] * 8, 0), (550, [float("inf")] * 8, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 4).collect())
    assert got == brute(rows, 4)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.lit(True)).count() == 0
