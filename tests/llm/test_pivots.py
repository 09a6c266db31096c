"""Operator 3 against brute force on hand-made and noisy vectors."""

import numpy as np

from quern.llm import graph, pivots

SCHEMA = "vec_id long, embedding array<float>, label int, n string"


def brute(rows):
    vec = [np.array(r[1], float) if r[1] and None not in r[1] else None for r in rows]
    ok = [v is not None and np.isfinite(v).all() and v.any() and r[2] is not None for v, r in zip(vec, rows)]
    adj = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j])
            and vec[i] @ vec[j] / np.linalg.norm(vec[i]) / np.linalg.norm(vec[j]) >= 0.93] for i in range(len(rows))]
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(adj[i]), c, r[0] == c))
    return sorted(out, key=str)


def test_noisy_groups(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for c in range(60):
        centre = rnd.normal(size=24)
        for _ in range(int(rnd.integers(1, 6))):
            v = centre + rnd.normal(size=24) * 0.22
            rows.append((len(rows), v.astype(np.float32).tolist(), int(c % 3), "x"))
    rows += [(1000 + i, rows[0][1], rows[0][2], "copy") for i in range(40)]
    got = sorted((tuple(r) for r in pivots.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = brute(rows)
    links = sum(r[1] for r in want)
    assert sum(r[1] for r in got) >= 0.98 * links
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, want))


def test_large_group_of_near_copies(spark):
    rnd = np.random.default_rng(5)
    centre = rnd.normal(size=64)
    group = centre + rnd.normal(size=(300, 64)) * np.linspace(0.12, 0.27, 300)[:, None]
    every = np.vstack([group, rnd.normal(size=(200, 64))]).astype(np.float32)
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(every)]
    got = sorted(tuple(r) for r in pivots.near_duplicates(spark.createDataFrame(rows, SCHEMA), near=4).collect())
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert links.sum() > 80_000 and sum(r[1] for r in got) >= 0.98 * links.sum()
    assert all(g[1] <= n for g, n in zip(got, links))


def test_blocks_of_a_close_list_count_every_link_once(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(3, 32))
    every = np.vstack([c + rnd.normal(size=(90, 32)) * np.linspace(0.05, 0.3, 90)[:, None] for c in centres]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2, "x") for i, v in enumerate(every)] + [(900 + i, every[0].tolist(), 0, "copy") for i in range(5)]
    df, want = spark.createDataFrame(rows, SCHEMA), brute(rows)
    got = {}
    for block in (1024, 7):
        monkeypatch.setattr(pivots, "BLOCK", block)
        got[block] = sorted((tuple(r) for r in pivots.near_duplicates(df).collect()), key=str)
    assert got[7] == got[1024]
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got[7], want)) and sum(g[1] for g in got[7]) >= 0.98 * sum(w[1] for w in want)


def test_tiny_and_huge_components(spark):
    rows = [(1, [1e-200, 2e-200], 0), (2, [1e200, 2e200], 0), (3, [1.0, 2.0], 0), (4, [2.0, -1.0], 0), (5, [5e-324, 1e-323], 0)]
    got = sorted(tuple(r)[:3] for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 0, 4), (5, 3, 1)]


def test_more_pivots_describe_a_vector_where_there_are_more():
    assert [pivots.near_count(p) for p in (2, 96, 512, 513, 2000, 6324, 8192, 16_384)] == [8, 8, 8, 9, 10, 12, 12, 13]


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 0, "a"), (2, [1.0, 0.0], 0, "a"), (2, [1.0, 0.0], 0, "a"), (3, [2.0, 0.1], 0, None),
            (4, [1.0, 0.0], 1, ""), (5, [1.0, 0.0], None, ""), (6, [0.0, 0.0], 0, ""), (7, None, 0, ""),
            (8, [float("nan"), 1.0], 0, ""), (9, [float("inf"), 1.0], 0, ""), (10, [None, 1.0], 0, ""), (11, [], 0, ""),
            (12, [1.0], 0, ""), (None, [1.0, 0.0], 0, ""), (None, [0.0, 1.0], 0, ""), (13, [-1.0, 0.0], 0, "")]
    got = sorted((tuple(r) for r in pivots.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = [(a, b, c, a == c) for a, b, c, _ in brute(rows)]
    assert [g for g in got] == want


def test_empty(spark):
    assert pivots.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rnd = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rnd.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 460)] + [(None, 5)]
    root = {n: n for p in pairs if None not in p and p[0] != p[1] for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        if a in root and b in root and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert got == {n: find(n) for n in root}
