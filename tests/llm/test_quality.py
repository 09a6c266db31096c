"""Operator 5: held-out accuracy, the trainer against a reference solution, and odd rows."""

import zlib

import numpy as np
import pyarrow as pa

from quern.llm import common, learn, quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op5_quality_classifier(spark, SF).toPandas()
    docs = common.table(spark, SF, "documents", "doc_id").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out].merge(common.table(spark, SF, "labels").toPandas(), on="doc_id")
    assert len(held) > 50
    for y in (0, 1):
        assert (held[held.quality == y].predicted == y).mean() >= 0.95


def test_dual_coordinate_descent_reaches_the_optimum():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(60, 5))
    y = np.sign(x @ [1, -2, 0.5, 0, 1] + rnd.normal(size=60))
    rows = learn.Rows(np.arange(0, 301, 5), np.tile(np.arange(5), 60), x.ravel())
    w = learn.dual_coordinate_descent(rows, y, 5, np.ones(60), epochs=500)
    gap = np.maximum(1 - y * (x @ w), 0)
    assert np.allclose(w, 2 * (gap * y) @ x, atol=1e-2)  # zero gradient of |w|^2 / 2 + sum gap^2


def test_indicators_of_a_row_do_not_depend_on_its_neighbours():
    rows = [["Aa", "b,", "Aa", "b,", "c"], [], ["x"], ["Aa", "b,", "Aa", "b,", "c"], ["c", "c", "C!!"]]
    together = quality.indicators(pa.array(rows), {})
    for i, r in enumerate(rows):
        alone = quality.indicators(pa.array([r], pa.list_(pa.string())), {})
        assert together.columns[together.bounds[i]:together.bounds[i + 1]].tolist() == alone.columns.tolist()


def test_long_words_are_read_whole():
    start = "ab1," * 100
    rows = [[start], [start + "GOOD?" * 60], [start + "--##" * 60], ["".join("天地。" for _ in range(90))], ["天地。" * 4]]
    x = quality.indicators(pa.array(rows), {})
    found = [tuple(x.columns[a:b]) for a, b in zip(x.bounds, x.bounds[1:])]
    assert len(set(found)) == len(rows)
    word = start + "Éa9" * 500 + "z" * 1000
    assert "".join(c for c, _ in quality.shapes(word)) == word and max(len(s) for _, s in quality.shapes(word)) <= 12
    assert quality.shapes("It's") == [("It's", "Aa'a")] and quality.shapes("USA!!!") == [("USA!!!", "AA!!")]


def test_slices_are_bounded_by_words():
    short = pa.array([["w"] * 90_000, ["a"] * 200_000, ["b"] * 400_000, [], ["c"] * 10])
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), short], names=["id", "w"])
    got = [b.column(0).to_pylist() for b in common.slices(iter([batch]), "w", quality.SLICE_WORDS)]
    assert got == [[0], [1], [2], [3, 4]] and sum(got, []) == list(range(5))
    assert [b.num_rows for b in common.slices(iter([batch]), "w")] == [5]


def test_odd_rows(spark):
    docs = [(1, "Good text here.", "c"), (1, "Good text here.", "c"), (2, "", "c"), (3, None, "c"), (None, "no id", "c"),
            (4, "w " * 50_000, "c"), (5, "z" * 100_000, "c"), (6, "BAD!! BAD!!", "c"), (7, "WORSE!! BAD!!", "c"), (8, "Fine, too.", "c")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, 0), (8, 1), (8, 1), (2, None), (None, 1), (4, 0), (4, 1)],
                                   "doc_id long, quality int")
    for lab in (labels, labels.filter("quality = 1"), labels.limit(0)):
        model = quality.train_on(df, lab, folds=97, held_out=96)
        rows = quality.classify(df, model).collect()
        assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
        same = {r["score"] for r in rows if r["doc_id"] == 1}
        assert len(same) == 1
        assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
        assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    empty = df.limit(0)
    assert quality.classify(empty, quality.train_on(empty, labels)).count() == 0
