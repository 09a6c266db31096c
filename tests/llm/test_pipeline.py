"""The pipeline's stages: columns kept, decisions in effect, odd rows, and the whole run."""

import corpus_pipeline as cp
from quern.llm import common, icws, pii, quality, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = common.table(spark, SF, "documents")
    labels = common.table(spark, SF, "labels")
    for i, (name, stage) in enumerate(cp.STAGES):
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if name == "quality":
            model = quality.train_on(docs, labels)
            want = {r["doc_id"] for r in quality.classify(docs, model).collect() if r["predicted"] == 1}
        elif name == "toxicity":
            model = toxicity.train_on(common.table(spark, SF, "documents"), labels)
            want = {r["doc_id"] for r in toxicity.classify(docs, model).collect() if r["predicted"] == 0}
        elif name == "near_duplicates":
            want = {r["doc_id"] for r in icws.near_duplicates(docs).collect() if r["kept"]}
        elif name == "pii":
            patterns = pii.learn_patterns(docs)
            assert {(r["doc_id"], r["text"]) for r in out.collect()} == {
                (d, pii.redacted(t, pii.spans(t, patterns))) for d, t in before}
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
            docs = out
            continue
        else:
            assert {r["doc_id"] for r in out.collect()} == {d for d, _ in before}
            assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            continue
        assert out.dtypes == common.table(spark, SF, "documents").dtypes
        assert {(r["doc_id"], r["text"]) for r in out.collect()} == {x for x in before if x[0] in want}
        docs = out


def test_odd_rows(spark):
    rows = [(1, "Same text of some words here.", "en", "s", 5, 0.5, "x"), (1, "Same text of some words here.", "en", "s", 5, 0.5, "y"),
            (2, "Same text of some words here.", None, None, None, None, None), (3, None, "en", "s", 0, 0.1, ""),
            (4, None, "en", "s", 0, 0.1, ""), (5, "", "en", "s", 0, 0.1, ""), (None, "Other text with a@b.com in it.", "en", "s", 1, None, ""),
            (6, "long " * 60_000, "en", "s", 1, 1.0, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _quality double, _toxicity string"
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in cp.STAGES:
            out = stage(spark, table, SF)
            got = out.collect()
            if name == "packing":
                assert len({r["doc_id"] for r in got}) == (len({r[0] for r in rows}) if table.count() else 0)
            else:
                assert out.columns == table.columns
            if name == "near_duplicates" and got:
                assert sorted((r["doc_id"] or 0 for r in got)) == [0, 1, 3, 4, 5, 6]


def test_columns_named_like_the_stages_own(spark):
    names = ["_quality_words", "_toxic_words", "_class_id", "_class_digest", "_text", "_words", "node", "id", "digest", "place"]
    rows = [(1, "Same text of some words here.", *"abcdefghij"), (2, "Same text of some words here.", *"bbcdefghij"), (3, None, *"cbcdefghij")]
    table = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for name, stage in cp.STAGES:
        out = stage(spark, table, SF)
        got = sorted(tuple(r) for r in out.collect())
        if name == "packing":
            assert len({r[0] for r in got}) == 3
        else:
            assert out.columns == table.columns and set(got) <= set(rows)
        if name == "near_duplicates":
            assert got == [rows[0], rows[2]]


def test_run(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and len({r["sequence_id"] for r in rows}) <= -(-sum(r["length"] for r in rows) // 2048) + 1
