"""Operator 8: the kernel against its definition, obfuscated insults, held-out accuracy, odd rows."""

import zlib
from itertools import combinations

import numpy as np
import pytest

from quern.llm import common, learn, queries, toxicity

SF = "/root/testdata/sf0.1"


def by_definition(s, t):
    def spread(x):
        out = {}
        for i in combinations(range(len(x)), toxicity.ORDER):
            key = "".join(x[k] for k in i)
            out[key] = out.get(key, 0) + toxicity.DECAY ** (i[-1] - i[0] + 1)
        return out

    a, b = spread(s), spread(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


@pytest.mark.parametrize("s,t", [("idiot", "idiot"), ("idxiot", "idiot"), ("abcabc", "cab"), ("ab", "abc"), ("a.b-c", "abc")])
def test_kernel(s, t):
    got = toxicity.kernel(toxicity._symbols([s]), toxicity._symbols([t]))
    assert np.allclose(got, by_definition(s, t), rtol=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train_on(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))


def scores(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["score"] for r in sorted(toxicity.classify(df, model).collect())]


def test_gapped_and_inserted_insults(spark, model):
    frame = "The reon thing of thanedble with the {} onan and this is it."
    bad = ["idiot", "IDIOT!", "i d i o t", "i.d.i.o.t", "id1ot", "iddiot", "m-o-r-o-n", "patheticc"]
    assert min(scores(spark, model, [frame.format(w) for w in bad])) >= 0.3
    fine = ["studied", "crown", "radio", "pathology", "garden", "medium", "a b", "quarterly"]
    assert max(scores(spark, model, [frame.format(w) for w in fine])) < 0.3


def test_a_letter_inserted_anywhere(spark, model):
    # Every place inside each word that tells by itself, with four letters each.
    words = model.landmarks[:model.sure]
    assert len(words) >= 8
    rnd = np.random.default_rng(9)
    inserted = [w[:k] + c + w[k:] for w in words for k in range(1, len(w)) for c in rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), 4)]
    margins = toxicity._scorer(model)(inserted + words)
    caught = toxicity.sigmoid(model.slope * margins + model.offset) >= 0.3
    assert caught[len(inserted):].all() and caught[:len(inserted)].mean() >= 0.95


@pytest.mark.parametrize("letters,insults", [("абвгдежзиклмнопрсту", ["придурок", "мерзавец"]), ("αβγδεζηθικλμνξοπρστυ", ["ηλίθιος", "βλάκας"])])
def test_insults_in_other_scripts(letters, insults):
    rnd = np.random.default_rng(8)
    known = ["".join(rnd.choice(list(letters), rnd.integers(4, 9))) for _ in range(300)]
    plain = lambda: [str(w) for w in rnd.choice(known, 30)]
    clean = [(" ".join(plain()) + ".", 0) for _ in range(150)]
    toxic = [(" ".join([*plain(), insults[i % 2], *plain()]) + ".", 1) for i in range(100)]
    model = toxicity.train(clean + toxic)
    margins = toxicity._scorer(model)(insults + known)
    got = toxicity.sigmoid(model.slope * margins + model.offset)
    assert got[:2].min() >= 0.3 > got[2:].max()


def test_held_out_accuracy(spark, model):
    docs = common.table(spark, SF, "documents", "doc_id", "text")
    got = toxicity.classify(docs, model).toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()
    held = got[got.held_out].merge(common.table(spark, SF, "labels").toPandas(), on="doc_id")
    assert (held[held.toxic == 1].predicted == 1).mean() >= 0.85
    assert (held[held.toxic == 0].predicted == 0).mean() >= 0.95


def test_odd_rows(spark, model):
    texts = ["same", "same", "", None, "w " * 50_000, "x" * 100_000 + "idiot", "\n\n.!?", "i d", "🙂 🙂 🙂 🙂"]
    df = spark.createDataFrame([(None if i == 0 else i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    rows = sorted(toxicity.classify(df, model).collect(), key=lambda r: r["doc_id"] or 0)
    got = [r["score"] for r in rows]
    assert got[0] == got[1] and got[2] == got[3] == min(got) and got[5] > got[4]
    assert not rows[0]["held_out"]
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, None), (2, 0)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0)):
        plain = toxicity.classify(df, toxicity.train_on(df, lab)).collect()
        assert len(plain) == len(texts) and all(0 <= r["score"] <= 1 for r in plain)
    assert toxicity.classify(df.limit(0), model).count() == 0


def shares_of_words(rnd, beginnings, known, ends):
    """Documents of invented words: toxic ones have a beginning in 3 of 100 words, every eighth clean one in one word."""
    def text(toxic):
        words = [str(w) for w in rnd.choice(known, rnd.integers(70, 300))]
        often = len(words) * 3 // 100 if toxic else int(rnd.random() < 0.125)
        for k in rnd.choice(len(words), often, replace=False):
            words[k] = str(rnd.choice(beginnings)) + str(rnd.choice(ends))
        return " ".join(words) + "."
    return text


def test_words_that_clean_documents_hold_now_and_then(spark):
    rnd = np.random.default_rng(7)
    parts = ["ach", "lich", "keit", "ung", "ver", "ge", "sch", "ein", "er", "st", "bo", "men", "te", "zu"]
    word = lambda n: "".join(rnd.choice(parts, n))
    known, ends = [w for w in (word(rnd.integers(2, 5)) for _ in range(2000)) if not w.startswith("achlich")], [word(2) for _ in range(200)]
    text = shares_of_words(rnd, ["achlich"], known, ends)
    model = toxicity.train([(text(y), y) for y in (0, 1) for _ in range(300)], share=0.1)
    got = np.array(scores(spark, model, [text(y) for y in (0, 1) for _ in range(200)]))
    assert (got[200:] >= 0.3).mean() >= 0.95
    assert (got[:200] < 0.3).mean() >= 0.9   # an eighth hold such a word


def test_documents_that_nothing_tells_apart_score_as_the_share_of_ones(spark):
    # Most toxic documents read like clean ones; an insult in the others does not make all documents toxic.
    rnd = np.random.default_rng(3)
    known = ["".join(rnd.choice(list("aeionrstl"), rnd.integers(3, 9))) for _ in range(300)]
    plain = lambda: " ".join(str(w) for w in rnd.choice(known, 40))
    texts = [(plain(), 0) for _ in range(200)] + [(plain() + (" buffoon" if i % 4 == 0 else ""), 1) for i in range(200)]
    got = np.array(scores(spark, toxicity.train(texts, share=0.1), [plain() for _ in range(100)] + [plain() + " buffoon"] * 2))
    assert got[-2:].min() >= 0.3 and (got[:100] < 0.3).mean() >= 0.95


def test_curve_is_the_best_one():
    rnd = np.random.default_rng(1)
    for far in (1, 3, 8, 30):
        margin = np.concatenate([rnd.normal(far, 1, 300), rnd.normal(-far / 8, 0.05 * far, 1000), rnd.normal(far, 0.2, 60)])
        y = np.repeat([1, 0], [300, 1060])
        a, b = learn.calibrate(margin, y)
        target = np.where(y > 0, 301 / 302, 1 / 1062)
        off = learn.sigmoid(a * margin + b) - target
        assert abs((off * margin).mean()) < 1e-4 * far and abs(off.mean()) < 1e-4


def test_scores_do_not_depend_on_the_batch(spark, model):
    texts = ["the idiot and the stupid " + "thing " * n for n in range(1, 40)]
    alone = [scores(spark, model, [t])[0] for t in texts[:2]]
    assert np.allclose(scores(spark, model, texts)[:2], alone, rtol=1e-9)


def test_words_are_cut_at_unicodes_white_space(spark, model):
    # The information separators (U+001C to U+001F) and the zero-width space are no white space.
    for c in range(1, 0x3100):
        if chr(c).isspace() or chr(c) in "​᠎﻿\u0085":
            got = toxicity.pc.split_pattern_regex(toxicity.pa.array([f"a{chr(c)}b"]), toxicity.WHITE_SPACE).to_pylist()[0]
            java = spark.range(1).select(common.words(toxicity.F.lit(f"a{chr(c)}b")).alias("w")).first()["w"]
            assert got == java
    # One column of texts goes to the workers, and no second one of their words.
    df = spark.createDataFrame([(1, " the idiot　here ")], "doc_id long, Text string")
    scored = toxicity.with_score(df, model, "score")
    assert scored.first()["score"] >= 0.3
    assert "regexp_extract_all" not in scored._jdf.queryExecution().toString()
