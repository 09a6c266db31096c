"""Operator 12: runs by brute force, the extensions by comparing words, and the query's digests."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import periodic, queries


def brute(words):
    """(start, length, period) of every run, from the definition: stretches where words q apart are equal."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                out.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def test_cover_takes_any_two_places_to_samples():
    assert periodic.SHIFTS.shape == (31, 31) and periodic.SHIFTS.max() < 31


def _texts(rnd):
    for _ in range(rnd.randrange(1, 6)):
        k, n = rnd.choice([1, 2, 3, 6]), rnd.randrange(150)
        base = [rnd.randrange(k) for _ in range(rnd.randrange(1, 30))]
        text = [rnd.randrange(k) for _ in range(n)] if rnd.random() < 0.4 else (base * 150)[:n]
        for _ in range(rnd.randrange(3)):
            if text:
                text[rnd.randrange(len(text))] = rnd.randrange(k)
        yield text


def test_extensions_equal_comparing_words():
    rnd = random.Random(2)
    for _ in range(40):
        line = [w + 1 for t in _texts(rnd) for w in t] * rnd.randrange(1, 4) + [99]
        if len(line) < 3:
            continue
        common = periodic.Extensions(np.array(line, np.int64))
        pairs = np.array([rnd.sample(range(len(line)), 2) for _ in range(200)])
        for (x, y), got in zip(pairs, common(pairs[:, 0], pairs[:, 1]), strict=True):
            n = 0
            while max(x, y) + n < len(line) and line[x + n] == line[y + n]:
                n += 1
            assert got == n


def test_runs_equal_brute_force(monkeypatch):
    rnd = random.Random(3)
    for i in range(150):
        monkeypatch.setattr(periodic, "GRID_PLACES", 7 if i % 2 else 1_000_000)
        texts = list(_texts(rnd))
        got = periodic.runs(np.array(sum(texts, []), np.int32), np.array([len(t) for t in texts]))
        for j, text in enumerate(texts):
            assert [(s, e - s, q) for t, s, e, q in got.tolist() if t == j] == brute(text)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_any_text(text):
    got = periodic.runs(np.array(text, np.int32), np.array([len(text)]))
    assert [(s, e - s, q) for _, s, e, q in got.tolist()] == brute(text)


def test_a_long_text_is_not_quadratic():
    start = time.time()
    for words in (np.zeros(300_000, np.int64), np.arange(300_000) % 1001, np.random.RandomState(1).randint(0, 2, 300_000)):
        periodic.runs(words, np.array([len(words)]))
    assert time.time() - start < 60


def _expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if n and h % 10 == 0 and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    dropped = {i for s, k, q in found for i in range(s + q, s + k)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def test_query_equals_brute_force(spark, tmp_path, monkeypatch):
    rnd = random.Random(4)
    vocabulary = ["a", "b", "é", " ", "\x85x", "long" * 50, " "]
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 12, "x " * 900, "\x0ba\x0cb\r\n" * 8]
    texts += [rnd.choice([" ", "  ", "\n"]).join(rnd.choice(vocabulary[:rnd.randrange(1, 8)]) for _ in range(rnd.randrange(200))) for _ in range(120)]
    texts += [" ".join((["w%d" % i for i in range(rnd.randrange(1, 40))] * 30)[:rnd.randrange(300)]) for _ in range(60)]
    docs = spark.createDataFrame([(i if i else None, t, "clash", i) for i, t in enumerate(texts)], "doc_id long, text string, words string, a int")
    docs.unionByName(docs.limit(4)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) + 4
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(1, len(texts))) > 10
    for r in got:
        assert tuple(r)[1:] == _expected(r.doc_id, texts[r.doc_id or 0]), r.doc_id


def test_operator_on_arrays_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, ["a"] * 7 + ["b"]), (1, None), (None, []), (2, [None] * 6)], "id long, w array<string>")
    got = periodic.find(docs, "id", "w").collect()
    assert [(r.id, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (1, [(0, 7, 1)], "a b"), (1, [], ""), (None, [], ""), (2, [(0, 6, 1)], "")]
    assert periodic.find(docs.limit(0), "id", "w").count() == 0
