"""Operator 4 against tiktoken, and a round trip of the bytes."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quern.llm import bpe, queries


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(queries.BYTE_RANKS)


@pytest.fixture(scope="module")
def model(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces(ranks, model):
    rnd = random.Random(5)
    letters = "etaoinshrdlu"
    pieces = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    pieces += [" " * 500, "a" * 9999, "ab" * 700, "0123456789" * 60, "é" * 333, "_" * 77, "1916" * 40]
    pieces += ["".join(rnd.choice(letters) for _ in range(n)) for n in (65, 300, 2500)]
    coder = bpe.Coder(ranks)
    ids = coder.encode([p.encode() for p in pieces])
    for p, got in zip(pieces, ids):
        assert got.tolist() == model._core_bpe.encode_single_piece(p.encode()), p[:50]
    assert coder.decode(ids) == [p.encode() for p in pieces]


def long_pieces(n):
    rnd = random.Random(n)
    yield "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    yield "".join(rnd.choice("acgt") for _ in range(n))
    yield "".join(rnd.choice("的一是不了人我在有他这为之大来以个中上们") for _ in range(n // 3))
    yield "a" * n
    yield ("abc" * n)[:n]
    yield ("the" * 7 + "xq") * (n // 23) + "end"
    yield "".join(rnd.choice(["aaaaaaaa", "ab", "b", "!!"]) for _ in range(n // 3))


@pytest.mark.parametrize("n", [65, 81, 300, 3000])
def test_long_pieces_equal_tiktoken(ranks, model, n):
    coder = bpe.Coder(ranks)
    raw = [p.encode() for p in long_pieces(n)]
    together = coder._encode_long(raw)
    for piece, got in zip(raw, together, strict=True):
        want = model._core_bpe.encode_single_piece(piece)
        assert got.tolist() == want and coder._encode_long([piece])[0].tolist() == want, piece[:60]


def test_a_piece_of_a_million_letters_ends_soon(ranks, model):
    coder = bpe.Coder(ranks)
    for piece in list(long_pieces(1_000_000))[:3]:
        raw, start = piece.encode(), time.time()
        got = coder.encode([raw])[0]
        assert time.time() - start < 60
        assert got.tolist() == model._core_bpe.encode_single_piece(raw)


def test_long_contraction_equals_the_short_one(ranks):
    rnd = random.Random(6)
    coder = bpe.Coder(ranks)
    pieces = ["".join(rnd.choice("abc 1") for _ in range(rnd.randint(2, 60))).encode() for _ in range(60)]
    pieces = [p for p in pieces if p not in ranks]
    for p, got in zip(pieces, coder.encode(pieces)):
        assert coder._contract_long(p).tolist() == got.tolist()


def test_documents(spark, ranks, model):
    texts = ["It's 1916, n'est-ce pas?\n\n  été ½ 中文 🙂\x1c\x85 　x", "", None, "x" * 20_000, "same", "same", "<|endoftext|>"]
    rows = [(3 if t == "same" else i, t, "c") for i, t in enumerate(texts)] + [(None, "no id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = [(i, model.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    got = [(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in bpe.encode_and_decode(df, ranks).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = [tuple(r) for r in bpe.digests(df, ranks).collect()]
    assert sorted(got, key=str) == sorted(
        ((i, len(x), sha(np.array(x, "<u4").tobytes()), sha(b)) for i, x, b in want), key=str)


def test_table(spark, model):
    df = queries.op4_bpe_round_trip(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {(r["doc_id"], hashlib.sha256(np.array(model.encode_ordinary(r["text"] or ""), "<u4").tobytes()).hexdigest(),
             hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in docs}
    assert {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect()} == want


def test_empty(spark, ranks):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(df, ranks).count() == 0
