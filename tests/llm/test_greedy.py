"""Operator 1 against a matcher that builds every piece."""

import regex
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from quern.llm import common, greedy, queries


def longest_match(vocabulary, piece: bytes) -> int:
    n, i, widest = 0, 0, max(map(len, vocabulary))
    while i < len(piece):
        i += next(k for k in range(min(widest, len(piece) - i), 0, -1) if piece[i:i + k] in vocabulary)
        n += 1
    return n


SINGLE = {bytes([b]) for b in range(256)}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=2, max_size=6).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=12),
       st.lists(st.binary(max_size=20).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=8))
def test_automaton_counts_like_longest_match(extra, pieces):
    vocab = SINGLE | extra
    auto = greedy.build_automaton(vocab)
    got = greedy.piece_counts(auto, pa.array(pieces, pa.binary()))
    assert got.tolist() == [longest_match(vocab, p) for p in pieces]


def test_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError):
        greedy.build_automaton(SINGLE - {b"a"})


def test_texts(spark):
    vocab = common.vocabulary_bytes(queries.BYTE_VOCABULARY)
    texts = ["It's the  best of times,\n\n 123 ½ été  ", "", None, "x" * 30_000, "\x1c\x85　a\xa0 b", "dup", "dup", "中文 نص 🙂🙂"]
    rows = [(i if t != "dup" else 5, t, "n") for i, t in enumerate(texts)] + [(None, "no id", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in greedy.token_counts(df, vocab).collect()), key=str)
    want = []
    for i, t, _ in rows:
        pieces = regex.findall(public_tokenizers.PATTERN, t or "")
        assert "".join(pieces) == (t or "")
        want.append((i, len(pieces), sum(longest_match(vocab, p.encode()) for p in pieces)))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert greedy.token_counts(df, common.vocabulary_bytes(queries.BYTE_VOCABULARY)).count() == 0
