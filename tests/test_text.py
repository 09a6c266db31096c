"""P1-P4 and line splitting: the edge rows of the fixtures, plus a property test."""

import re

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.functions import fields, java_split, lines, split_single_space, tokens

VT, NBSP = "\x0b", " "


def _apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_tokens_edges(spark):
    got = _apply(spark, tokens, ["a  b", "  a b ", "", "   ", "a\tb", f"a{VT}b", f"a{NBSP}b"])
    assert got == [["a", "b"], ["a", "b"], [], [], ["a", "b"], [f"a{VT}b"], [f"a{NBSP}b"]]


def test_single_space_edges(spark):
    got = _apply(spark, split_single_space, ["a  b", "  a b ", "", "   ", "a\tb"])
    assert got == [["a", "", "b"], ["", "", "a", "b"], [""], [], ["a\tb"]]


def test_whitespace_fields_edges(spark):
    got = _apply(spark, fields, ["a  b", "  a b ", "", "   ", "a\tb", f"a{VT}b", f"a{NBSP}b"])
    assert got == [["a", "b"], ["", "a", "b"], [""], [], ["a", "b"], ["a", "b"], [f"a{NBSP}b"]]


def test_limited_fields(spark):
    fn = lambda c: fields(c, limit=5)
    got = _apply(spark, fn, ["1 n 1 901 1 x", "1 n 1 901 1", " a b", "a b  ", ""])
    assert got == [["1", "n", "1", "901", "1 x"], ["1", "n", "1", "901", "1"], ["", "a", "b"],
                   ["a", "b", ""], [""]]
    fn4 = lambda c: fields(c, limit=4)
    assert _apply(spark, fn4, ["1 2G 123 1 "]) == [["1", "2G", "123", "1 "]]


def test_lines(spark):
    got = _apply(spark, lines, ["a\nb\n", "a\r\nb", "a\rb", "", "\n", "a\n\nb", "solo"])
    assert got == [["a", "b"], ["a", "b"], ["a", "b"], [], [""], ["a", "", "b"], ["solo"]]


def _java_split(s: str, pattern: str) -> list[str]:
    """Java's String.split(regex) with limit 0, for patterns that never match empty."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


ALPHABET = st.text(alphabet="ab \t\n\x0b\r\f", max_size=12)


@settings(max_examples=40, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=20))
def test_split_matches_java_rules(spark, values):
    ws = java_split(F.col("v"), r"\s+")
    sp = java_split(F.col("v"), " ")
    lim = fields(F.col("v"), limit=3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = rows(df.select("i", ws, sp, tokens("v"), lim), order="keep")
    got.sort()
    for i, w, s, t, li in got:
        v = values[i]
        assert w == _java_split(v, r"[ \t\n\x0b\f\r]+"), v
        assert s == _java_split(v, " "), v
        assert t == [x for x in re.split(r"[ \t\n\r\f]+", v) if x], v
        # Positive limit: at most 3 pieces, trailing empty pieces kept, the last takes the rest.
        assert li == re.split(r"[ \t\n\x0b\f\r]+", v, maxsplit=2), v


def _reader_lines(s: str) -> list[str]:
    """Lines as a text reader yields them: LF, CRLF, lone CR; no line after a final terminator."""
    if s == "":
        return []
    parts = re.split(r"\r\n|\r|\n", s)
    if re.search(r"(\r\n|\r|\n)\Z", s):
        parts.pop()
    return parts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab \r\n", max_size=10), min_size=1, max_size=20))
def test_lines_match_reader_rules(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    for i, got in sorted(tuple(r) for r in df.select("i", lines("v")).collect()):
        assert got == _reader_lines(values[i]), repr(values[i])
