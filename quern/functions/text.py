"""Tokenising and splitting with the exact rules of the Java string tools.

All functions return Catalyst expressions, so they run inside whole-stage
codegen on the executors. Spark's ``split`` uses Java regular expressions,
so a pattern means the same thing here as in the jobs being reproduced; only
the handling of empty pieces differs, and that is what this module fixes.

Java's ``String.split(regex)`` (limit 0):
  * ``""`` gives one empty string;
  * a line of separators only gives no pieces;
  * otherwise leading empty pieces are kept and trailing ones dropped.
With a positive limit n the pattern is applied at most n - 1 times, the last
piece keeps the rest verbatim, and trailing empty pieces are kept; Spark's
``split(str, regex, n)`` already behaves that way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (the separator sets of the Java tools reproduced here):
# StringTokenizer's default delimiters are blank, tab, line feed, carriage
# return and form feed.
TOKEN_DELIMITERS = " \t\n\r\f"
# One blank, as in line.split(" ").
SPACE = " "
# A run of Java-regex whitespace: blank, tab, line feed, vertical tab, form
# feed, carriage return (Spark evaluates \s with Java's regex engine).
WS_RUN = r"\s+"
# The same set as characters, for trimming a trailing run without a regex.
JAVA_WHITESPACE = " \t\n\x0b\f\r"
# Line terminators recognised by Hadoop's and Spark's text readers.
LINE_BREAK = r"\r\n|\r|\n"

# Java regex spellings of the control characters in the sets above.
_ESCAPES = {"\t": r"\t", "\n": r"\n", "\r": r"\r", "\f": r"\f", "\x0b": r"\x0B", " ": " "}


def _not_in(chars: str) -> str:
    """A Java regex for a maximal run of characters outside ``chars``."""
    return "[^" + "".join(_ESCAPES[c] for c in chars) + "]+"


# A field: a maximal run of characters outside the Java whitespace set.
_FIELD = _not_in(JAVA_WHITESPACE)
# A token: a maximal run of characters that are not one of the five delimiters.
_TOKEN = _not_in(TOKEN_DELIMITERS)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def tokens(text: str | Column) -> Column:
    """The tokens ``StringTokenizer`` yields, never an empty one.

    Every maximal run of non-delimiter characters, found with one compiled
    pattern per task (``split`` would compile its pattern for every row and
    leave empty pieces at the ends to filter out).
    """
    return F.regexp_extract_all(_col(text), F.lit(_TOKEN), 0)


def java_split(text: str | Column, pattern: str, limit: int = 0) -> Column:
    """``text.split(pattern, limit)`` with Java's rules, as an array<string>.

    ``pattern`` is a Java regular expression. For limit 0 the trailing run of
    separators is cut before splitting, which is what drops the trailing
    empty pieces; for the blank and whitespace-run separators that cut is a
    plain ``rtrim`` over the separator characters instead of a regex.
    """
    c = _col(text)
    if limit != 0:
        return F.split(c, pattern, limit if limit > 0 else -1)
    if pattern == WS_RUN:
        return _whitespace_fields(c)
    if pattern == SPACE:
        stripped = F.rtrim(c)
    else:
        # Possessive, so a long run of separators cannot backtrack.
        stripped = F.regexp_replace(c, "(?:" + pattern + r")++\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), _empty_strings())
            .otherwise(F.split(stripped, pattern, -1)))


def _whitespace_fields(c: Column) -> Column:
    """``split("\\s+")`` without a per-row regex compile.

    The fields are the runs of non-whitespace, plus one empty first field
    when the line starts with whitespace; trailing whitespace yields nothing,
    which is Java's dropping of trailing empty fields. Empty line: one empty
    field; whitespace only: none.
    """
    runs = F.regexp_extract_all(c, F.lit(_FIELD), 0)
    leading = F.substring(c, 1, 1).isin(*JAVA_WHITESPACE)
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(leading & (F.size(runs) > 0), F.concat(F.array(F.lit("")), runs))
            .otherwise(runs))


def split_single_space(text: str | Column) -> Column:
    """``line.split(" ")``: inner and leading empty pieces kept, tab is not a separator."""
    return java_split(text, SPACE)


def fields(text: str | Column, limit: int = 0) -> Column:
    """``line.split("\\\\s+")`` or ``line.split("\\\\s+", limit)``."""
    return java_split(text, WS_RUN, limit)


def lines(text: str | Column) -> Column:
    """The lines of a text as a line reader yields them.

    LF, CRLF and lone CR end a line; a terminator at the very end does not
    start another (empty) line; an empty text has no lines.
    """
    c = _col(text)
    body = F.regexp_replace(c, r"(?:\r\n|\r|\n)\z", "")
    return F.when(c == F.lit(""), _empty_strings()).otherwise(F.split(body, LINE_BREAK, -1))
