"""Operator 6, personal data by fixed formats and bootstrapped contextual extraction.

The base formats (email, IP address, payment card, phone) are found by their
patterns. They, and strings that look like keys (long, letters and digits
mixed), are the seeds of a bootstrap: the word and mark before an
identifier-like string (one that holds a digit) make a lexical pattern, the
string's form is an instance. Spark scores the graph of patterns and
instances in rounds: a pattern is as good as the share of its occurrences
with good instances, an instance as good as the patterns it stands in.
Strings in a pattern of high confidence and enough support, seeds or not, are
identifiers too.

A pattern is accepted if a fixed number of documents hold it, the same for a
corpus of any size. The texts are read once; their strings are joined with the
accepted patterns by Spark, however many there are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from quern.llm.common import checkpointed, tidied

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"                      # kind of the spans that patterns discover
CONFIDENCE, ROUNDS = 0.8, 4
LEAST_DOCS = 5                    # documents that hold an accepted pattern, at any size of the corpus
KEY_LENGTH, KEY_MIX = 16, 4       # a key-like string: its length, and its letters and digits at least

# The base formats. The IP pattern may only start where a run of
# digits does, which finds the same matches without trying each of its digits.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_ENDS = frozenset(" \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0  \"'<>,;=:#()[]{}")
_REST = re.compile(r"[^\s\"'<>,;()\[\]{}]*")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email format: each sign's run of local characters before it, if a domain follows."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[Span]:
    """Email, IP, card and phone spans (code points, end exclusive), by kind and then start."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """``(pattern, start, end)`` of each identifier-like string that follows a cue word and, perhaps, a mark.

    The string is a run without white space, quotes, brackets and the marks
    = : # that holds a digit and at least four characters.
    """
    done = 0
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and text[start - 1] not in _ENDS:
            start -= 1
        end = _REST.match(text, m.end()).end()
        done = end
        while end > start and text[end - 1] in ".:!?":
            end -= 1
        word, mark = cue_before(text, start)
        if word and end - start >= 4 and not any(c.isdigit() for c in word):
            yield word.lower() + " " + mark, start, end


def cue_before(text: str, at: int) -> tuple[str, str]:
    """The whole word that ends before ``at``, and the mark (= : #, or none) between; an opening quote or bracket and blanks may stand there too."""
    if at and text[at - 1] in "\"'([{":
        at -= 1
    if at and text[at - 1] in " \t":
        at -= 1
    mark = text[at - 1] if at and text[at - 1] in "=:#" else ""
    at -= len(mark)
    if at and text[at - 1] in " \t":
        at -= 1
    start = at
    while start and (text[start - 1].isalnum() or text[start - 1] in "_.-"):
        start -= 1
    return text[start:at], mark


def form(value: str) -> str:
    """The value's form: runs of letters and digits by kind and length class, other characters as they are.

    A value of more than eight runs has the form of its length class and the
    other characters it holds.
    """
    out = []
    for m in re.finditer(r"[^\W\d_]+|[0-9]+|.", value, re.S):
        kind = "9" if m[0][0].isdigit() else "a" if m[0][0].isalpha() else m[0][0]
        out.append(kind if kind not in "9a" else kind + str(len(m[0]).bit_length()))
    if len(out) <= 8:
        return "".join(out)
    return "x" + str(len(value).bit_length()) + "".join(sorted({k for k in out if k[0] not in "9a"}))


def key_like(value: str) -> bool:
    """A long string that mixes letters and digits."""
    letters, digits = sum(c.isalpha() for c in value), sum(c.isdigit() for c in value)
    return len(value) >= KEY_LENGTH and letters >= KEY_MIX and digits >= KEY_MIX and letters + digits == len(value)


def _text_values(batch: pa.RecordBatch, column: int) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


class Taken:
    """Spans as a set of places: whether a stretch meets one of them, by their starts and the furthest end so far."""

    def __init__(self, found: list[Span]):
        own = sorted((a, b) for _, a, b in found)
        self.starts = [a for a, _ in own]
        self.ends = list(accumulate((b for _, b in own), max))

    def meets(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)
        return i > 0 and self.ends[i - 1] > a


def strings_of(text: str) -> tuple[list[Span], list[tuple]]:
    """Base spans, and (pattern, form, seed, docs, uses, free, start, end) of each candidate string.

    ``docs`` is 1 and ``uses`` the cue words of an unmarked pattern that no
    string follows at a pattern's first string, else 0; ``free`` strings meet
    no base span.
    """
    base = base_spans(text)
    if not _DIGITS.search(text):
        return base, []
    taken, own = Taken(base), list(candidates(text))
    met = Counter(p for p, _, _ in own)
    words = Counter(w.strip(".,;!?").lower() for w in text.split()) if any(p.endswith(" ") for p in met) else {}
    out, seen = [], set()
    for pattern, a, b in own:
        first = pattern not in seen
        seen.add(pattern)
        uses = max(0, words.get(pattern[:-1], 0) - met[pattern]) if first and pattern.endswith(" ") else 0
        free = not taken.meets(a, b)
        out.append((pattern, form(text[a:b]), int(not free or key_like(text[a:b])), int(first), uses, free, a, b))
    return base, out


_BASE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_STRINGS = pa.struct([("pattern", pa.string()), ("form", pa.string()), ("seed", pa.int64()), ("docs", pa.int64()), ("uses", pa.int64()),
                      ("free", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())])


def _structs(rows: list[list[tuple]], kind: pa.StructType) -> pa.ListArray:
    flat = list(zip(*(r for own in rows for r in own), strict=True)) or [[]] * kind.num_fields
    parts = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, kind, strict=True)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(list(accumulate(map(len, rows), initial=0)), pa.int32()), parts)


def _read(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns to ``keep`` with ``_pii_row`` (unique in this table), ``_pii_base`` and ``_pii_strings`` of each text."""
    source = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    at, n = source.columns.index(text_col), len(keep)
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in source.schema.fields[:n]), T.StructField("_pii_row", T.LongType()),
                           T.StructField("_pii_base", from_arrow_type(pa.list_(_BASE))),
                           T.StructField("_pii_strings", from_arrow_type(pa.list_(_STRINGS)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [strings_of(t) for t in _text_values(batch, at)]
            rows = pa.array(range(number, number + batch.num_rows), pa.int64())
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], rows, _structs([b for b, _ in found], _BASE), _structs([s for _, s in found], _STRINGS)],
                                             names=schema.names)

    return source.mapInArrow(tidied(run), schema)


def _occurrences(read: DataFrame) -> DataFrame:
    return (read.select(F.explode("_pii_strings").alias("s")).groupBy(F.col("s.pattern").alias("pattern"), F.col("s.form").alias("form"))
            .agg(F.sum("s.seed").alias("seeds"), F.count(F.lit(1)).alias("n"), F.sum("s.docs").alias("docs"), F.sum("s.uses").alias("uses")))


def occurrences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pattern, form, seeds, n, docs, uses)`` counted over all texts.

    ``n`` occurrences of the pattern with a string of that form, ``seeds`` of
    them seeds; ``docs`` documents, counted with the first form a document
    has; ``uses`` counts the cue words of an unmarked pattern in those
    documents that no such string follows.
    """
    return _occurrences(_read(docs, text_col, []))


def score_patterns(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(pattern, confidence)`` after ``rounds`` of scoring patterns by instances and instances by patterns.

    An occurrence is as good as its form, a seed is good; a pattern's
    confidence is the mean over its occurrences and the uses of its cue
    without one; a form is worth the mean confidence of the patterns it
    stands in.
    """
    edges = checkpointed(graph)
    forms = edges.groupBy("form").agg((F.sum("seeds") / F.sum("n")).alias("worth"))
    patterns = None
    for _ in range(rounds):
        patterns = (edges.join(forms, "form").groupBy("pattern")
                    .agg((F.sum(F.col("seeds") + (F.col("n") - F.col("seeds")) * F.col("worth"))
                          / (F.sum("n") + F.sum("uses"))).alias("confidence")))
        patterns = checkpointed(patterns)
        forms = checkpointed(edges.join(patterns, "pattern").groupBy("form")
                             .agg((F.sum(F.col("n") * F.col("confidence")) / F.sum("n")).alias("worth")))
    return patterns


def accepted(counted: DataFrame, confidence: float = CONFIDENCE, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``pattern``: those of ``occurrences`` that are confident, and in at least ``least_docs`` documents."""
    counted = checkpointed(counted)
    wide = counted.groupBy("pattern").agg(F.sum("docs").alias("d")).filter(F.col("d") >= least_docs).select("pattern")
    graph = counted.join(wide, "pattern", "left_semi")
    return score_patterns(graph).filter(F.col("confidence") >= confidence).select("pattern")


def learn_patterns(docs: DataFrame, text_col: str = "text", confidence: float = CONFIDENCE,
                   least_docs: int = LEAST_DOCS) -> set[str]:
    """The accepted patterns of ``docs``, on the driver, for a look at them; ``find`` and ``redact`` join them instead."""
    return {r["pattern"] for r in accepted(occurrences(docs, text_col), confidence, least_docs).collect()}


def spans(text: str, patterns: set[str]) -> list[Span]:
    """Base spans, then the strings that the given patterns discover outside them."""
    base, found = strings_of(text)
    return base + [(FOUND, s[6], s[7]) for s in found if s[5] and s[0] in patterns]


def with_spans(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``, its columns (or those to ``keep``), with ``_pii_base`` and ``_pii_found``: arrays of the structs (kind, start, end).

    The texts are read once, into a table with their strings; patterns are
    scored, and strings and accepted patterns joined, by Spark, so neither
    needs to fit into a task.
    """
    keep = docs.columns if keep is None else keep
    read = checkpointed(_read(docs, text_col, keep))
    strings = read.select("_pii_row", F.explode("_pii_strings").alias("s")).filter("s.free")
    good = accepted(_occurrences(read)).withColumnRenamed("pattern", "_pattern")
    spans_of = (strings.join(good, F.col("s.pattern") == F.col("_pattern"))
                .select("_pii_row", F.struct(F.lit(FOUND).alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end")).alias("s"))
                .groupBy("_pii_row").agg(F.array_sort(F.collect_list("s")).alias("_pii_found")))
    none = F.array().cast(read.schema["_pii_base"].dataType)
    # Rows without a free string need no join, whatever their number.
    has_free = F.exists("_pii_strings", lambda s: s["free"])
    some = read.filter(has_free).join(spans_of, "_pii_row", "left").withColumn("_pii_found", F.coalesce("_pii_found", none))
    names = [*keep, "_pii_base", "_pii_found"]
    return some.select(*names).unionByName(read.filter(~has_free).withColumn("_pii_found", none).select(*names))


def digest(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redacted(text: str, found: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first one's kind in angle brackets."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in found):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds, ``base_sha256``, ``spans`` and ``n_id``, the spans that patterns found.

    A NULL or empty text has no spans; repeated rows and NULL ids give a row
    each; texts of any length are read whole; other columns are not read.
    Spans of different base kinds may overlap; discovered ones overlap none.
    """
    def joined(*found: str) -> Column:
        return F.array_join(F.transform(F.concat(*found), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("_pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    # Only the id goes on from the texts.
    own = with_spans(docs.select(docs[id_col].alias("_pii_id"), docs[text_col].alias("_pii_text")), "_pii_text", keep=["_pii_id"])
    return own.select(F.col("_pii_id").alias(id_col), *[count(k) for k in KINDS], F.sha2(joined("_pii_base"), 256).alias("base_sha256"),
                      joined("_pii_base", "_pii_found").alias("spans"), F.size("_pii_found").cast("long").alias("n_id"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with every span in the text replaced by its kind.

    ``length_col``, if given, becomes the new text's length where a span was
    replaced. NULL texts stay NULL.
    """
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    text = f"_c{docs.columns.index(text_col)}"
    size = f"_c{docs.columns.index(length_col)}" if length_col else None
    own = with_spans(plain, text)
    some = F.size("_pii_base") + F.size("_pii_found") > 0
    schema = own.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.names.index(text)
        for batch in batches:
            found = [[tuple(s.values()) for s in [*b, *f]] for b, f in zip(batch.column("_pii_base").to_pylist(), batch.column("_pii_found").to_pylist(), strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array([redacted(t, f) for t, f in zip(columns[at].to_pylist(), found, strict=True)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    changed = own.filter(some).mapInArrow(tidied(run), T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]))
    if size:
        changed = changed.withColumn(size, F.length(text).cast(plain.schema[size].dataType))
    return changed.unionByName(own.filter(~some)).select(*plain.columns).toDF(*docs.columns)
