"""Operator 6: the base formats against their patterns, the bootstrap, redaction, odd rows."""

import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import common, pii, queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=1000, deadline=None)
@given(st.text("ab.@-+19 05(_%é", max_size=50))
def test_base_formats(text):
    assert pii.base_spans(text) == brute(text)


def test_written_examples():
    text = "Ünï a.b+c@x-y.co.uk, 10.0.0.255 256.1.1.1, 4111 1111 1111 1111, 4111111111111112, +1 (650) 555-0100. x@y"
    assert pii.base_spans(text) == brute(text)
    assert [k for k, _, _ in pii.base_spans(text)] == ["email", "ip", "card", "phone"]


def test_long_texts_are_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "+1" + " " * 200_000):
        pii.base_spans(text)
        list(pii.candidates(text))


def test_spans_of_a_log_are_linear():
    line = 'user=ab12cd mail me{0}@example.com from 10.0.{1}.7 token="ff{0}aa99" '
    text = "".join(line.format(i, i % 250) for i in range(60_000))
    start = time.time()
    got = pii.spans(text, {"user =", "token ="})
    assert len(got) == 240_000 and time.time() - start < 30
    small = text[:20_000].rsplit(" ", 1)[0]
    base = pii.base_spans(small)
    assert pii.spans(small, {"token ="})[len(base):] == [
        ("id", a, b) for p, a, b in pii.candidates(small) if p == "token =" and not any(x < b and a < y for _, x, y in base)]


def test_nothing_is_cut_to_a_prefix():
    cue = "w" * 100
    assert [p for p, _, _ in pii.candidates(f"a {cue}=abc123")] == [f"{cue} ="]
    long = "ab1-" * 60
    assert pii.form(long) != pii.form(long + "/" + "ab1-") and pii.form("a" * 300) != pii.form("a" * 700)


def test_cues():
    for text, want in (("pass word = 'x", ("word", "=")), ("no  AB", ("no", "")), ("key:(", ("key", ":")), ("é_.-#", ("é_.-", "#")), ("= ", ("", "=")),
                       ("a=  ", ("", "")), ("", ("", ""))):
        cue = re.search(r"([\w.-]+)[ \t]?([=:#]?)[ \t]?[\"'(\[{]?\Z", text.removesuffix("x").removesuffix("AB"))
        assert pii.cue_before(text, len(text.removesuffix("x").removesuffix("AB"))) == ((cue[1], cue[2]) if cue else want)


def test_candidates():
    text = 'The password=abc123de, token = "77ffaa" and passport no AB12345; x1y2'
    got = [(p, text[a:b]) for p, a, b in pii.candidates(text)]
    assert got == [("password =", "abc123de"), ("token =", "77ffaa"), ("no ", "AB12345")]


def test_contexts_discover_unseen_identifiers(spark):
    seeds = [f"login {hashlib.md5(str(i).encode()).hexdigest()} secret={hashlib.md5(str(i).encode()).hexdigest()}" for i in range(40)]
    unseen = ["my secret=tiger2000 here", "secret=0000"]
    plain = [f"the year 19{i:02d} and the house 20{i:02d} of the king" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(seeds + unseen + plain)), "doc_id long, text string")
    patterns = pii.learn_patterns(df)
    assert "secret =" in patterns and not any(p.split()[0] in ("the", "year", "house", "of") for p in patterns)
    assert pii.redacted(unseen[0], pii.spans(unseen[0], patterns)) == "my secret=<ID> here"


def test_support_does_not_depend_on_the_size_of_the_table(spark):
    few = [(f"my secret={hashlib.md5(str(i).encode()).hexdigest()}",) for i in range(5)]
    df = spark.createDataFrame(few, "text string").unionByName(spark.range(900_000).selectExpr("'plain words' AS text"))
    assert "secret =" in pii.learn_patterns(df)


def test_a_document_counts_once_for_a_pattern(spark):
    many = " ".join(f"code 77{x}77{y}77" for x in "-_/+*&~%" for y in "-_/+*&~%") + " code" * 30
    own = {(p, pii.form(many[a:b])) for p, a, b in pii.candidates(many)}
    got = pii.occurrences(spark.createDataFrame([(many,)], "text string")).collect()
    assert len(own) == len(got) >= 50 and sum(r["docs"] for r in got) == 1 and sum(r["uses"] for r in got) == 30


def test_rows(spark):
    long = "word " * 40_000 + "me@example.com"
    rows = [(1, "a@b.c 1.2.3.4", "x"), (1, "a@b.c 1.2.3.4", "x"), (2, "", "x"), (3, None, "x"), (None, "+44 20 7946 0958", "x"), (4, long, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((tuple(r) for r in pii.find(df).collect()), key=str)
    want = []
    for i, t, _ in rows:
        b = brute(t or "")
        text = ",".join(f"{k}:{x}:{y}" for k, x, y in b)
        want.append((i, *(sum(s[0] == k for s in b) for k in PATTERNS), hashlib.sha256(text.encode()).hexdigest(), text, 0))
    assert got == sorted(want, key=str)
    out = {r["doc_id"]: r for r in pii.redact(df.withColumn("n_chars", df.doc_id), length_col="n_chars").collect()}
    assert out[1]["text"] == "<EMAIL> <IP>" and out[1]["n_chars"] == 12 and out[3]["text"] is None and out[2]["n_chars"] == 2
    assert out[1]["spans"] == "x"
    assert pii.find(df.limit(0)).count() == 0 and pii.redact(df.limit(0)).count() == 0


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in common.table(spark, sf, "documents").collect()}
    for r in queries.op6_pii(spark, sf).collect():
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["spans"].startswith(text)
