"""Operator 7: the plan against a bin-by-bin model, and whole documents against the tokenizer."""

import json
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quern.llm import packing

JSON = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


def laid_out(counts, capacity):
    """Bins as {bin: [(offset, length)]} from the plan, each rank used once."""
    slots, n_bins = packing.plan(counts, capacity)
    bins = {}
    ranks = {n: [] for n in counts}
    for s in slots:
        for i in range(s.count):
            ranks[s.length].append(s.rank + i)
            bins.setdefault(s.bin + i // s.per_bin, []).append((s.offset + i % s.per_bin * s.length, s.length))
    assert all(sorted(r) == list(range(counts[n])) for n, r in ranks.items())
    assert sorted(bins) == list(range(n_bins))
    return bins


def model(counts, capacity):
    """The same rules item by item."""
    items = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    large, small = [n for n in items if 3 * n > capacity], [n for n in items if 3 * n <= capacity]
    gaps = []
    while large:
        a = large.pop(0)
        b = next((x for x in large if x + a <= capacity), None)
        if b is not None:
            large.remove(b)
        gaps.append(capacity - a - (b or 0))
    for n in small:
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - n)
    return len(gaps), sorted(gaps)


@settings(max_examples=300, deadline=None)
@given(st.integers(3, 60).flatmap(lambda c: st.tuples(
    st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30), max_size=12))))
def test_plan_is_the_item_by_item_result(case):
    capacity, counts = case
    bins = laid_out(counts, capacity)
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == np.cumsum([0] + [n for _, n in placed])[:-1].tolist()
        assert sum(n for _, n in placed) <= capacity
        assert sum(3 * n > capacity for _, n in placed) <= 2
    n, gaps = model(counts, capacity)
    assert len(bins) == n
    assert sorted(capacity - sum(x for _, x in p) for p in bins.values()) == gaps


def test_pack(spark):
    tok = Tokenizer.from_str(JSON)
    tok.encode_special_tokens = True
    texts = ["", None, "one <|endoftext|> two", "word " * 5000, "a" * 9000, "same", "same", "b c d " * 200]
    rows = [(i if t != "same" else 9, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = [r.asDict() for r in packing.pack(df, JSON, 64).collect()]
    want = []
    for i, t, _ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 64 or 64
        cuts = [0, *range(head, len(ids) + 1, 64)] if len(ids) > 64 else [0, len(ids)]
        want += [(str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == np.cumsum([0] + [n for _, n in placed])[:-1].tolist()
        assert sum(n for _, n in placed) <= 64
    assert len(bins) <= sum(n for p in bins.values() for _, n in p) / 64 + 1


def test_added_tokens_get_their_own_ids(spark):
    tok = Tokenizer.from_str(JSON)
    assert tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "end <|endoftext|", "  <|endoftext|>\n", None, "",
             "<|endoftext|>'s 12<|endoftext|>3 é<|endoftext|>", "no token " * 50, "w <|endoftext|> " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packing.pack(df, JSON, 512, added_tokens=True).collect())
    want = []
    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 512 or 512, len(ids) + 1, 512)] if len(ids) > 512 else [0, len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert got == want


def test_two_added_tokens_of_which_one_begins_the_other(spark):
    spec = json.loads(JSON)
    plain = spec["added_tokens"][0]
    spec["added_tokens"] += [{**plain, "id": 50257, "content": "<|end"}, {**plain, "id": 50258, "content": "[x].*"}]
    tok = Tokenizer.from_str(json.dumps(spec))
    df = spark.createDataFrame([(1, "a<|end b<|endoftext|>[x].*c [x] <|endo")], "doc_id long, text string")
    got = packing.pack(df, json.dumps(spec), added_tokens=True).first()
    ids = [*tok.encode(df.first().text, add_special_tokens=False).ids, 0]
    assert (got.length, got.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, JSON).count() == 0
