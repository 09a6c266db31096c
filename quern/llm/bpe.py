"""Operator 4, byte-level BPE encoding and decoding by DuckDB recursive queries in each task.

Spark cuts the texts into the pattern's pieces and deals the rows out; each
task holds a DuckDB connection with the merge table (every pair of tokens
whose bytes join to a token, ranked by that token) and works on the distinct
pieces of its batches:

- encode: one row per token position, starting from single bytes. A step of
  the recursive query joins neighbouring rows with the merge table, finds
  each piece's leftmost pair of least rank, and contracts it; a piece with
  no mergeable pair leaves the recursion, which ends when none is left.
- decode: the ids of a piece join the vocabulary and an ordered aggregate
  puts their bytes together again.

A piece is encoded apart from its neighbours, so the ids of a document are
its pieces' ids in order, whatever its length.

A long piece is cut into chunks that are encoded apart, all in one query. A cut
is right if no merge would ever cross it, and that shows on the two tokens at
the cut alone: merges inside a token do not depend on what stands beside it, so
the two tokens' bytes, encoded together, are these two tokens again just when
nothing crosses. Where a cut is wrong, a window of tokens around it is encoded
anew, a wider one each round, until all cuts are right; the work is local.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import byte_symbols, distinct_pieces, gather_ranges, row_sums, slices, tidied, token_pieces

# Bytes of distinct pieces in one recursive query, and pieces a worker process
# remembers between batches and tasks; both bound its memory.
QUERY_BYTES = 400_000
MEMORY_PIECES = 600_000
DUCKDB_MEMORY = "250MB"

ENCODE = """
WITH RECURSIVE step(k, w, g, e, id) AS (
    SELECT 0, w, g, g + 1, id FROM positions
    UNION ALL
    (WITH pairs AS (
        SELECT a.w, a.g, b.g AS q, b.e, m
        FROM step a JOIN step b ON b.g = a.e AND b.w = a.w JOIN merges ON pair = a.id * 65536 + b.id),
     hit AS (
        SELECT w, arg_min(g, first) AS g, arg_min(q, first) AS q, arg_min(e, first) AS e, arg_min(m, first) AS m
        FROM (SELECT *, (m << 32) + g AS first FROM pairs) GROUP BY w)
     SELECT s.k + 1, s.w, s.g, CASE WHEN s.g = h.g THEN h.e ELSE s.e END, CASE WHEN s.g = h.g THEN h.m ELSE s.id END
     FROM step s JOIN hit h ON s.w = h.w
     WHERE s.g <> h.q)
)
SELECT w, id FROM step JOIN (SELECT w, max(k) AS k FROM step GROUP BY w) USING (w, k) ORDER BY g
"""
# The same contraction for long pieces. All pairs of the least rank are
# contracted in one step where that equals doing them one by one from the
# left, that is, unless the merged token is part of a token of lower rank
# ("solo"); of overlapping pairs, every second one from the left. It stops
# after $steps steps, so that the rows it holds stay bounded, and is run
# again from where it stopped.
ENCODE_LONG = """
WITH RECURSIVE step(k, w, g, e, id) AS (
    SELECT 0, w, g, e, id FROM positions
    UNION ALL
    (WITH pairs AS (
        SELECT a.w, a.g, b.g AS q, b.e, m, solo
        FROM step a JOIN step b ON b.g = a.e AND b.w = a.w JOIN merges ON pair = a.id * 65536 + b.id
        WHERE a.k < $steps),
     least AS (
        SELECT *, row_number() OVER (PARTITION BY w ORDER BY g) AS n,
               coalesce(lag(q) OVER (PARTITION BY w ORDER BY g) = g, false) AS chained
        FROM pairs JOIN (SELECT w, min(m) AS m FROM pairs GROUP BY w) USING (w, m)),
     hit AS (
        SELECT * FROM (SELECT *, max(CASE WHEN NOT chained THEN n END) OVER (PARTITION BY w ORDER BY g) AS n0 FROM least)
        WHERE (n - n0) % 2 = 0 AND (n = 1 OR NOT solo))
     SELECT s.k + 1, s.w, s.g, coalesce(h.e, s.e), coalesce(h.m, s.id)
     FROM step s LEFT JOIN hit h ON s.g = h.g
     WHERE s.w IN (SELECT w FROM hit) AND s.g NOT IN (SELECT q FROM hit))
)
SELECT k, w, g, e, id FROM step JOIN (SELECT w, max(k) AS k FROM step GROUP BY w) USING (w, k) ORDER BY g
"""
LONG_PIECE = 64           # bytes of a piece, or of a window in one, that ENCODE takes
CHUNK = 40                # bytes of a long piece that are first encoded together
LONG_ROWS = 2_000_000     # rows that one run of ENCODE_LONG may hold
DECODE = """
SELECT w, string_agg(s, '' ORDER BY p) AS s FROM ids JOIN vocabulary USING (id) GROUP BY w ORDER BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Coder:
    """A DuckDB connection that encodes and decodes pieces under one set of ranks (ids below 65,536)."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        if max(ranks.values()) >= 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ids must be below 65536 and every byte a token")
        self.ranks = ranks
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.length = {r: len(t) for t, r in ranks.items()}
        # Pieces met: their ids, two bytes each; and what these decode to, where that is not the piece again.
        self.known: dict[bytes, bytes] = {}
        self.other: dict[bytes, bytes] = {}
        symbols = byte_symbols()
        self.to_byte = {c: b for b, c in symbols.items()}
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        solo = {part for a, b, m in pairs for part in (a, b) if part > m}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""})
        self._load("merges", pa.table({"pair": pa.array([a * 65536 + b for a, b, _ in pairs], pa.int64()),
                                       "m": pa.array([m for _, _, m in pairs], pa.int64()),
                                       "solo": pa.array([m in solo for _, _, m in pairs])}))
        self._load("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int64()),
                                           "s": ["".join(symbols[b] for b in t) for t in ranks]}))

    def _load(self, name: str, rows: pa.Table) -> None:
        self.con.register("incoming", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def _run(self, sql: str, name: str, rows: dict[str, np.ndarray]) -> pa.Table:
        self.con.register(name, pa.table(rows))
        try:
            return self.con.execute(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece (a piece that is a token is that token)."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        some, size, long = [], 0, []
        for i, piece in enumerate(pieces):
            if not piece or piece in self.ranks:
                out[i] = np.array([self.ranks[piece]] if piece else [], "<u4")
                continue
            if len(piece) > LONG_PIECE:
                long.append(i)
                continue
            some.append(i)
            size += len(piece)
            if size >= QUERY_BYTES:
                self._contract(pieces, some, out)
                some, size = [], 0
        if some:
            self._contract(pieces, some, out)
        for i, ids in zip(long, self._encode_long([pieces[i] for i in long]) if long else [], strict=True):
            out[i] = ids
        return out

    def _contract(self, pieces: list[bytes], some: list[int], out: list) -> None:
        length = np.array([len(pieces[i]) for i in some])
        raw = np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)
        done = self._run(ENCODE, "positions", {
            "w": np.repeat(np.arange(len(some), dtype=np.int32), length),
            "g": np.arange(len(raw), dtype=np.int32), "id": self.bytes_ids[raw]})
        ids = done.column("id").to_numpy().astype("<u4")
        cuts = np.searchsorted(done.column("w").to_numpy(), np.arange(1, len(some)))
        for i, own in zip(some, np.split(ids, cuts), strict=True):
            out[i] = own.copy()  # not a view that keeps the whole query's result

    def _merged(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of each of some byte strings, by merges alone (one that is a token is not looked up)."""
        out: list[np.ndarray | None] = [None] * len(parts)
        some, size = [], 0
        for i, part in enumerate(parts):
            if len(part) > LONG_PIECE:
                out[i] = self._contract_long(part)
                continue
            some.append(i)
            size += len(part)
            if size >= QUERY_BYTES:
                self._contract(parts, some, out)
                some, size = [], 0
        if some:
            self._contract(parts, some, out)
        return out

    def _encode_long(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of long pieces, from chunks whose cuts are mended until all are right; a round is one query for all pieces."""
        def split(start: int, ids: np.ndarray) -> list[tuple[int, int]]:
            ends = start + np.cumsum([self.length[t] for t in ids.tolist()])
            return list(zip([start, *ends[:-1].tolist()], ids.tolist(), strict=True))

        # Tokens as (start, id); ``cuts`` are the places among them that are not yet known to be right.
        starts = [range(0, len(p), CHUNK) for p in pieces]
        found = iter(self._merged([p[a:a + CHUNK] for p, own in zip(pieces, starts, strict=True) for a in own]))
        tokens = [[t for a in own for t in split(a, next(found))] for own in starts]
        cuts, reach = [set(own[1:]) for own in starts], 2
        checked: dict[tuple[int, int], bool] = {}
        while any(cuts):
            todo = [p for p, own in enumerate(cuts) if own]

            def end(p: int, i: int) -> int:
                return tokens[p][i + 1][0] if i + 1 < len(tokens[p]) else len(pieces[p])

            places, pairs = {}, {}
            for p in todo:
                at = {a: i for i, (a, _) in enumerate(tokens[p])}
                places[p] = sorted(at[c] for c in cuts[p])
                for i in places[p]:
                    pair = tokens[p][i - 1][1], tokens[p][i][1]
                    if pair not in checked:
                        pairs[pair] = pieces[p][tokens[p][i - 1][0]:end(p, i)]
            checked.update((pair, tuple(ids.tolist()) == pair) for pair, ids in zip(pairs, self._merged(list(pairs.values())), strict=True))
            windows: dict[int, list[list[int]]] = {}           # of tokens, first and past the last; those that meet are one
            for p in todo:
                own = windows[p] = []
                for i in places[p]:
                    if checked[tokens[p][i - 1][1], tokens[p][i][1]]:
                        continue
                    a, b = max(0, i - reach), min(len(tokens[p]), i + reach)
                    if own and a <= own[-1][1]:
                        own[-1][1] = b
                    else:
                        own.append([a, b])
            found = iter(self._merged([pieces[p][tokens[p][a][0]:end(p, b - 1)] for p in todo for a, b in windows[p]]))
            for p in todo:
                out, done, cuts[p] = [], 0, set()
                for a, b in windows[p]:
                    out += tokens[p][done:a] + split(tokens[p][a][0], next(found))
                    cuts[p] |= {c for c in (tokens[p][a][0], end(p, b - 1)) if 0 < c < len(pieces[p])}
                    done = b
                tokens[p] = out + tokens[p][done:]
            reach *= 2
        return [np.array([t for _, t in own], "<u4") for own in tokens]

    def _contract_long(self, piece: bytes) -> np.ndarray:
        n = len(piece)
        state = {"w": np.zeros(n, np.int32), "g": np.arange(n), "e": np.arange(1, n + 1),
                 "id": self.bytes_ids[np.frombuffer(piece, np.uint8)]}
        while True:
            steps = max(1, LONG_ROWS // len(state["g"]))
            done = self._run(ENCODE_LONG.replace("$steps", str(steps)), "positions", state)
            state = {c: done.column(c).to_numpy() for c in state}
            if done.column("k")[0].as_py() < steps:
                return state["id"].astype("<u4")

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id sequence."""
        out = [b""] * len(ids)
        length = np.array([len(x) for x in ids], np.int64)
        start = 0
        while start < len(ids):  # as many sequences as make a bounded query, or one
            stop = max(start + 1, int(np.searchsorted(np.cumsum(length[start:]), QUERY_BYTES, side="right")) + start)
            own = length[start:stop]
            flat = np.concatenate(ids[start:stop]).astype(np.int64)
            done = self._run(DECODE, "ids", {"w": np.repeat(np.arange(start, stop), own), "p": np.arange(len(flat)), "id": flat})
            for w, s in zip(done.column("w").to_pylist(), done.column("s").to_pylist(), strict=True):
                out[w] = bytes(map(self.to_byte.__getitem__, s))
            start = stop
        return out


_coder: tuple[str, Coder] | None = None  # this worker process's


def _task_coder(key: str, ranks) -> Coder:
    """The worker's coder for the broadcast ``ranks``, made once for each ``key``."""
    global _coder
    if _coder is None or _coder[0] != key:
        _coder = key, Coder(ranks.value)
    return _coder[1]


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``ids`` (int array) and ``decoded`` (the ids' bytes, decoded again).

    NULL and empty texts have no ids and decode to no bytes. Repeated rows
    and NULL ids give a row each; other columns are not read; a text or a
    piece of any length is encoded whole.
    """
    return _coded(docs, ranks, id_col, text_col, digests=False)


def digests(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_and_decode`` reduced in the tasks to ``n_tokens`` and the two SHA-256 digests."""
    return _coded(docs, ranks, id_col, text_col, digests=True)


def _coded(docs: DataFrame, ranks: dict[bytes, int], id_col: str, text_col: str, digests: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _task_coder(key, shared)
        known, other = coder.known, coder.other
        for batch in slices(batches, "_pieces"):
            distinct, index, bounds = distinct_pieces(batch.column(1))
            strings = distinct.cast(pa.binary()).to_pylist()
            if len(known) > MEMORY_PIECES:
                known.clear()
                other.clear()
            new = [s for s in strings if s not in known]
            new_ids = coder.encode(new)
            known.update((s, own.astype("<u2").tobytes()) for s, own in zip(new, new_ids, strict=True))
            other.update((s, d) for s, d in zip(new, coder.decode(new_ids), strict=True) if s != d)
            each = [known[s] for s in strings]
            size = np.fromiter(map(len, each), np.int64, len(each)) // 2
            flat = np.frombuffer(b"".join(each), "<u2").astype("<u4")
            ids = gather_ranges(flat, (np.cumsum(size) - size)[index], size[index])
            ends = np.concatenate([[0], np.cumsum(row_sums(size[index], bounds))])
            decoded = [other.get(s, s) for s in strings] if other else strings
            index, rows, texts = index.tolist(), [], []
            for i in range(len(bounds) - 1):
                own = ids[ends[i]:ends[i + 1]].astype("<u4").tobytes()
                text = b"".join(map(decoded.__getitem__, index[bounds[i]:bounds[i + 1]]))
                rows.append(hashlib.sha256(own).hexdigest() if digests else np.frombuffer(own, "<u4").astype(np.int32))
                texts.append(hashlib.sha256(text).hexdigest() if digests else text)
            if digests:
                columns = [pa.array(np.diff(ends)), pa.array(rows, pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                columns = [pa.array(rows, pa.list_(pa.int32())), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "ids", "decoded"])

    cut = docs.select(docs[id_col], token_pieces(docs[text_col]).alias("_pieces"))
    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    return cut.mapInArrow(tidied(run), f"`{id_col}` {id_type.simpleString()}, {more}")
