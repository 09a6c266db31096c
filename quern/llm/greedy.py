"""Operator 1, token counts: greedy longest-match word pieces counted by a linear automaton.

The vocabulary's tokens form a byte trie. Every node v carries a failure
link and a popped-token count: when the next byte has no edge out of v, the
greedy matcher emits ``pops[v]`` tokens and goes on in ``fail[v]``, the node
of what those tokens leave over. Each byte moves the automaton forward once
and each failure pops at least one token, so a text is counted in linear
time, and no piece is ever built.

The automaton is built on the driver from the vocabulary alone (its size
does not depend on the data) and broadcast as four integer arrays. Texts are
cut into pieces by Spark; each Arrow batch runs all its distinct pieces
through the automaton together, one byte position at a time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import distinct_pieces, row_sums, slices, token_pieces


class Automaton(NamedTuple):
    keys: np.ndarray    # sorted: node * 256 + byte, one per trie edge
    child: np.ndarray   # node that the edge leads to
    root: np.ndarray    # the root's child for each byte
    fail: np.ndarray    # failure link; the root's own is the root
    pops: np.ndarray    # tokens emitted when the failure link is taken
    drain: np.ndarray   # tokens in the greedy cover of the node's whole string


def build_automaton(vocabulary: Iterable[bytes]) -> Automaton:
    """The automaton of a vocabulary that holds all 256 single bytes (so that no text is uncoverable)."""
    edges: list[dict[int, int]] = [{}]
    final = [False]
    for token in vocabulary:
        node = 0
        for byte in token:
            nxt = edges[node].get(byte)
            if nxt is None:
                nxt = edges[node][byte] = len(edges)
                edges.append({})
                final.append(False)
            node = nxt
        final[node] = node != 0
    missing = [b for b in range(256) if b not in edges[0] or not final[edges[0][b]]]
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    n = len(edges)
    fail, pops, drain = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    queue = deque([0])
    while queue:  # breadth first: a failure link leads to a shallower node
        u = queue.popleft()
        for byte, v in edges[u].items():
            if final[v]:
                fail[v], pops[v] = 0, 1
            else:
                # Follow the parent's links until the byte can be read; a node
                # that is no token is never the root's child, so this ends.
                z, popped = int(fail[u]), int(pops[u])
                while byte not in edges[z]:
                    popped += int(pops[z])
                    z = int(fail[z])
                fail[v], pops[v] = edges[z][byte], popped
            drain[v] = pops[v] + drain[fail[v]]
            queue.append(v)
    flat = sorted((u * 256 + byte, v) for u, out in enumerate(edges) for byte, v in out.items())
    keys, child = np.array([k for k, _ in flat], np.int64), np.array([v for _, v in flat], np.int32)
    root = np.array([edges[0][b] for b in range(256)], np.int32)
    return Automaton(keys, child, root, fail, pops, drain)


def piece_counts(auto: Automaton, strings: pa.Array) -> np.ndarray:
    """Greedy token count of each string, all strings moved forward together byte by byte."""
    strings = strings.cast(pa.large_binary())
    n = len(strings)
    _, offsets, data = strings.buffers()
    off = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    length = np.diff(off)
    state, count = np.zeros(n, np.int32), np.zeros(n, np.int64)
    order = np.argsort(-length, kind="stable")
    sorted_len = -length[order]
    for j in range(int(length.max()) if n else 0):
        active = order[:np.searchsorted(sorted_len, -j, side="left")]  # longer than j
        byte = raw[off[active] + j].astype(np.int64)
        at, todo, read = state[active], np.arange(len(active)), np.empty(len(active), np.int32)
        while len(todo):
            here = at[todo]
            key = here.astype(np.int64) * 256 + byte[todo]
            pos = np.minimum(np.searchsorted(auto.keys, key), len(auto.keys) - 1)
            found = auto.keys[pos] == key
            read[todo[found]] = auto.child[pos[found]]
            todo, here = todo[~found], here[~found]
            count[active[todo]] += auto.pops[here]
            at[todo] = auto.fail[here]
        state[active] = read
    return count + auto.drain[state]


def token_counts(docs: DataFrame, vocabulary: Iterable[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_pieces`` (pattern pieces) and ``n_tokens`` (greedy tokens in them).

    A piece keeps its leading space, so a token that begins with a space
    starts a word and every other token continues one. NULL and empty texts
    have 0 of both; repeated rows give one row each; a NULL id is kept; other
    columns are not read. A piece of any length is matched whole.
    """
    auto = docs.sparkSession.sparkContext.broadcast(build_automaton(vocabulary))
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_pieces"):
            distinct, index, bounds = distinct_pieces(batch.column(1))
            each = piece_counts(auto.value, distinct)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.array(row_sums(each[index], bounds))],
                names=[id_col, "n_pieces", "n_tokens"])

    cut = docs.select(docs[id_col], token_pieces(docs[text_col]).alias("_pieces"))
    return cut.mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, n_pieces long, n_tokens long")
