"""Operator 12, runs: stretches of words that repeat with a period, by a difference cover and a harmonic grid.

Texts are worked on as arrays of word ids, many texts of a task in one array
with a separator of its own between any two, so that no match leaves a text.

* **Longest common extensions.** A difference cover modulo 31 samples 6 of 31
  positions, such that for any two positions some shift under 31 takes both to
  samples. Only the sampled suffixes are sorted (by their next 31 words, then
  by doubling, each time only those that still tie), with a sparse table of
  minima over their common prefixes. An extension compares at most 30 words
  one by one until both places are samples, and one range minimum does the rest.
* **Grid.** A run of period q and length 4q or more holds at least 3q places i
  with word i equal to word i + q, so one of them is a multiple of 3q. Every
  multiple of 3q of every q up to a quarter of the text is tried: words i and
  i + q are compared, and where they agree the extensions forwards and
  backwards give the maximal stretch. That is about (n / 3) ln n comparisons.
* A stretch found with several periods has the smallest as its period: it is
  at least four times any of them, so the smallest divides them all and its
  own maximal stretch is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import distinct_pieces, row_ranges, slices

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
# Words of texts worked on together (a longer text alone), and grid places at once; both bound memory only.
GROUP_WORDS, GRID_PLACES = 400_000, 1_000_000

# A perfect difference set (every remainder but 0 is one difference of its members).
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)

# Fixed value: the words of a text.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def _shifts() -> np.ndarray:
    """``[a, b]``: the least shift that takes remainders a and b both into the cover."""
    return np.array([[next(s for s in range(MODULUS) if (a + s) % MODULUS in COVER and (b + s) % MODULUS in COVER)
                      for b in range(MODULUS)] for a in range(MODULUS)])


SHIFTS = _shifts()


def refined(names: np.ndarray, tied: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``names`` with the elements ``tied`` also ordered by ``keys`` (one for each), and those that still tie.

    An element's name is the number of elements that come before its group,
    so splitting a group changes no other group's names.
    """
    if len(tied) == 0:
        return names, tied
    order = np.lexsort((keys, names[tied]))
    old, key = names[tied[order]], keys[order]
    at = np.arange(len(order))
    group = np.concatenate([[True], old[1:] != old[:-1]])
    part = group | np.concatenate([[True], key[1:] != key[:-1]])
    first_of_group = np.maximum.accumulate(np.where(group, at, 0))
    first_of_part = np.maximum.accumulate(np.where(part, at, 0))
    out = names.copy()
    out[tied[order]] = old + (first_of_part - first_of_group)
    alone = part & np.concatenate([part[1:], [True]])
    return out, tied[order[~alone]]


class Extensions:
    """Longest common extensions in ``words``, positive ids whose last is found nowhere else."""

    def __init__(self, words: np.ndarray) -> None:
        self.size = len(words)
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, np.int64)])
        chains = [np.arange(d, self.size, MODULUS) for d in COVER]   # a place's successor in its chain is 31 words on
        place = np.concatenate(chains)
        base = np.full(MODULUS, -1)
        base[list(COVER)] = np.concatenate([[0], np.cumsum([len(c) for c in chains])[:-1]])
        self.base = base
        names, tied = np.zeros(len(place), np.int64), np.arange(len(place))
        for d in range(0, MODULUS, 2):
            second = self.words[place[tied] + d + 1] if d + 1 < MODULUS else 0
            names, tied = refined(names, tied, (self.words[place[tied] + d] << 32) | second)
        # A block that reaches a chain's end holds the last word, so it is alone and nothing looks past it.
        levels = [names]
        while len(tied):
            ahead = np.minimum(tied + (1 << (len(levels) - 1)), len(place) - 1)
            names, tied = refined(names, tied, names[ahead])
            levels.append(names)
        self.rank = names
        order = np.empty(len(place), np.int64)
        order[names] = np.arange(len(place))
        self.minima = self._minima(self._common(levels, place, order))

    def _common(self, levels: list[np.ndarray], place: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Words that each sorted sample shares with the one before it (the first: 0)."""
        a, b = order[:-1].copy(), order[1:].copy()
        blocks = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            equal = levels[k][a] == levels[k][b]
            step = np.where(equal, 1 << k, 0)
            a, b, blocks = a + step, b + step, blocks + step
        x, y = place[a], place[b]
        return np.concatenate([[0], blocks * MODULUS + self._direct(x, y, np.full(len(x), MODULUS))]).astype(np.int32)

    def _direct(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Equal words from places x and y on, compared one by one, up to ``limit``."""
        out = np.zeros(len(x), np.int64)
        left = np.flatnonzero(limit > 0)
        for d in range(MODULUS):
            left = left[(self.words[x[left] + d] == self.words[y[left] + d])]
            out[left] += 1
            left = left[limit[left] > d + 1]
            if len(left) == 0:
                break
        return out

    @staticmethod
    def _minima(common: np.ndarray) -> np.ndarray:
        """Row j: the least of 2^j entries from each place on."""
        rows = [common]
        while 1 << len(rows) <= len(common):
            last, step = rows[-1], 1 << (len(rows) - 1)
            rows.append(np.concatenate([np.minimum(last[:-step], last[step:]), last[-step:]]))
        return np.stack(rows)

    def _sample(self, at: np.ndarray) -> np.ndarray:
        return self.rank[self.base[at % MODULUS] + at // MODULUS]

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The equal words from places x and y on (x and y differ)."""
        shift = SHIFTS[x % MODULUS, y % MODULUS]
        out = self._direct(x, y, shift)
        far = np.flatnonzero(out == shift)
        if len(far):
            a, b = self._sample(x[far] + shift[far]), self._sample(y[far] + shift[far])
            low, high = np.minimum(a, b) + 1, np.maximum(a, b)
            row = np.log2(high - low + 1).astype(np.int64)
            out[far] += np.minimum(self.minima[row, low], self.minima[row, high - (1 << row) + 1])
        return out


def grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text, place, period)`` of every grid place of texts of these sizes, about ``GRID_PLACES`` at a time."""
    text = np.repeat(np.arange(len(sizes)), sizes // LEAST_EXPONENT)
    first = np.concatenate([[0], np.cumsum(sizes // LEAST_EXPONENT)[:-1]])
    period = np.arange(len(text)) - first[text] + 1
    places = -(-(sizes[text] - period) // (3 * period))
    ends = np.cumsum(places)
    start = 0
    while start < len(text):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + GRID_PLACES, side="right")))
        number = places[start:stop]
        step = np.arange(int(number.sum())) - np.repeat(np.concatenate([[0], np.cumsum(number)[:-1]]), number)
        q = np.repeat(period[start:stop], number)
        yield np.repeat(text[start:stop], number), step * 3 * q, q
        start = stop


def _smallest_periods(found: np.ndarray) -> np.ndarray:
    """Rows (text, start, end, period), sorted, each stretch once with its smallest period."""
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    return found[new]


def runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Every run of texts of word ids (from 0, one after another): rows (text, start, end, period).

    Sorted by text, start, then period; end is exclusive.
    """
    sizes = np.asarray(sizes, np.int64)
    out = [np.empty((0, 4), np.int64)]
    if sizes.sum():
        top = int(words.max()) + 2
        line = np.empty(len(words) + len(sizes) + 1, np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])         # the separators' places
        line[bounds] = top + np.arange(len(bounds))
        own = np.ones(len(line), bool)
        own[bounds] = False
        line[own] = np.asarray(words, np.int64) + 1
        forwards, backwards, last = Extensions(line), Extensions(line[::-1]), len(line) - 1
        for text, place, q in grid(sizes):
            at = bounds[text] + 1 + place
            met = np.flatnonzero(line[at] == line[at + q])
            text, at, q = text[met], at[met], q[met]
            start = at - backwards(last - at + 1 - q, last - at + 1)
            end = at + q + forwards(at, at + q)
            good = np.flatnonzero(end - start >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q))
            shift = bounds[text[good]] + 1
            out.append(_smallest_periods(np.stack([text[good], start[good] - shift, end[good] - shift, q[good]], axis=1)))
    found = _smallest_periods(np.concatenate(out))
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def words(text: str | Column) -> Column:
    """The words of a text: runs between blanks, tabs, line feeds and other ASCII white space (NULL: none)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def find(docs: DataFrame, id_col: str = "doc_id", words_col: str = "words") -> DataFrame:
    """Per row: its id, ``runs``, an array of structs (start, length, period), and ``collapsed``.

    A run is a stretch of words whose smallest period q repeats at least four
    times and that is six words or longer, as long as its period holds; starts
    count words from 0. ``collapsed`` joins by one blank the words that no run
    contains after its first q. A NULL or empty array of words has no runs and
    an empty text; a NULL word is an empty one; repeated rows and NULL ids
    give a row each; texts of any length are worked on whole; other columns
    are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = [pa.field(k, pa.int64()) for k in ("start", "length", "period")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, words_col):
            distinct, index, bounds = distinct_pieces(batch.column(1))
            for a, b in row_ranges(np.diff(bounds), GROUP_WORDS):
                own = index[bounds[a]:bounds[b]]
                sizes = np.diff(bounds[a:b + 1])
                found = runs(own, sizes)
                # Words after a run's first period: +1 where such a range begins, -1 where it ends.
                first = np.concatenate([[0], np.cumsum(sizes)])
                depth = np.zeros(len(own) + 1, np.int64)
                np.add.at(depth, first[found[:, 0]] + found[:, 1] + found[:, 3], 1)
                np.add.at(depth, first[found[:, 0]] + found[:, 2], -1)
                kept = np.cumsum(depth[:-1]) == 0
                ends = np.concatenate([[0], np.cumsum(kept)])[first]
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), distinct.take(pa.array(own[kept]))), " ")
                at = np.concatenate([[0], np.cumsum(np.bincount(found[:, 0], minlength=b - a))])
                cols = [pa.array(c) for c in (found[:, 1], found[:, 2] - found[:, 1], found[:, 3])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(cols, fields=fields)), texts],
                    names=[id_col, "runs", "collapsed"])

    every = F.transform(F.coalesce(docs[words_col], F.array().cast("array<string>")), lambda w: F.coalesce(w, F.lit("")))
    return docs.select(docs[id_col], every.alias(words_col)).mapInArrow(
        run, f"`{id_col}` {id_type}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def summary(found: Column, collapsed: Column) -> dict[str, Column]:
    """Columns over ``runs`` and ``collapsed``: the number of runs, the longest run, and two digests."""
    ordered = F.array_max(F.transform(found, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(found, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return {"n_runs": F.size(found).cast("long"), "start": -ordered["start"], "length": ordered["length"],
            "period": -ordered["period"],
            "exponent_milli": F.call_function("div", 1000 * ordered["length"], -ordered["period"]),
            "runs_sha256": F.sha2(F.array_join(lines, ""), 256), "collapsed_sha256": F.sha2(collapsed, 256)}
