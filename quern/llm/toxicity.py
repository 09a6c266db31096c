"""Operator 8, toxicity: a subsequence string-kernel machine with Nyström landmarks.

Two strings are alike in the subsequence kernel by the common subsequences
of three characters they hold, each weighted down by how far it is spread;
so a word with letters inserted, doubled, or set apart stays close to the
word. A bounded sample of labelled documents is cut into sentences: those of
clean documents are clean, those of toxic documents that hold a word (or one
with a beginning) far commoner in toxic documents are toxic (the others have
no label). Landmarks are the commonest such words and common clean words; each string becomes its
kernel values with the landmarks, whitened (Nyström), and a linear
hinge-loss model is trained on the strings of the labelled sentences, with
gapped and inserted-character variants of the toxic ones. Words that many
toxic documents hold and no clean one tell by themselves: a second model of
these and their variants, on values that fall slowly with letters inserted,
has a curve of its own, and a string takes the worse of its two scores. A
document scores as its worst string, or as a whole: words that clean documents
hold now and then tell by how many of them there are. For these a third model
is trained on whole documents, on the mean of their strings' kernel values with
beginnings of words that are far more frequent in toxic documents. Tasks score
each distinct word of a batch once.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import SLICE_CHARS, distinct_pieces, row_ranges, tidied
from quern.llm.learn import Rows, calibrate, dual_coordinate_descent, fold, labelled, sigmoid

TRAIN_ROWS = 1200         # labelled documents of each class that training reads, at most
TRAIN_CHARS = 20_000      # longer labelled documents are not read for training
TOXIC_LANDMARKS, CLEAN_LANDMARKS, CLEAN_STRINGS = 112, 64, 5000
ORDER, DECAY, POWER = 3, 0.75, 3
COST = 50.0
SURE_SHARE = 0.1          # of the toxic documents' number: words after so many different words have features of their own
INSERTED = 6              # variants of such a word with a letter inserted
STEMS = (4, 5, 6)         # lengths of word beginnings that can tell a toxic document
LEAST_CONTEXTS = 5        # a telling word or stem stands after at least so many different words
LEAST_RATIO = 2.5         # log ratio of toxic to clean documents that hold it
BEGINNINGS = (3, 4, 5, 6, 7)  # lengths of word beginnings whose share of a document's words can tell
SHARE_LANDMARKS = 32      # such beginnings, at most
LEAST_GAIN = 0.02         # of the most telling one's share of all words: with less, a beginning is left out
SHARE_RATIO = 1.5         # log ratio of their shares of the words of toxic and clean documents
MOST_SHARE = 0.05         # of one document's words counts for that ratio, so that a few documents do not make it
FEW_WORDS = 50            # added to a document's number of words: one word of a short text is not a share
SHARPNESS = 8             # power of a kernel value against the beginning's own
START = "^"               # the start of a word, as a character
WIDTH = 24                # characters of a string; longer ones become overlapping windows
LETTERS_SHARED = 0.8      # of a landmark's characters; with fewer its kernel value is 0
MEMORY_WORDS = 250_000    # words whose score a task remembers
# Fixed value: Unicode's white space, in the notation of Arrow's expressions.
WHITE_SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
# Characters commonly written for a letter.
LOOKALIKE = str.maketrans("013457@$", "oieastas")


def normal(word: str) -> str:
    """Lower case, without marks, and with letters for the digits and signs written for them."""
    w = word.lower()
    if w.isalpha():
        return w
    w = w.strip(".,;:!?\"'()[]{}<>*_~-|&%#")
    if any(c.isalpha() for c in w):
        w = w.translate(LOOKALIKE)
    return re.sub(r"[\W_]", "", w)


def windows(word: str) -> list[str]:
    """The word, or overlapping windows of a long one."""
    if len(word) <= WIDTH:
        return [word]
    return [word[i:i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def _symbols(strings: list[str]) -> np.ndarray:
    """Characters as small integers, one row a string: 0 none, 1-26 letters, 27 and on others."""
    code = np.array(strings, f"<U{WIDTH}").view(np.uint32).reshape(len(strings), WIDTH).astype(np.int64)
    letter = (code >= 97) & (code < 123)
    return np.where(letter, code - 96, np.where(code > 0, code + 27, 0))


def _letter_counts(symbols: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """How often each symbol of the ascending ``alphabet`` stands in each row; other symbols are not counted."""
    counts = np.zeros((len(symbols), len(alphabet) + 1), np.int8)
    rows = np.arange(len(symbols))
    for j in range(symbols.shape[1]):
        s = symbols[:, j]
        at = np.minimum(np.searchsorted(alphabet, s), len(alphabet) - 1)
        counts[rows, np.where(alphabet[at] == s, at, len(alphabet))] += 1
    return counts[:, :-1]


def _before(k: np.ndarray) -> np.ndarray:
    """For each first index the sum over smaller ones, each weighted down by how far before it stands."""
    out = np.zeros_like(k)
    for i in range(1, len(k)):
        out[i] = (out[i - 1] + k[i - 1]) * np.float32(DECAY)
    return out


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Subsequence kernel of order three of each row pair of two symbol matrices."""
    out = np.empty(len(s))
    order = np.lexsort(((t > 0).sum(axis=1), (s > 0).sum(axis=1)))  # pairs of like lengths together
    for a in range(0, len(s), 1024):
        own = order[a:a + 1024]
        x, y = s[own].T, t[own].T
        x, y = x[:max(1, int((x > 0).any(axis=1).sum()))], y[:max(1, int((y > 0).any(axis=1).sum()))]
        match = ((x[:, None] == y[None]) & (x[:, None] > 0)).astype(np.float32)
        k = match * np.float32(DECAY ** 2)
        for _ in range(ORDER - 1):
            k = match * _before(_before(k).swapaxes(0, 1)).swapaxes(0, 1)
        out[own] = k.sum(axis=(0, 1))
    return out


class Landmarks:
    """Landmark strings, and the normalised kernel of other strings with them.

    The first ``sure`` of them are words that tell by themselves: strings have
    three more values with each of these, the kernel as it is, the kernel
    against the landmark's own (how much of the landmark a string holds,
    however long it is), and their product. They fall slowly with letters
    inserted, where a power of the kernel falls fast.
    """

    def __init__(self, strings: list[str], sure: int = 0):
        self.sure = sure
        self.symbols = _symbols(strings)
        # The landmarks' own symbols, of any script; not 26 letters.
        self.alphabet = np.unique(np.append(self.symbols[self.symbols > 0], 1))
        self.counts = _letter_counts(self.symbols, self.alphabet)
        self.holders = [np.flatnonzero(c) for c in self.counts.T]
        self.need = np.maximum(ORDER, np.ceil(LETTERS_SHARED * self.counts.sum(axis=1)))
        self.own = np.sqrt(np.maximum(kernel(self.symbols, self.symbols), 1e-12))

    def values(self, strings: list[str]) -> np.ndarray:
        """One row a string: a power of its normalised kernel with each landmark, 0 where too few characters are shared, and
        the three values with each sure one."""
        rows, values = self.near(strings)
        out = np.zeros((len(strings), values.shape[1]))
        out[rows] = values
        return out

    def near(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The strings, by number, that share enough with a landmark, and their values; all others' are 0."""
        if not len(self.symbols) or not strings:
            return np.zeros(0, np.int64), np.zeros((0, len(self.symbols) + 3 * self.sure))
        symbols = _symbols(strings)
        counts = _letter_counts(symbols, self.alphabet)
        shared = np.zeros((len(symbols), len(self.symbols)), np.int8)
        for c, at in enumerate(self.holders):
            if 2 * len(at) > len(self.symbols):
                shared += np.minimum(counts[:, c:c + 1], self.counts[None, :, c])
            elif len(at) and len(own := np.flatnonzero(counts[:, c])):
                shared[np.ix_(own, at)] += np.minimum(counts[own, c][:, None], self.counts[at, c])
        i, j = np.nonzero(shared >= self.need)
        rows, at = np.unique(i, return_inverse=True)
        out = np.zeros((len(rows), len(self.symbols)))
        held = np.zeros((len(rows), self.sure))
        if len(i):
            own = np.sqrt(np.maximum(kernel(symbols[rows], symbols[rows]), 1e-12))
            raw = kernel(symbols[i], self.symbols[j])
            out[at, j] = raw / (own[at] * self.own[j])
            sure = j < self.sure
            held[at[sure], j[sure]] = np.minimum(raw[sure] / self.own[j[sure]] ** 2, 1)
        plain = out[:, :self.sure]
        return rows, np.hstack([out ** POWER, plain, held, plain * held])

    def each(self, strings: list[str], f) -> np.ndarray:
        """``f`` of the values, ten thousand strings at a time, so that no table of all of them is held."""
        parts = []
        for a in range(0, len(strings), 10_000):
            rows, values = self.near(strings[a:a + 10_000])
            # Most strings are close to no landmark; they are all alike.
            got = f(np.vstack([values, np.zeros((1, values.shape[1]))]))
            part = np.repeat(got[-1:], min(10_000, len(strings) - a), axis=0)
            part[rows] = got[:-1]
            parts.append(part)
        return np.concatenate(parts) if parts else np.zeros(0)


class Shares(NamedTuple):
    """The model of whole documents: what each string adds to a document's sum, and the curve of the sum's share."""
    beginnings: list[str]
    weights: np.ndarray
    slope: float
    offset: float


class Model(NamedTuple):
    landmarks: list[str]
    weights: np.ndarray   # of the values with the landmarks, the whitening multiplied in
    bias: float
    slope: float
    offset: float
    sure: int = 0         # landmarks that tell by themselves, the first ones
    # A second model, of these words and their variants alone, and its own curve; it sets no string's score lower.
    sure_weights: np.ndarray | None = None
    sure_curve: tuple[float, float, float] = (0.0, 1.0, 0.0)   # bias, slope, offset
    shares: Shares | None = None


def sentences(text: str) -> list[list[str]]:
    """The strings of each sentence: normal words, and runs of three or more single letters written apart."""
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", text):
        tokens = sentence.split()
        found = [w for t in tokens if (n := normal(t)) for w in windows(n)]
        out.append(found + [w for run in spaced(tokens) for w in windows(run)])
    return out


def marks_of(word: str) -> list[str]:
    """What can tell a toxic document: the whole word (ending in $), and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if n < len(word))] if len(word) > ORDER else []


def spaced(tokens: list[str]) -> list[str]:
    """Three or more single characters in a row, put together."""
    runs, run = [], []
    for t in [*tokens, ""]:
        w = normal(t)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) >= 3:
            runs.append("".join(run))
        run = []
    return runs


def variants(word: str, rnd: random.Random, inserted: int = 1) -> list[str]:
    """The word with a letter doubled, and ``inserted`` times with a letter inserted."""
    k = rnd.randrange(1, len(word))
    out = [word[:k] + word[k - 1] + word[k:]]
    for _ in range(inserted):
        k = rnd.randrange(1, len(word))
        out.append(word[:k] + rnd.choice("abcdefghijklmnopqrstuvwxyz") + word[k:])
    return out


def frequent_beginnings(documents: list[tuple[list[str], int]]) -> list[str]:
    """Beginnings of words that make up far more of the words of toxic documents than of clean ones, the most telling first."""
    def marks(words: list[str]) -> Iterator[str]:
        return (w[:n] for w in words for n in BEGINNINGS if n <= len(w))

    holders = Counter()
    for words, y in documents:
        if y:
            holders.update(set(marks(words)))
    shares = {m: [0.0, 0.0] for m, c in holders.items() if c >= LEAST_CONTEXTS}
    del holders
    contexts: dict[str, set[str]] = {}     # the words before them in toxic documents: copies count once
    number = [max(1, sum(y == k for _, y in documents)) for k in (0, 1)]
    for words, y in documents:
        for m, c in Counter(m for m in marks(words) if m in shares).items():
            shares[m][y] += min(c / (len(words) + FEW_WORDS), MOST_SHARE) / number[y]
    # The least share taken as known: one clean document that holds it once in a few hundred words.
    least = 0.005 / number[0]
    shares = {m: s for m, s in shares.items() if s[1] > np.exp(SHARE_RATIO) * (s[0] + least)}
    for words, y in documents:
        for before, w in zip(["", *words], words) if y else []:
            for m in marks([w]):
                if m in shares:
                    contexts.setdefault(m, set()).add(before)
    gain = {m: s[1] - np.exp(SHARE_RATIO) * s[0] for m, s in shares.items() if len(contexts[m]) >= LEAST_CONTEXTS}
    out: list[str] = []
    for m in sorted(gain, key=lambda m: (-gain[m], -len(m), m)):
        if len(out) < SHARE_LANDMARKS and gain[m] >= LEAST_GAIN * max(gain.values()) and not any(m.startswith(b) or b.startswith(m) for b in out):
            out.append(m)
    return out


class Beginnings:
    """How much of each of some beginnings strings have at their start, by the kernel."""

    def __init__(self, beginnings: list[str]):
        self.size = len(beginnings)
        self.landmarks = Landmarks([START + b for b in beginnings], self.size)

    def each(self, strings: list[str], f) -> np.ndarray:
        """``f`` of each string's values: a high power of its kernel value with each beginning against the beginning's own."""
        return self.landmarks.each([START + w for w in strings], lambda v: f(v[:, 2 * self.size:3 * self.size] ** SHARPNESS))


def train_shares(documents: list[tuple[list[str], int]], weight: np.ndarray) -> Shares | None:
    """The model of whole documents; None if no beginning tells, or what tells is not trained to be toxic."""
    found = frequent_beginnings(documents)
    if not found:
        return None
    beginnings, flat = Beginnings(found), sorted({w for words, _ in documents for w in words})
    at = {w: i for i, w in enumerate(flat)}
    values = beginnings.each(flat, lambda v: v.astype(np.float32))
    x = np.array([values[[at[w] for w in words]].sum(axis=0) / (len(words) + FEW_WORDS) if words else np.zeros(len(found))
                  for words, _ in documents], dtype=np.float64)
    labels = np.array([y for _, y in documents])
    scale = 1 / max(1e-9, x[labels > 0].sum(axis=1).mean())
    z = np.hstack([x * scale, np.ones((len(x), 1))])
    n, d = z.shape
    rows = Rows(np.arange(0, n * d + 1, d), np.tile(np.arange(d), n), z.ravel())
    w = dual_coordinate_descent(rows, np.where(labels > 0, 1.0, -1.0), d, COST * n * weight / weight.sum(), epochs=100)
    slope, offset = calibrate(z @ w, labels, weight=weight)
    return Shares(found, w[:-1] * scale, slope, offset + slope * float(w[-1])) if slope > 0 else None


def train(texts: list[tuple[str, int]], share: float | None = None) -> Model:
    """The model of (text, label) pairs; without both labels, or a telling word, the smoothed share of ones.

    ``share`` is the share of ones where they come from, if it is another than
    in ``texts``; documents that nothing tells apart score below it.
    """
    n1 = sum(y for _, y in texts)
    n0 = len(texts) - n1
    cut = [(sentences(t), y) for t, y in texts]
    ones = n1 / max(1, len(texts)) if share is None else share
    of_texts = np.array([ones / n1 if y else (1 - ones) / n0 for _, y in texts]) * len(texts)
    # What only its frequency tells first: it holds on to no memory that the rest needs.
    shares = train_shares([([w for s in found for w in s], y) for found, y in cut], of_texts) if n0 and n1 else None
    in_toxic = Counter()                   # toxic documents that hold a word or stem
    for found, y in cut:
        if y:
            in_toxic.update({m for s in found for w in s for m in marks_of(w)})
    often = {m for m, c in in_toxic.items() if c >= LEAST_CONTEXTS}
    del in_toxic
    seen = Counter()                       # clean documents that hold a word, or one of these stems
    contexts: dict[str, set[str]] = {}     # the words before them in toxic documents: copies count once
    for found, y in cut:
        if not y:
            seen.update({m for s in found for w in s for m in marks_of(w) if m in often or m[-1] == "$"})
    rare = {m for m in often if seen[m] <= 0.02 * len(texts)}
    for found, y in cut:
        for s in found if y else []:
            for before, w in zip(["", *s], s):
                for m in marks_of(w):
                    if m in rare:
                        contexts.setdefault(m, set()).add(before)
    ratio = {m: np.log((len(c) + 0.5) / (n1 + 1)) - np.log((seen[m] + 0.5) / (n0 + 1)) for m, c in contexts.items()}
    telling = {m for m, c in contexts.items() if len(c) >= LEAST_CONTEXTS and ratio[m] > LEAST_RATIO and seen[m] <= 0.02 * len(c)}
    used = Counter(w for found, y in cut if y for s in found for w in s if any(m in telling for m in marks_of(w)))
    toxic = sorted(used, key=lambda w: (-used[w], w))
    if not n0 or not toxic:
        p = (ones * len(texts) + 1) / (len(texts) + 2)
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log(p / (1 - p))), shares=shares)
    clean = [m[:-1] for m, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if m.endswith("$") and len(m) > ORDER + 1]
    clean = [w for w in clean if w not in used]
    # Of clean strings, those closest to a toxic landmark teach most.
    near = Landmarks(toxic[:TOXIC_LANDMARKS]).each(clean, lambda v: v.max(axis=1))
    hard = np.argsort(-near, kind="stable").tolist()
    strings = toxic[:TOXIC_LANDMARKS] + [clean[i] for i in dict.fromkeys([*hard[:CLEAN_LANDMARKS], *range(min(16, len(clean)))])]
    def tells(w: str) -> bool:
        return len(contexts.get(w + "$", ())) >= SURE_SHARE * n1

    strings.sort(key=lambda w: not tells(w))
    marks, size = Landmarks(strings, sum(map(tells, strings))), len(strings)
    between = marks.values(strings)[:, :size]
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    whiten = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T

    rnd = random.Random(8)
    positive = []
    for found, y in cut:
        for s in found if y else []:
            if told := [w for w in s if w in used]:  # a toxic sentence, by its commonest telling string
                positive.append(max(told, key=lambda w: (used[w], w)))
    # Each different string once, with its number.
    times, from_sure = Counter(), set()
    for w in positive:
        own = (w, *variants(w, rnd, INSERTED if tells(w) else 1))
        times.update(own)
        from_sure.update(own if tells(w) else ())
    positive = list(times)
    spread = range(0, len(clean), max(1, 2 * len(clean) // CLEAN_STRINGS))
    # The commonest ones are all there: one of them mistaken would take a large part of the clean documents along.
    negative = [clean[i] for i in dict.fromkeys([*hard[:CLEAN_STRINGS // 2], *range(min(CLEAN_STRINGS // 5, len(clean))), *spread])]
    v = marks.values(positive + negative)
    z = np.hstack([v[:, :size] @ whiten, v[:, size:], np.ones((len(v), 1))])
    # The more clean documents hold a clean string, the more it weighs.
    weight = np.array([float(times[w]) for w in positive] + [seen[w + "$"] ** 0.5 for w in negative])
    clean_weight = max(1.0, weight[len(positive):].sum())

    def fit(own: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights of the values and the bias, from these rows."""
        n, d = len(own), z.shape[1]
        rows = Rows(np.arange(0, n * d + 1, d), np.tile(np.arange(d), n), z[own].ravel())
        y = np.where(own < len(positive), 1.0, -1.0)
        toxic_weight = weight[own][y > 0].sum()
        total = toxic_weight + (y < 0).sum()
        least = COST / 10 * np.where(y > 0, weight[own], 1.0)
        cost = COST * total / 2 * weight[own] / np.where(y > 0, toxic_weight, clean_weight)
        w = dual_coordinate_descent(rows, y, d, np.maximum(cost, least), epochs=100)
        return np.concatenate([whiten @ w[:size], w[size:-1]]), float(w[-1])

    # The curves are fitted to whole documents: each one's worst string.
    texts_strings = [[w for s in found for w in s] for found, _ in cut]
    flat = sorted({w for own in texts_strings for w in own})
    labels = np.array([y for _, y in texts])

    def worst(linear: np.ndarray, bias: float) -> np.ndarray:
        margin = dict(zip(flat, marks.each(flat, lambda v: v @ linear + bias), strict=True))
        return np.array([max((margin[w] for w in own), default=bias) for own in texts_strings])

    linear, bias = fit(np.arange(len(z)))
    model = Model(strings, linear, bias, *calibrate(worst(linear, bias), labels, weight=of_texts), shares=shares)
    if not marks.sure or model.slope <= 0:
        return model
    own = np.flatnonzero([w in from_sure for w in positive])
    linear, bias = fit(np.concatenate([own, np.arange(len(positive), len(z))]))
    # This model's curve is fitted to clean documents and the words' variants themselves, each different one once.
    told = v[own] @ linear + bias
    clean_worst = worst(linear, bias)[labels == 0]
    curve = calibrate(np.concatenate([told, clean_worst]), np.repeat([1, 0], [len(told), len(clean_worst)]))
    return model._replace(sure=marks.sure, sure_weights=linear, sure_curve=(bias, *curve))


def train_on(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4, held_out: int = 2,
             id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_ROWS) -> Model:
    """The model of the labelled documents, without those whose id's crc32 modulo ``folds`` is ``held_out``.

    Training reads up to ``limit`` documents of each class, chosen by a hash
    of the id, and of these the ones of at most ``TRAIN_CHARS`` characters.
    """
    held = fold(id_col, folds) == held_out
    sample = F.broadcast(labelled(labels.select(id_col, label_col), label_col, held, limit, id_col))
    ones = labels.filter(F.col(label_col).isin(0, 1) & ~held).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    got = (docs.select(id_col, text_col).join(sample, id_col).filter(F.length(text_col) <= TRAIN_CHARS)
           .select(text_col, "y").collect())
    return train(sorted((r[0], r[1]) for r in got), ones)


def _scorer(model: Model):
    """A function from strings to margins, the greater of the two models' on the first one's scale."""
    marks = Landmarks(model.landmarks, model.sure)

    def margin(v: np.ndarray) -> np.ndarray:
        own = v @ model.weights + model.bias
        if model.sure_weights is None:
            return own
        bias, slope, offset = model.sure_curve
        return np.maximum(own, (slope * (v @ model.sure_weights + bias) + offset - model.offset) / model.slope)

    return lambda strings: marks.each(strings, margin)


def _adder(model: Model):
    """A function from strings to what each adds to its document's sum."""
    if not model.shares:
        return lambda strings: np.zeros(len(strings))
    beginnings = Beginnings(model.shares.beginnings)
    return lambda strings: beginnings.each(strings, lambda v: v @ model.shares.weights)


def with_score(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows kept, with the score of each whole text in column ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    names = schema.names
    at_text = next(i for i, name in enumerate(names) if name.lower() == text_col.lower())

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
        """Slices of the batches and their texts' words. Cut here: texts and words together double what tasks hold."""
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(at_text)), 0).to_numpy(zero_copy_only=False)
            for start, stop in row_ranges(size, SLICE_CHARS):
                part = batch.slice(start, stop - start)
                yield part, pc.split_pattern_regex(pc.fill_null(part.column(at_text), ""), WHITE_SPACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        margins, parts = _scorer(model), _adder(model)
        known: dict[str, float] = {}
        adds: dict[str, float] = {"": 0.0}      # to the document's sum, if anything
        counts: dict[str, int] = {"": 0}        # of strings, if not one

        def remember(words: list[str]) -> None:
            cut = [windows(w) for w in words]
            strings = [x for c in cut for x in c]
            at = np.cumsum([0] + [len(c) for c in cut])
            known.update(zip(words, np.maximum.reduceat(margins(strings), at[:-1]).tolist() if len(words) else [], strict=True))
            if model.shares:
                part = np.add.reduceat(parts(strings), at[:-1]) if len(words) else np.zeros(0)
                adds.update((words[i], float(part[i])) for i in np.flatnonzero(part))
                counts.update((w, len(c)) for w, c in zip(words, cut, strict=True) if len(c) > 1)

        for batch, cut in slices(batches):
            if len(known) > MEMORY_WORDS:
                known.clear()
                adds, counts = {"": 0.0}, {"": 0}
            distinct, index, bounds = distinct_pieces(cut)
            strings = [normal(w) for w in distinct.to_pylist()]
            remember([w for w in dict.fromkeys(strings) if w and w not in known])
            each = np.array([known.get(w, model.bias) for w in strings])
            worst = np.full(len(bounds) - 1, model.bias)
            filled = np.flatnonzero(np.diff(bounds))
            if len(filled):
                worst[filled] = np.maximum(model.bias, np.maximum.reduceat(each[index], bounds[filled]))
            row = np.repeat(np.arange(len(worst)), np.diff(bounds))
            total, number = np.zeros(len(worst)), np.zeros(len(worst))
            if model.shares:
                total += np.bincount(row, np.array([adds.get(w, 0.0) for w in strings])[index], len(worst))
                number += np.bincount(row, np.array([counts.get(w, 1) for w in strings])[index], len(worst))
            # Letters written apart: rows that hold three single characters in a row.
            single = np.fromiter((len(w) == 1 for w in strings), bool, len(strings))[index]
            three = np.flatnonzero(single[:-2] & single[1:-1] & single[2:])
            three = three[row[three] == row[three + 2]]
            for i in np.unique(row[three]):
                tokens = pc.take(distinct, pa.array(index[bounds[i]:bounds[i + 1]])).to_pylist()
                if runs := [w for run in spaced(tokens) for w in windows(run)]:
                    worst[i] = max(worst[i], margins(runs).max())
                    if model.shares:
                        total[i] += parts(runs).sum()
                        number[i] += len(runs)
            told = model.slope * worst + model.offset
            if model.shares:
                told = np.maximum(told, model.shares.slope * total / (number + FEW_WORDS) + model.shares.offset)
            scores = sigmoid(told)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=names)

    return docs.mapInArrow(tidied(run), schema)


def classify(docs: DataFrame, model: Model, folds: int = 4, held_out: int = 2, threshold: float = 0.3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score`` in [0, 1], ``predicted`` (1 from ``threshold`` on).

    NULL and empty texts hold no string and get the lowest score; a row with
    a NULL id is not held out; repeated rows get equal scores. Words of any
    length are read whole, in overlapping windows. Labels and columns other
    than the text never enter a score. Without toxic and clean labelled
    documents, or a word that tells them apart, every score is the smoothed
    share of ones.
    """
    scored = with_score(docs.select(docs[id_col], docs[text_col]), model, "score", text_col)
    return scored.select(F.col(id_col), F.coalesce(fold(id_col, folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
