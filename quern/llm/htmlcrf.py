"""Operator 2, main text of web pages by a conditional random field over DOM leaf blocks.

A page is read into its leaf blocks, the runs of text that no block element
divides, each with its chain of open elements. A linear-chain conditional
random field labels the blocks of a page as article or not, from features of
the ancestors (tags, class and id words) and of the text (length, share of
links, punctuation, place in the page), and decodes by Viterbi. It is trained
by maximum likelihood on labelled pages: a bounded sample of the given pages,
as far as their own markup names the article, and pages composed from the
sample's texts in many layouts, whose labels are known as they are made.
Training is small and runs on the driver; pages are labelled in Spark tasks.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 150          # given pages that training reads, at most
TRAIN_CHARS = 100_000      # longer pages are not read for training
COMPOSED_PAGES = 700
ROUNDS, REGULAR = 250, 0.0005

# HTML's block elements, elements without an end tag, elements
# whose content is not text of the page, and those that an opening tag closes.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript iframe svg math textarea title object canvas audio video select button".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table div section article aside nav main body blockquote td th form header footer".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


class Path:
    """The open elements around a place, from the outside, each "tag word word ...": a chain that blocks share.

    What features need of all of them is kept at each link, so a deep page
    costs no more than its length.
    """

    __slots__ = ("outer", "name", "tags", "words", "last", "named")

    def __init__(self, outer: Path | None = None, name: str = "") -> None:
        self.outer, self.name = outer, name
        self.tags, self.words, self.last, self.named = (outer.tags, outer.words, outer.last, outer.named) if outer else (frozenset(), frozenset(), (), ())
        if outer:
            tag, *words = name.split()
            self.tags = self.tags if tag in self.tags else self.tags | {tag}
            self.last = (*self.last, tag)[-3:] if tag in BLOCKS else self.last
            if words:   # the innermost element that has names
                self.named = tuple(words)
                self.words = self.words if self.words.issuperset(words) else self.words.union(words)

    @property
    def key(self) -> tuple:
        """What tells paths of different features apart."""
        return self.tags, self.words, self.last, self.named

    def __iter__(self) -> Iterator[str]:
        names, link = [], self
        while link.outer:
            names.append(link.name)
            link = link.outer
        return reversed(names)

    def __getitem__(self, i: int | slice) -> str | tuple[str, ...]:
        return tuple(self)[i]


class Block(NamedTuple):
    path: Path
    text: str
    linked: int             # characters of the text inside links


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order: text with references decoded and white space as one blank.

    References are decoded in each text apart from the next one, as markup
    between them ends them. A slash before the end of a start tag says nothing
    (HTML has no elements closed that way), be it of an unquoted value or not.
    """
    out: list[Block] = []
    stack: list[str] = []          # tags
    path: list[Path] = [Path()]    # around the page, and inside each of them
    open_now: Counter[str] = Counter()
    buffer: list[tuple[str, bool]] = []

    def text(raw: str) -> None:
        buffer.append((html.unescape(raw), open_now["a"] > 0))

    def flush() -> None:
        if buffer:
            whole = " ".join("".join(t for t, _ in buffer).split())
            if whole:
                linked = sum(len(" ".join(t.split())) for t, inside in buffer if inside)
                out.append(Block(path[-1], whole, min(linked, len(whole))))
            buffer.clear()

    def last_open(wanted: set[str], scopes: frozenset[str] = frozenset()) -> int:
        """The place of the innermost open element of these tags, looked for as far as a scope; -1 if there is none."""
        if any(open_now[t] for t in wanted):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in wanted:
                    return k
                if stack[k] in scopes:
                    break
        return -1

    def close_to(k: int) -> None:
        open_now.subtract(stack[k:])
        del stack[k:], path[k + 1:]

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        if lt > at:
            text(page[at:lt])
        following = page[lt + 1:lt + 2]
        if following in ("!", "?"):
            stop = page.find("-->", lt + 4) + 2 if page.startswith("<!--", lt) else page.find(">", lt)
            at = stop + 1 if stop >= lt else end   # what is never closed has no text after it
            continue
        m = _TAG.match(page, lt)
        if not m:
            if following.isalpha() or following == "/":
                # an end tag without a name is markup, and a tag cut off at the end is no text
                stop = page.find(">", lt) if following == "/" else -1
                at = stop + 1 if stop >= 0 else end
            else:
                text("<")
                at = lt + 1
            continue
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = tag.lower()
        if tag == "br":
            buffer.append((" ", False))
            continue
        if tag in BLOCKS:
            flush()
        if closing:
            k = last_open({tag})
            if k >= 0:
                if any(t in BLOCKS for t in stack[k:]):
                    flush()
                close_to(k)
            continue
        if tag in SKIPPED:
            found = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
            at = found.end() if found else end
            buffer.append((" ", False))
            continue
        if tag in BLOCKS:   # a block ends an open paragraph
            k = last_open({"p"}, SCOPES)
            if k >= 0:
                close_to(k)
        if tag in CLOSES:
            k = last_open(CLOSES[tag], SCOPES)
            if k >= 0:
                close_to(k)
        if tag not in VOID:
            names = " ".join(x for g in _NAMES.findall(attributes) for x in g).lower() if attributes else ""
            stack.append(tag)
            open_now[tag] += 1
            path.append(Path(path[-1], " ".join([tag, *_WORD.findall(names)])))
    flush()
    return out


def path_features(path: Path) -> list[str]:
    """Features of the ancestors: tags, the innermost ones in order, and the words of their classes and ids."""
    out = {f"tag {t}" for t in path.tags} | {f"word {w}" for w in path.words}
    out |= {f"in {'/'.join(path.last[-k:])}" for k in (1, 2, 3)}
    out |= {f"under {t}" for t in ("article", "main", "nav", "aside", "header", "footer", "form") if t in path.tags}
    out |= {f"named {w}" for w in path.named}
    out.add(f"words {bool(path.words)}")
    return sorted(out)


def text_features(own: list[Block], i: int) -> list[str]:
    b = own[i]
    n, words = len(b.text), b.text.split()
    share = b.linked / n
    marks = sum(b.text.count(c) for c in ".,;!?")
    return ["bias", f"size {min(9, n.bit_length())}", f"words {min(7, len(words).bit_length())}",
            f"links {0 if share == 0 else 1 if share < 0.34 else 2 if share < 0.9 else 3}",
            f"marks {min(4, marks)}", f"end {b.text[-1] if b.text[-1] in '.!?:;,' else 'a'}",
            f"sign {'©' in b.text} {'|' in b.text or '»' in b.text}", f"place {min(4, 5 * i // len(own))}",
            "first" if i == 0 else "last" if i == len(own) - 1 else "middle"]


class Model(NamedTuple):
    columns: dict[str, int]
    weights: np.ndarray      # of each feature for the label 1
    moves: np.ndarray        # of a label after a label


def _emissions(own: list[Block], model: Model, known: dict[tuple, float]) -> list[float]:
    columns, weights = model.columns, model.weights

    def total(features: list[str]) -> float:
        return float(sum(weights[columns[f]] for f in features if f in columns))

    out = []
    for i, b in enumerate(own):
        key = b.path.key
        if key not in known:
            known[key] = total(path_features(b.path))
        out.append(known[key] + total(text_features(own, i)))
    return out


def viterbi(emissions: list[float], moves: np.ndarray) -> list[int]:
    """The likeliest labels, given the score of label 1 (of 0: zero) and of each move."""
    (m00, m01), (m10, m11) = moves.tolist()
    back, s0, s1 = [], 0.0, 0.0
    for i, e in enumerate(emissions):
        if i:
            a, b = s1 + m10 > s0 + m00, s1 + m11 >= s0 + m01
            back.append((int(a), int(b)))
            s0, s1 = (s1 + m10 if a else s0 + m00), (s1 + m11 if b else s0 + m01)
        s1 += e
    labels = [int(s1 >= s0)]
    for choice in reversed(back):
        labels.append(choice[labels[-1]])
    return labels[::-1] if emissions else []


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = ROUNDS) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam on the whole set; gradients by forward-backward."""
    pages = [p for p in pages if p[0]]
    columns: dict[str, int] = {}
    flat, bounds = [], [0]
    for own, _ in pages:
        for i, b in enumerate(own):
            flat += [columns.setdefault(f, len(columns)) for f in [*path_features(b.path), *text_features(own, i)]]
            bounds.append(len(flat))
    flat, bounds = np.array(flat, np.int64), np.array(bounds)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    size = np.array([len(own) for own, _ in pages])
    n, longest, count = len(pages), int(size.max()), len(columns)
    there = np.arange(longest)[None] < size[:, None]
    gold = np.zeros((n, longest), np.int64)
    gold[there] = [y for _, labels in pages for y in labels]
    gold_moves = np.zeros((2, 2))
    for j in range(1, longest):
        np.add.at(gold_moves, (gold[there[:, j], j - 1], gold[there[:, j], j]), 1)
    w, m1, m2 = np.zeros(count + 4), np.zeros(count + 4), np.zeros(count + 4)
    for step in range(1, rounds + 1):
        moves = w[count:].reshape(2, 2)
        e = np.zeros((n, longest))
        e[there] = np.bincount(rows, w[flat], len(bounds) - 1)
        e = np.stack([np.zeros_like(e), e], 2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = e[:, 0]
        for j in range(1, longest):
            go = np.logaddexp(forward[:, j - 1, 0, None] + moves[0], forward[:, j - 1, 1, None] + moves[1]) + e[:, j]
            forward[:, j] = np.where(there[:, j, None], go, forward[:, j - 1])
        for j in range(longest - 2, -1, -1):
            go = backward[:, j + 1] + e[:, j + 1]
            go = np.logaddexp(moves[:, 0] + go[:, 0, None], moves[:, 1] + go[:, 1, None])
            backward[:, j] = np.where(there[:, j + 1, None], go, 0)
        whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        p1 = np.exp(forward[:, :, 1] + backward[:, :, 1] - whole[:, None])[there]
        gradient = np.zeros(count + 4)
        gradient[:count] = np.bincount(flat, (gold[there] - p1)[rows], count)
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                pair = forward[:, :-1, a] + moves[a, b] + e[:, 1:, b] + backward[:, 1:, b] - whole[:, None]
                expected[a, b] = np.exp(pair[there[:, 1:]]).sum()
        gradient[count:] = (gold_moves - expected).ravel()
        gradient = gradient / n - REGULAR * w
        m1, m2 = 0.9 * m1 + 0.1 * gradient, 0.99 * m2 + 0.01 * gradient ** 2
        w = w + 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return Model(columns, w[:count], w[count:].reshape(2, 2).copy())


# Elements and names of what is not the article, wherever they stand in a page.
OTHER_TAGS = frozenset("nav aside header footer form menu dialog".split())
OTHER_NAMES = frozenset("""ad ads advert advertisement alert banner breadcrumb breadcrumbs byline comment comments cookie consent
disqus footer form header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo related
reply replies search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())


def marked(own: list[Block]) -> list[int] | None:
    """Labels of a page whose markup names its article or main part; None for other pages."""
    inside = [next((k for k, p in enumerate(b.path) if p.split(" ", 1)[0] in ("article", "main")), None) for b in own]
    if all(k is None for k in inside):
        return None
    return [int(k is not None and not any(p.split(" ", 1)[0] in OTHER_TAGS or OTHER_NAMES.intersection(p.split()[1:]) for p in b.path[k:]))
            for b, k in zip(own, inside, strict=True)]


def composed(texts: list[str], rnd: random.Random) -> tuple[list[Block], list[int]]:
    """A page made up of an article and other parts in a layout of its own, and the labels of its blocks.

    Unclosed markup may make a part's blocks run into the next one's; the
    labels then differ in number, and the page is of no use.
    """
    def some(least: int, most: int) -> str:
        words = rnd.choice(texts).split()
        n = rnd.randint(least, most)
        a = rnd.randrange(max(1, len(words) - n))
        return html.escape(" ".join(words[a:a + n]))

    def tagged(tag: str, inner: str, names: list[str]) -> str:
        word = rnd.choice(names) if names else ""
        extra = rnd.choice(["", "-" + rnd.choice(["box", "inner", "wrap", "list", "main", "content", "body", "text"])])
        return f"<{tag} {rnd.choice(['class', 'id'])}=\"{word}{extra}\">{inner}</{tag}>" if word else f"<{tag}>{inner}</{tag}>"

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{some(1, 3)}</a></li>' for k in range(n)) + "</ul>"

    def sentences(least: int, most: int) -> str:
        return "".join(f"<p>{some(4, 60)}.</p>" for _ in range(rnd.randint(least, most)))

    def other() -> str:
        kind = rnd.randrange(9)
        short = rnd.choice([some(3, 25), sentences(1, 2), f"<span>{some(2, 10)}</span>"])
        return [lambda: rnd.choice([f"<nav>{links(rnd.randint(2, 9))}</nav>", tagged("div", links(rnd.randint(2, 9)), ["menu", "nav", "breadcrumb", "navigation"])]),
                lambda: rnd.choice([f"<aside>{short}</aside>", tagged("div", short + links(3), ["sidebar", "related", "widget"])]),
                lambda: tagged(rnd.choice(["div", "section", "aside"]), short, ["ad", "ads", "advert", "advertisement", "promo", "sponsored", "banner"]),
                lambda: tagged("div", short, ["cookie", "notice", "consent", "alert", "popup"]),
                lambda: tagged("form", f"<label>{some(1, 4)}</label><input name=q><button>{some(1, 2)}</button><p>{some(3, 15)}</p>", ["", "search", "newsletter", "login", "subscribe"]),
                lambda: tagged(rnd.choice(["section", "div", "ol"]), "".join(tagged(rnd.choice(["div", "li", "article"]), f"<p>{some(3, 40)}.</p>", ["comment", "reply"]) for _ in range(rnd.randint(1, 4))), ["comments", "comments", "disqus", "replies"]),
                lambda: tagged("div", links(3), ["share", "social", "pagination", "related"]),
                lambda: rnd.choice([f"<header>{short}</header>", tagged("div", short, ["header", "masthead"])]),
                lambda: rnd.choice([f"<footer>&copy; {some(2, 12)}</footer>", tagged("div", f"&copy; {some(2, 12)}", ["footer"])])][kind]()

    def paragraph() -> str:
        inner = some(2, 80) if rnd.random() < 0.8 else f"{some(3, 20)} <a href='x'>{some(1, 4)}</a> <b>{some(1, 5)}</b> {some(2, 20)}"
        return rnd.choice([f"<p>{inner}.</p>", f"<p>{inner}.</p>", f"<p>{inner}", f"<p><b>{inner}.<br>", f"<div>{inner}.</div>",
                           f"<h2>{some(1, 8)}</h2><p>{inner}.</p>", f"<ul><li>{some(2, 20)}.</li><li>{some(2, 20)}.</li></ul>",
                           f"<blockquote><p>{inner}.</p></blockquote>"])

    title = f"<h1>{some(2, 12)}</h1>" if rnd.random() < 0.8 else ""
    body = [title, *(paragraph() for _ in range(rnd.randint(1, 12)))]
    for _ in range(rnd.choice([0, 0, 1, 1, 2])):
        body.insert(rnd.randint(1, len(body)), f"<!--o-->{other()}<!--/o-->")
    article = "".join(body)
    wrap = rnd.randrange(5)
    if wrap == 0:
        article = f"<article>{article}</article>"
    elif wrap == 1:
        article = f"<main>{article}</main>"
    elif wrap == 2:
        article = f'<main><article class="{rnd.choice(["post", "entry", "story"])}">{article}</article></main>'
    else:
        article = tagged("div", article, ["content", "post", "entry", "article", "story", "text", "body", "main", ""])
    def around(inner: str) -> str:
        return rnd.choice([lambda: f"<main>{inner}</main>", lambda: f"<section>{inner}</section>",
                           lambda: tagged("div", inner, ["page", "container", "wrapper", "site", "layout", "row", "column", "main", "content"])])()

    if rnd.random() < 0.3:
        article += f"<!--o-->{other()}<!--/o-->"
    if rnd.random() < 0.5:
        article = around(article)
    before = "".join(f"<!--o-->{other()}<!--/o-->" for _ in range(rnd.randint(0, 4)))
    after = "".join(f"<!--o-->{other()}<!--/o-->" for _ in range(rnd.randint(0, 4)))
    body = before + article + after
    if rnd.random() < 0.4:
        body = around(body)
    page = f"<html><head><title>{some(2, 8)}</title></head><body>{body}</body></html>"
    # The parts between the marks are read apart to know which blocks are theirs.
    parts = re.split(r"<!--(/?o)-->", page)
    labels = []
    inside = False
    for k, part in enumerate(parts):
        if k % 2:
            inside = part == "o"
            continue
        labels += [0 if inside else 1] * len(blocks(part))
    own = blocks(re.sub(r"<!--/?o-->", "", page))
    return own, labels


def training_pages(sample: list[str], n: int = COMPOSED_PAGES, seed: int = 2) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: the sample's own, as far as their markup tells, and ``n`` composed ones."""
    rnd = random.Random(seed)
    out, texts = [], []
    for page in sample:
        own = blocks(page)
        labels = marked(own) if own else None
        if labels and any(labels):
            out.append((own, labels))
        texts += [b.text for b in own if len(b.text) > 60][:20]
    texts = texts or [" ".join("".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(2, 9))) for _ in range(90)) + "." for _ in range(50)]
    while n > 0:
        own, labels = composed(texts, rnd)
        if own and len(own) == len(labels):
            out.append((own, labels))
        n -= 1
    return out


def main_text(page: str | None, model: Model, known: dict[tuple, float] | None = None) -> str:
    """The article's blocks in page order, one a line (empty for a NULL or empty page)."""
    own = blocks(page) if page else []
    labels = viterbi(_emissions(own, model, {} if known is None else known), model.moves)
    return "\n".join(b.text for b, y in zip(own, labels, strict=True) if y)


def train_on(pages: DataFrame, html_col: str = "html", limit: int = TRAIN_PAGES) -> Model:
    """The model of ``limit`` pages spread by a hash of their content, and of pages composed from their texts."""
    short = pages.filter(F.length(html_col) <= TRAIN_CHARS).select(F.col(html_col).alias("page"), F.xxhash64(html_col).alias("h"))
    # Hashes first: no more pages than the sample ever leave the tasks, and equal pages count once.
    hashes = [r["h"] for r in short.select("h").distinct().orderBy("h").limit(limit).collect()]
    sample = [r["page"] for r in sorted(short.filter(F.col("h").isin(hashes)).groupBy("h").agg(F.min("page").alias("page")).collect())]
    return train(training_pages(sample))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, ``text`` of the article and ``n_chars``, its length in code points.

    A NULL or empty page, and one without text, gives the empty text; markup
    that is never closed or cut off at the end is read as far as it goes;
    pages of any length are read whole; repeated rows and NULL ids or urls
    give a row each; other columns are not read.
    """
    model = pages.sparkSession.sparkContext.broadcast(train_on(pages, html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, float] = {}
        for batch in batches:
            if len(known) > 50_000:
                known.clear()
            texts = [main_text(p, model.value, known) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    types = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {types[0]}, `{url_col}` {types[1]}, text string, n_chars long")
