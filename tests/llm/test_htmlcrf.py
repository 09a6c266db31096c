"""Operator 2: block reading, the chain against enumeration, whole pages, unseen layouts, odd rows."""

import html
import random
import re
import time
from html.parser import HTMLParser
from itertools import product

import numpy as np
import pytest

from quern.llm import common, htmlcrf, queries

SF = "/root/testdata/sf0.01"


def test_blocks():
    page = """<html><head><title>no</title><style>p{}</style></head><body><!-- <p>no</p> --><script>var a="</p>";</script>
      <p>One &amp; two&nbsp;&lt;b&gt;<br> three <b>four</b>five<p>six<ul><li>a<li><a href="x>y">b c</a> d</ul>1 < 2 &am"""
    got = htmlcrf.blocks(page)
    assert [b.text for b in got] == ["One & two <b> three fourfive", "six", "a", "b c d", "1 < 2 &am"]
    assert got[3].linked == 3 and got[0].path[-1] == "p" and got[2].path[-2:] == ("ul", "li")
    assert [b.text for b in htmlcrf.blocks("a<div class='x y'>b</div>c<p")] == ["a", "b", "c"]
    for odd in ("", "<", "<!--", "<!", "</", "< p>", "<p class=\"", "&#x41;&#0;", "<script>x", "</p></div>x"):
        htmlcrf.blocks(odd)


def test_long_pages_are_read_whole():
    page = "<article>" + "".join(f"<p>word {i}</p>" for i in range(20_000)) + "</article>"
    assert len(htmlcrf.blocks(page)) == 20_000
    assert len(htmlcrf.blocks("<b>" * 3000 + "x" * 100_000)) == 1


def test_markup_as_a_browser_reads_it():
    def texts(page):
        return [b.text for b in htmlcrf.blocks(page)]

    assert texts("AT&<b>para</b>") == ["AT&para"] and texts("a &am<!-- -->p; b &lt<i>;</i>") == ["a &amp; b <;"]
    link = htmlcrf.blocks("<p>see <a href=http://x.com/>this place</a> and <a href='y'/>that</a></p>")
    assert [(b.text, b.linked) for b in link] == [("see this place and that", 14)]
    assert texts('x<script src="a.js"/>code</script>y') == ["x y"] and texts("<div/>a<div>b") == ["a", "b"]
    assert htmlcrf.blocks("<div class='x'/>a")[0].path[-1] == "div x" and texts("a<br/>b<img/>c") == ["a bc"]


def test_deep_pages_take_their_length():
    start = time.time()
    deep = htmlcrf.blocks("<div class='a b'>x" * 100_000 + "</div>y" * 100_000)
    assert len(deep) == 200_000 and len(list(deep[99_999].path)) == 100_000 and deep[-1].path.key == htmlcrf.Path().key
    htmlcrf.blocks("<b>" * 100_000 + "<p>x" * 1000 + "</b>" * 100_000)
    assert time.time() - start < 20


def by_hand(page):
    """A plain reader of another make for pages of the composed kind: a tree by the standard library, then its texts."""
    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.now, self.skip = [], [], 0

        def end_block(self):
            if text := " ".join("".join(self.now).split()):
                self.out.append(text)
            self.now = []

        def handle_starttag(self, tag, attrs):
            if tag in htmlcrf.SKIPPED:
                self.skip += 1
            if tag in htmlcrf.BLOCKS:
                self.end_block()
            if tag == "br":
                self.now.append(" ")

        def handle_endtag(self, tag):
            if tag in htmlcrf.SKIPPED:
                self.skip -= 1
                self.now.append(" ")
            if tag in htmlcrf.BLOCKS:
                self.end_block()

        def handle_data(self, data):
            if not self.skip:
                self.now.append(data)

    reader = Reader()
    reader.feed(page)
    reader.close()
    reader.end_block()
    return reader.out


def test_blocks_equal_another_reader(spark):
    rows = common.table(spark, SF, "pages").collect()
    assert len(rows) > 100
    for r in rows:
        assert [b.text for b in htmlcrf.blocks(r["html"])] == by_hand(r["html"])


def test_viterbi_is_the_best_of_all():
    rnd = np.random.default_rng(1)
    for n in range(1, 7):
        e, moves = rnd.normal(size=n), rnd.normal(size=(2, 2))
        value = lambda y: sum(e[i] for i in range(n) if y[i]) + sum(moves[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        best = max(product((0, 1), repeat=n), key=value)
        assert htmlcrf.viterbi(e.tolist(), moves) == list(best)


@pytest.fixture(scope="module")
def model(spark):
    return htmlcrf.train_on(common.table(spark, SF, "pages"))


def test_training_fits_unseen_composed_pages(spark, model):
    rnd = random.Random(123)
    texts = [r["text"] for r in common.table(spark, SF, "documents").limit(200).collect() if len(r["text"]) > 100]
    right = total = 0
    for _ in range(200):
        own, labels = htmlcrf.composed(texts, rnd)
        if len(own) == len(labels):
            got = htmlcrf.viterbi(htmlcrf._emissions(own, model, {}), model.moves)
            right += sum(a == b for a, b in zip(got, labels))
            total += len(labels)
    assert right / total > 0.97


def test_given_pages(spark, model):
    for r in common.table(spark, SF, "pages").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = re.sub(r"<[^>]*>", " ", re.sub(r"</?(p|h1)>", "\0", article)).split("\0")
        want = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert htmlcrf.main_text(r["html"], model) == want


def test_other_layouts(model):
    page = """<body><header><p>The Daily Site</p></header><div class="menu"><a href=1>Home</a> <a href=2>News</a></div>
      <div id="cookie-notice"><p>We use cookies to make this site better for you.</p></div>
      <main><div class="entry-content"><h1>A title</h1><p>The first paragraph of the article is here.</p>
      <div class="advert">Buy this thing now, it is cheap.</div><p>The second paragraph follows, as it should.</p></div>
      <section id="comments"><div class="comment"><p>I liked this article very much.</p></div></section></main>
      <aside class="sidebar"><h3>Related</h3><ul><li><a href=3>Other story</a></li></ul></aside>
      <form class="newsletter"><label>Your address</label><input><button>Send</button></form>
      <footer>&copy; 2024 The Daily Site</footer></body>"""
    assert htmlcrf.main_text(page, model) == (
        "A title\nThe first paragraph of the article is here.\nThe second paragraph follows, as it should.")


def test_rows(spark):
    body = "<html><body><nav><a href=1>x</a></nav><article><p>Some text.</p></article></body></html>"
    rows = [(1, "u", body, "x"), (1, "u", body, "x"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<p", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in htmlcrf.extract(df).collect()), key=str)
    want = [(1, "u", "Some text.", 10), (1, "u", "Some text.", 10), (2, None, "", 0), (None, "u", "", 0), (3, "u", "", 0)]
    assert got == sorted(want, key=str)
    assert htmlcrf.extract(df.limit(0)).count() == 0


def test_query(spark):
    got = queries.op2_html_main_text(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert got.count() == common.table(spark, SF, "pages").count()
