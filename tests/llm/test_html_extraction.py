"""Main texts of pages: against the pages' own marks, on other sites' markup, and on odd input."""

import html as entities
import itertools
import math
import random
import re

import pytest

from presscheck.llm import html_extraction as H
from presscheck.llm.html_blocks import Reader
from presscheck.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
P = [
    "The river rose again on Tuesday, and the lower road was closed before noon.",
    "“We had an hour,” said one farmer & neighbour; the others nodded.",
    "Nobody was hurt. The water fell during the night, and schools opened the next day.",
]
RAW = [entities.escape(p) for p in P]
PAGES = {
    "div soup": (
        '<body class="page has-sidebar"><div id="header"><h1>Valley News</h1></div><div class="main-menu"><ul><li><a href="/">Home</a>'
        '<li><a href="/s">Sport</a></ul></div><div id="content"><h2>Flood</h2><p>%s<p>%s<p>%s</div><div id="sidebar"><h3>Most read</h3>'
        '<p><a href="/x">Ten ways to dry a book, and what to do when it is too late</a></p></div><div id="footer">© Valley News</div>' % tuple(RAW),
        ["Flood", *P],
    ),
    "semantic": (
        '<header><a href="/">Valley</a></header><nav><a href="/a">A</a></nav><div class="cookie-notice"><p>We use cookies, and so do our partners. '
        'By reading on you agree.</p><button>OK</button></div><main><article><header><h1>Flood</h1></header><p>%s</p><aside class="related">'
        '<p>Also read: the drought of last year, and its end.</p></aside><p>%s</p><p>%s</p><footer>Tags: river</footer></article>'
        '<section id="comments"><h2>2 comments</h2><article class="comment"><p>I saw it too, from my window, and it was frightening.</p></article></section></main>'
        '<form action="/s"><label>Search</label><input></form><footer><p>Imprint</p></footer>' % tuple(RAW),
        ["Flood", *P],
    ),
    "script and style": (
        '<script>if (a < b) document.write("<p>no</p>")</script><style>p > a {}</style><article class="post"><h1>Flood</h1><p>%s</p>'
        "<script>var t = '</p>';</script><p>%s</p><noscript>x</noscript><p>%s</p></article><!-- <p>gone</p> -->" % tuple(RAW),
        ["Flood", *P],
    ),
    "inline markup": (
        '<div class="article-body"><h1>Fl<b>oo</b>d</h1><p>The river <a href="/r">rose again</a> on\n Tuesday, and the lower&#32;road was<br>closed before noon.'
        '<p>%s<div class="advertisement">Buy now!</div><p>%s</div><div class="footer">Contact</div>' % (RAW[1], RAW[2]),
        ["Flood", *P],
    ),
}


@pytest.fixture(scope="module")
def field(spark):
    return H.fit(spark.read.parquet(f"{MIDDLE}/pages.parquet"))


def own_marks(page):
    """The blocks of the element that the given tables mark; their inner markup is flat."""
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", re.sub(r"<[^>]*\Z", "", page), re.S)
    blocks = re.split(r"</?(?:p|h1)>", body[1].replace("<br>", " ")) if body else []
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_query_finds_the_marked_text_of_every_page(spark):
    found = QUERIES["op11_html_extraction"](spark, MIDDLE).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    assert len(found) == len(pages)
    for row in found:
        assert row.text == own_marks(pages[row.page_id].html) and row.url == pages[row.page_id].url
        assert row.n_chars == len(row.text)


def test_pages_of_other_markup(spark, field):
    rows = [(name, page) for name, (page, _) in PAGES.items()]
    found = H.extract(spark.createDataFrame(rows, "name string, html string"), field)
    for row in found.collect():
        assert row.text.split("\n") == PAGES[row.name][1], row.name


def test_unseen_dresses_are_read_well(spark, field):
    """Made anew from pages that the fit has not seen."""
    sample = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    right = count = 0
    for number, page in enumerate(sample):
        blocks = H._by_parts(Reader(), page)
        main = [b[1] for b in blocks if b[3]]
        dressed = H._dressed(random.Random(f"other {number}"), main[0], main[1:], [b[1] for b in blocks if not b[3]][:9])
        want = [place.main for place, _, _ in Reader().read(dressed)]
        read = Reader(field.weights).read(dressed)
        scores = [p.score + sum(field.weights.get(f, 0.0) for f in H.look(t, n)) for p, t, n in read]
        right += sum(a == b for a, b in zip(want, H.decode(scores, field.rise, field.fall)))
        count += len(want)
    assert right / count > 0.97


def test_decoding_is_the_best_of_all_labellings():
    generator = random.Random(5)
    for size in range(1, 9):
        scores = [generator.uniform(-3, 3) for _ in range(size)]
        rise, fall = generator.uniform(-2, 2), generator.uniform(-2, 2)
        turn = {(0, 1): rise, (1, 0): fall}
        value = lambda y: sum(s for s, on in zip(scores, y) if on) + sum(turn.get(ab, 0) for ab in zip(y, y[1:]))
        best = max(itertools.product((False, True), repeat=size), key=value)
        assert value(H.decode(scores, rise, fall)) == pytest.approx(value(best))


def test_likelihood_and_gradient_are_those_of_all_labellings():
    import numpy as np

    generator = np.random.default_rng(2)
    lengths = [3, 1, 4]
    places = generator.integers(0, 3, 2 * sum(lengths))
    rows = np.repeat(np.arange(sum(lengths)), 2)
    labels = generator.integers(0, 2, sum(lengths)).astype(bool)
    evaluate = H._likelihood(places, rows, labels, np.array(lengths), 3, 0.1)
    values = generator.normal(size=5)

    def plain(v):
        score = np.bincount(rows, v[places], sum(lengths))
        loss, start = 0.1 / 2 * v @ v, 0
        for n in lengths:
            def of(y, s=score[start : start + n]):
                return sum(a for a, on in zip(s, y) if on) + sum({(0, 1): v[3], (1, 0): v[4]}.get(ab, 0) for ab in zip(y, y[1:]))
            total = math.log(sum(math.exp(of(y)) for y in itertools.product((0, 1), repeat=n)))
            loss += total - of(labels[start : start + n].astype(int).tolist())
            start += n
        return loss

    loss, gradient = evaluate(values)
    assert loss == pytest.approx(plain(values))
    for i in range(5):
        step = np.eye(5)[i] * 1e-5
        assert gradient[i] == pytest.approx((plain(values + step) - plain(values - step)) / 2e-5, abs=1e-5)


def test_odd_pages(spark, field):
    long = "<article>" + "<p>One, two, three and four words.</p>" * 30_000 + "</article>"
    odd = [None, "", " ", "plain words", "<", "<p", "a < b", "<!-- open", "<script>x", "</p></p>", "&am", "<p>x &amp", "\x00<b>\x00",
           "<div " * 5000, "<p>" * 50_000 + "x", "<div><section>" * 3000, "<table><tr><td>" * 3000, '<a href="' + "x'" * 9000, long]
    rows = [(i, t, i) for i, t in enumerate(odd)] + [(3, odd[3], 1), (3, odd[3], 1), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, html string, text long").withColumn("_html", H.F.lit("x"))
    found = H.extract(frame, field)
    assert found.columns == ["page_id", "text", "_html", "text_"] and found.count() == len(rows)
    texts = {r.page_id: r.text_ for r in found.collect() if r.page_id is not None}
    assert texts[0] == texts[1] == texts[2] == "" and all(t is not None for t in texts.values())
    assert texts[len(odd) - 1].count("\n") == 29_999
    assert H.extract(frame.limit(0), field).isEmpty()
    # No page that names its parts, and no page at all.
    for pages in (frame, frame.limit(0)):
        learned = H.fit(pages.where("page_id is null or page_id < 18"))
        assert H.extract(spark.createDataFrame([("<article><p>%s</p></article>" % P[0],)], "html string"), learned).head().text == P[0]


def test_blocks():
    read = lambda page: [text for _, text, _ in Reader().read(page)]
    assert read("a<b>b</b>c <i> d</i><p>e<p>f<br>g</p>h") == ["abc d", "e", "f g", "h"]
    assert read("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>") == ["1", "2", "3", "4"]
    assert read("<title>t</title><textarea><p>x</textarea>y<template><p>z</template>w &nbsp; &#x41;&lt;p&gt;") == ["yw A<p>"]
    assert read('<p title="a > b">x</p><p title=">y</p>') == ["x", "y"]
    assert Reader().read('<div><a href="/">ab</a> cd</div><p>e')[0][2] == 2
    assert Reader().read("<p><a>x<p>y</p></div>z") and read("1 < 2 <3 </ x>4") == ["1 < 2 <3 4"]
