"""Main text of pages: the field against brute force, the reader against a plain one, and held-out pages."""

from __future__ import annotations

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemark.llm import pagetext

SCHEMA = "page_id long, url string, html string"


def texts(page):
    return [b.text for b in pagetext.blocks(page)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>One<p>Two <b>bold</b>ly<br>on", ["One", "Two boldly on"]),
        ("a<div>b</div>c", ["a", "b", "c"]),
        ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", ["x", "y", "1", "2", "3"]),
        ('<script>var t="</p><p>no";</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->', ["yes"]),
        ("<p>1 < 2 &amp; 3 &gt; 2 &eacute;&#x41;&#66;&nbsp;z", ["1 < 2 & 3 > 2 éAB z"]),
        ('<p title="a > b">in</p><p title=\'</p>\'>on</p>', ["in", "on"]),
        ('<p>before<a href="x>lost</p><p>text', ["beforelost", "text"]),
        ("<p>kept</p><p class=", ["kept"]),
        ("<title>t</title><textarea>form</textarea><p>  \t\n </p><p>x</p></div></p>", ["x"]),
        ("<p>x<script>never ends <p>y", ["x"]),
        ("", []), ("<", ["<"]), ("plain", ["plain"]), ("<!---->a<!-- b", ["a"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_reader_is_linear():
    for page in ("<a '" * 100_000, "<" * 400_000, "<div>" * 100_000, "<p" * 200_000, "<!-" * 200_000, "</x" * 100_000):
        pagetext.blocks(page)
    assert len(texts("<p>x" * 100_000)) == 100_000


def test_ancestors():
    (block,) = pagetext.blocks('<body><div class="side-bar userComments" id=Top><section><p>x')
    found = set(pagetext._within(block.ancestors))
    assert {"t:div", "t:section", "t:p", "t:body", "c:side", "c:bar", "c:user", "c:comments", "c:top"} == found


def chain(emissions, transitions, start, end, labels):
    score = start[labels[0]] + end[labels[-1]] + sum(e for e, y in zip(emissions, labels) if y)
    return score + sum(transitions[a][b] for a, b in zip(labels, labels[1:]))


def test_viterbi_against_all_labellings():
    r = np.random.default_rng(1)
    for length in (1, 2, 3, 7):
        for _ in range(20):
            e, t, s, f = r.normal(size=length).tolist(), r.normal(size=(2, 2)).tolist(), r.normal(size=2).tolist(), r.normal(size=2).tolist()
            best = max(itertools.product((0, 1), repeat=length), key=lambda y: chain(e, t, s, f, y))
            assert tuple(pagetext.viterbi(e, t, s, f)) == best
    assert pagetext.viterbi([], [[0, 0], [0, 0]], [0, 0], [0, 0]) == []


def test_likelihood_and_gradient():
    r = np.random.default_rng(2)
    pages = [[[f"f{r.integers(5)}" for _ in range(3)] for _ in range(n)] for n in (1, 4, 2)]
    labels = [r.integers(0, 2, len(p)).tolist() for p in pages]
    weights, shapes = np.zeros(pagetext.FEATURES), [(2, 2), (2,), (2,)]
    used = [pagetext.place(f"f{k}") for k in range(5)]
    weights[used] = r.normal(size=5)
    rest = [r.normal(size=s) for s in shapes]
    likelihood = pagetext.Likelihood(pages, labels)
    value, gradients = likelihood(weights, *rest)
    want = 0.0
    for page, own in zip(pages, labels):
        e = [sum(weights[pagetext.place(f)] for f in block) for block in page]
        every = [chain(e, *rest, y) for y in itertools.product((0, 1), repeat=len(page))]
        want += chain(e, *rest, own) - np.logaddexp.reduce(every)
    assert value == pytest.approx(want)
    for k, parameter in enumerate([weights, *rest]):
        for at in used if k == 0 else np.ndindex(parameter.shape):
            kept = parameter[at]
            parameter[at] = kept + 1e-5
            up = likelihood(weights, *rest)[0]
            parameter[at] = kept - 1e-5
            down = likelihood(weights, *rest)[0]
            parameter[at] = kept
            assert gradients[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return pagetext.train(pages.where("page_id % 2 = 0"))


def test_held_out_written_pages(pages, field):
    """Layouts drawn from texts that were not learned from."""
    r = random.Random(77)
    mains, wrong, total = [], 0, 0
    for row in pages.where("page_id % 2 = 1").limit(60).collect():
        page = pagetext.blocks(row.html)
        mains.append([b.text for b, y in zip(page, pagetext.labelled(page)) if y][:12])
    everything = [t for m in mains for t in m]
    for main in mains * 4:
        page, labels = pagetext.written(r, main, everything)
        found = pagetext.blocks(page)
        assert len(found) == len(labels)
        got = field.viterbi(field.emissions(pagetext.features(found)))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong < 0.03 * total


def article(page):
    """The article of a page of the given tables, read by hand."""
    inner = re.search(r"<article>(.*?)</article>", re.sub(r"<script>.*?</script>", "", page, flags=re.S), re.S).group(1)
    pieces = re.split(r"</?(?:h1|p)>", inner)
    cleaned = [" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in pieces]
    return "\n\n".join(c for c in cleaned if c)


def test_given_pages(pages, field):
    found = {r.page_id: r for r in pagetext.extract(pages, field).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    wrong = [r.page_id for r in rows if found[r.page_id].text != article(r.html)]
    assert len(wrong) <= 1 and all(r.n_chars == len(r.text) for r in found.values())


def test_unknown_layout(field):
    page = """<html><body><div id="top-menu"><a href=/>Home</a> <a href=/n>News</a></div><div class="cookie-notice">We use cookies.</div>
    <div class="post-content"><h1>How rivers move stones</h1><p>Water carries stones down the valley, a little further every spring, until they rest.</p>
    <div class="advert">Buy boots now!</div><p>In the plain, the river slows down and leaves them behind; the largest come to rest first.</p></div>
    <div id="comments"><h3>2 comments</h3><p>Nice, I never knew that.</p></div><div class="footer"><p>Copyright 2024</p></div></body></html>"""
    text = pagetext.decoder(field)(page)
    assert text.split("\n\n")[0] == "How rivers move stones" and "slows down" in text and "carries stones" in text
    assert not any(w in text for w in ("cookies", "boots", "comments", "never knew", "Copyright", "News"))


def test_edges(spark, field):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some text, as it was.</p></article>"), (4, "u", "<nav><a>x</a></nav>"), (5, "u", "<article>" + "<p>word after word, again.</p>" * 30_000)]
    rows += [rows[2], rows[2]]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"text": F.lit("mine"), "n_chars": F.lit(-1)})
    got = [tuple(r) for r in pagetext.extract(df, field).collect()]
    assert sorted(got, key=repr)[:1] == [(1, "u", "", 0)] and (2, None, "", 0) in got and (4, "u", "", 0) in got
    assert got.count((None, "u", "Some text, as it was.", 21)) == 3
    assert [r for r in got if r[0] == 5][0][3] == 30_000 * 23 + 29_999 * 2
    assert pagetext.extract(spark.createDataFrame([], SCHEMA)).collect() == []
