import html as H
import itertools
import math
import random
import re

import pytest

from relforge.llm import html_extract as X
from relforge.llm.dom import parse

SF = "/root/testdata/sf0.001"
PAGE = """<html><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies. Accept them, please.</div>
<main><article><h1>Title here</h1><p>First para&nbsp;graph with <b>bold</b>text &amp; more, and so on. It has several sentences.</p>
<div class="ad">Buy now this thing, it is great.</div><p>Second paragraph<br>is long enough too, with words.<p>Third &lt;one&gt;.
<aside class="sidebar">Related: other things.</aside><form><label>Mail</label><input><button>Go</button></form><ul><li>item one<li>item two</ul>
<section class="comments" id="comments"><h2>Comments</h2><p>Great article, I liked it very much. Thanks.</p></section></article></main>
<aside>Side bar text. More of it.</aside><footer>Copyright 2020. All rights.</footer><script>var x="<p>no</p>"</script><!-- <p>no</p> --></body></html>"""
TEXT = ("Title here First para graph with boldtext & more, and so on. It has several sentences. Second paragraph is long enough too, with words. "
        "Third <one>. item one item two")


@pytest.fixture(scope="module")
def pages():
    import duckdb
    return duckdb.connect().execute(f"select page_id, html from '{SF}/pages.parquet' order by page_id").fetchall()


@pytest.fixture(scope="module")
def weights(pages):
    return X.fit_pages([h for _, h in pages])


def article(html):
    part = html[html.index("<article>") : html.index("</article>")]
    part = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br|article|div)[^>]*>", "\n", part))
    return " ".join(H.unescape(part).split())


def test_articles_of_given_pages(weights):
    import duckdb
    rows = duckdb.connect().execute("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    assert all(X.extract(html, weights) == article(html) for html, in rows)
    plain = [re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", html) for html, in rows]  # no sectioning tags
    assert sum(X.extract(p, weights) == article(html) for p, (html,) in zip(plain, rows)) >= 0.95 * len(rows)


def test_parts_that_are_no_article(weights):
    assert X.extract(PAGE, weights) == TEXT
    assert X.extract(PAGE.replace("<article>", '<div class="post">').replace("</article>", "</div>").replace("main>", "div>"), weights) == TEXT
    assert X.extract(PAGE, X.Weights()) == TEXT  # expectations alone


PROSE = "<p>Some prose about a thing, told at length. It has two sentences and more.</p>"


@pytest.mark.parametrize("wrap", ["article", "div"])
@pytest.mark.parametrize("part, kept", [
    ('<p class="notice-board">The board met on Monday, and it was long. They agreed on all points.</p>', True),
    ('<p class="alert">The alert was raised by the guards, at dawn. Nobody in the town slept.</p>', True),
    ('<p id="footer-note-1">A note about the source, with its date and its place. It is cited.</p>', True),
    ('<figure><img><figcaption>A caption of the picture.</figcaption></figure>', True),
    ('<address>By A. Writer, 12 Long Street</address>', True),
    ('<p class="ad">Buy now!</p>', False), ('<p class="advert">Buy this great thing now, it is cheap and good. Order it today.</p>', False),
    ('<p class="notice">We use cookies.</p>', False), ('<div class="notice"><p>We use cookies, as you know, on all pages. Accept them.</p></div>', False),
    ('<div class="comments"><p>Great article, I liked it very much. Thanks.</p></div>', False), ('<p class="copyright">© 2020 All rights.</p>', False),
    ('<div id="comments"><div><p>First of all, great article, I liked it. Thanks.</p><ul><li>Reply to it, and more. Yes.</ul></div></div>', False),
    ('<form><p>Your mail, please, so that we can write to you. Thank you.</p></form>', False),
    ('<div class="sidebar"><p>In the margin there is more, as is known. See there.</p></div>', False), ('<ul class="related"><li>Other story<li>More</ul>', False),
])
def test_names_on_containers_decide_and_on_paragraphs_weigh(weights, wrap, part, kept):
    page = (f"<html><body><nav><a href=x>Home</a></nav><{wrap}><h1>Title of it</h1>{PROSE * 2}{part}{PROSE}</{wrap}>"
            "<footer><address>Mail us, please. It is free.</address>c</footer></body></html>")
    plain = lambda html: " ".join(re.sub(r"<[^>]*>", " ", html).split())
    assert X.extract(page, weights) == plain(f"Title of it {PROSE * 2} {part if kept else ''} {PROSE}")


def test_marginals_equal_enumeration():
    """Sum-product on small random trees against the sum over all labellings."""
    rng = random.Random(7)
    tags = ["div", "p", "b", "#", "section", "a"]
    for _ in range(40):
        page = X.Page()
        for _ in range(rng.randrange(1, 9)):
            page.add(rng.choice(tags), rng.randrange(len(page.tag)), text="t")
        n = len(page.tag)
        unary = [rng.uniform(-3, 3) for _ in range(n)]
        weights = X.Weights()
        tables = {k: tuple(rng.uniform(0.2, 4) for _ in range(4)) for k in X.KINDS}
        odds, _, _ = X.sum_product(page, unary, tables)
        mass = [[0.0, 0.0] for _ in range(n)]
        for y in itertools.product((0, 1), repeat=n):
            p = math.exp(sum(u for u, v in zip(unary, y) if v))
            for i in range(1, n):
                p *= tables[X.kind_of(page.tag[i])][2 * y[page.parent[i]] + y[i]]
            for i in range(n):
                mass[i][y[i]] += p
        assert all(abs(odds[i] - math.log(mass[i][1] / mass[i][0])) < 1e-9 for i in range(n))
        assert weights.tables()


def test_training_raises_the_likelihood(pages):
    def loss(weights):
        total = 0.0
        for _, html in pages[:30]:
            page = parse(html)
            gold, (found, mute) = X.labels(page), X.features(page)
            odds, _, _ = X.sum_product(page, X._unary(found, mute, weights), weights.tables())
            total += sum(math.log1p(math.exp(-o if y else o)) for o, y, m in zip(odds, gold, mute) if not m)
        return total
    assert loss(X.fit_pages([h for _, h in pages[30:]])) < 0.5 * loss(X.Weights())


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<", "<"), ("a < b", "a < b"), ("plain text only. It is a text.", "plain text only. It is a text."), ("<p>a<br>b</p>c &lt;x&gt;", "a b c <x>"),
    ("<p>never closed <b>at all", "never closed at all"), ("<!-- open", ""), ("<script>x", ""), ("<p a='>'>q</p>", "q"), ("<P CLASS=x>Up</P>", "Up"), ("</p></div>x", "x"),
])
def test_broken_markup(weights, html, text):
    assert X.extract(html, weights) == text


def test_deep_and_long_pages(weights):
    assert X.extract("<div>" * 20_000 + "<p>deep text is here. It is deep.</p>" + "</div>" * 20_000, weights) == "deep text is here. It is deep."
    long = "word. " * 200_000
    assert X.extract(f"<article><p>{long}</p></article>", weights) == long.strip()
    assert X.extract('<a b="' * 3000, weights) is not None


def test_in_spark(spark, pages, weights):
    frame = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in X.extract_pages(frame, X.fit(frame)).collect()}
    assert {i: r.text for i, r in out.items()} == {i: article(h) for i, h in pages}
    assert all(r.n_chars == len(r.text) for r in out.values())
    odd = spark.createDataFrame([(1, None, None, 5), (None, "http://x", "", 6), (2, "u", "<p>Some text, with words. Yes.</p>", 7), (2, "u", "<p>Some text, with words. Yes.</p>", 7)],
                                "page_id long, url string, html string, text long")
    rows = X.extract_pages(odd, weights).collect()
    assert sorted(r.text for r in rows) == ["", "", *["Some text, with words. Yes."] * 2]
    empty = odd.limit(0)
    assert X.extract_pages(empty, X.fit(empty)).count() == 0
