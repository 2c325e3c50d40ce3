import html
import re

import numpy as np
import pytest

from blockspark.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="top"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies for all sorts of things and you may agree to every one of them here today.</p></div>
<aside><h2>Most read</h2><p>A very long teaser of some other article which goes on and on for very many words indeed.</p></aside>
<article><header><h1>The &quot;title&quot;</h1></header><p>First&nbsp;  paragraph<br>goes on <b>bold</b>.<p>Short.</p><!-- <p>hidden</p> -->
<ul><li>one</li><li>two &lt;b&gt;</li></ul><form><p>Sign up now for letters</p><input value="x"></form><p class="ad">Buy now</p>
<table><tr><td>a</td><td>b</td></tr></table><div class="comments"><article><p>I think this is the best article that I ever read in my life, really.</p></article></div></article>
<footer>&copy; 2020 Somebody who writes a lot of words in a footer, which no one ever reads at all.</footer></body></html>"""


def test_page():
    assert H.extract_texts([PAGE]) == ['The "title"\n\nFirst paragraph goes on bold.\n\nShort.\n\none\n\ntwo <b>\n\na b']


def test_without_article():
    text = " ".join(["word"] * 40)
    page = f"<nav><a href=x>Home</a></nav><div><h2>Heading</h2><p>{text}</p><p>{text}</p></div><p><a href=y>More links here</a></p>"
    assert H.extract_texts([page]) == [f"Heading\n\n{text}\n\n{text}"]


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<script>x", "<!-- x", "<a href='x", "&", "<div class=ad>x</div>", "</p></div></article>", "<article>" * 2000 + "</div>" * 10])
def test_no_text(page):
    assert H.extract_texts([page])[0] in ("", "<", "&", "<p", "<a href='x")


def test_broken_markup_is_quick():
    assert H.extract_texts(["<article><p>" + '<a "' * 20_000 + "x" * 200_000])[0]
    assert len(H.extract_texts(["<article><p>" + "w " * 300_000])[0]) == 599_999


def test_tree_fits_its_table_and_walks_as_one_by_one():
    rows = np.array(H.LABELLED, dtype=float)
    assert (H.is_text(rows[:, :-1]) == rows[:, -1]).all()
    feature, cut, child, value = H.tree()
    r = np.random.default_rng(0)
    x = np.stack([r.integers(0, 80, 300), r.random(300), r.integers(0, 80, 300), r.random(300), r.integers(0, 80, 300), r.random(300), *r.integers(0, 2, (3, 300))], axis=1)
    for row, got in zip(x, H.is_text(x), strict=True):
        k = 0
        while np.isfinite(cut[k]):
            k = child[k] + (row[feature[k]] > cut[k])
        assert got == (value[k] > 0.5)


def test_whole_table(spark, sf):
    from blockspark.llm.queries import op7_html_extract

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op7_html_extract(spark, sf).collect()
    assert len(got) == len(pages)
    for g in got:
        article = re.search(r"<article>(.*)</article>", pages[g.page_id], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert g.text == "\n\n".join(p for p in parts if p) and g.n_chars == len(g.text)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, "c"), (1, "u", "", "c"), (None, "u", "<article>x</article>", "c"), (None, "u", "<article>x</article>", "c")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in H.extract(df).collect()) == [(0, "x", 1), (0, "x", 1), (1, "", 0), (1, "", 0)]
    assert H.extract(df.limit(0)).count() == 0
