"""Literal rows with values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from blockspark.functions import geometry as G
from blockspark.functions import json_text as J
from blockspark.functions import markdown as M
from blockspark.functions import text as T


def one(spark, column, **values):
    row = spark.range(1).select(*[(F.lit(v) if not isinstance(v, F.Column) else v).alias(k) for k, v in values.items()] or [F.lit(0).alias("none")])
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize("text,want", [("한국어 텍스트와 mixed 漢字 かな カナ", 11), ("", 0), ("a😀b", 0), (None, 0), ("x" * 900, 225)])
def test_tokens(spark, text, want):
    assert one(spark, T.tokens("t"), t=F.lit(text).cast("string")) == want


@pytest.mark.parametrize(
    "url,want",
    [("http://x.com/a", "acc79c8b808070cc"), ("HTTP://X.com/a/", "acc79c8b808070cc"), ("http://x.com/a/?q=1", "bcd9543977557abf"), ("http://x.com/a/?q=1#top", "bcd9543977557abf"), ("http://x.com/a#top", "3f0df414d9c52e95")],
)
def test_url_hash(spark, url, want):
    assert one(spark, T.url_hash("u"), u=url) == want


@pytest.mark.parametrize("text,four,two", [("가나다abc", "ko", "ko"), ("12", "unknown", "en"), ("", "unknown", "en"), ("가" * 31 + "a" * 69, "ko", "ko"), ("가" * 30 + "a" * 70, "en", "en"), ("ᄀᄁ", "unknown", "en"), ("漢字", "zh", "en")])
def test_languages(spark, text, four, two):
    assert one(spark, T.language("t"), t=text) == four and one(spark, T.language_pair("t"), t=text) == two


@pytest.mark.parametrize("type,order,want", [("caption", 3, "[@p1_cap3]"), ("picture", 0, "[@p1_fig0]"), ("Formula", 2, "[@p1_eq2]"), ("text", None, "[@p1_txtNone]")])
def test_anchor(spark, type, order, want):
    assert one(spark, T.anchor("p", "t", "o"), p=1, t=type, o=F.lit(order).cast("int")) == want


@pytest.mark.parametrize("text", ["Chapter 1 of it", "ALL CAPS", "ABCD", "Title Case Here", "They'Re Here", "They're here", "", "Élan Vital", "ÉLAN VITAL", "X1Y", "1a", "One two Three", "Ǆ", "word"])
def test_heading_level(spark, text):
    import re

    t = text.strip()
    want = None
    if t and len(t.split()) < 10:
        want = 1 if re.match(r"(Chapter|Section) \d+", t, re.IGNORECASE) else 2 if t.isupper() and len(t) > 4 else 3 if t.istitle() else None
    assert one(spark, T.heading_level("t"), t=text) == want


def test_content_and_strip(spark):
    assert one(spark, T.content("m", "t", "c"), m="", t="t", c="c") == "t"
    assert one(spark, T.content("m", "t", "c"), m=F.lit(None).cast("string"), t="", c="") == ""
    odd = "\x1c\x1f\x85  x y 　\n"
    assert one(spark, T.strip("t"), t=odd) == odd.strip()
    assert one(spark, T.collapse("t"), t="a\x1c b\n c") == "a b c"
    assert one(spark, T.words("t"), t=" a  b\nc ") == 3 and one(spark, T.words("t"), t=" ") == 0


def test_hashes_and_labels(spark):
    import hashlib

    assert one(spark, T.content_hash("t"), t="é") == hashlib.sha256("é".encode()).hexdigest()[:12]
    assert one(spark, T.text_hash("t"), t=" A  b\n") == hashlib.sha256(b"a b").hexdigest()
    assert one(spark, T.doc_id("t"), t=F.lit(b"abc")) == hashlib.sha256(b"abc").hexdigest()[:16]
    assert one(spark, T.citation("d", "a", "b", "n"), d="x", a=1, b=1, n=2) == "[Source: x, p.1, blocks: 2]"
    assert one(spark, T.citation("d", "a", "b", "n"), d="x", a=1, b=3, n=2) == "[Source: x, p.1-3, blocks: 2]"
    assert one(spark, T.preview("t"), t="x" * 101) == "x" * 100 + "..."
    pixels = [0] * 60 + [255] * 4
    assert one(spark, T.average_hash("p"), p=F.array(*[F.lit(x) for x in pixels])) == "000000000000000f"
    assert one(spark, T.similarity("a", "b")["longest"], a="abcd", b="xbcy") == 2
    assert one(spark, T.bpe_tokens("t", "/opt/tokenizers/byte_bpe_50k.tiktoken"), t="hello world") == 2


def test_html_table(spark):
    table = lambda h: one(spark, M.html_table("h"), h=h)
    assert table("<p>no</p>") is None
    assert table("<table><tr></tr></table>") is None
    html = "<table><tr><th colspan=2>A &amp; B</th><th>c</th></tr><tr><td>1</td></tr><tr></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"
    assert table(html) == "| A & B |  | c |\n|---|---|---|\n| 1 |  |  |\n| 1 | 2 | 3 |"


def test_images(spark):
    assert one(spark, M.image_links("t"), t="a ![x](y.png) ![](z)") == 2
    assert one(spark, M.image_parts("t"), t="a ![x](y) \n ![z](w)b") == ["a ", "![x](y)", "![z](w)", "b"]
    assert one(spark, M.absolute_images("t", "/out/"), t="![x](./y.png)") == "![x](/out/y.png)"
    assert one(spark, M.page_marks("t"), t="<!-- Page 2 --> <!-- Page 10 -->") == 2


def test_geometry(spark):
    box = F.array(F.lit(-3.5), F.lit(2.9), F.lit(700.0), F.lit(10.0))
    assert one(spark, G.clamped("b", F.lit(600), F.lit(800)), b=box) == [0, 2, 600, 10]
    assert one(spark, G.has_area("b"), b=F.array(F.lit(1), F.lit(1), F.lit(1), F.lit(5))) is False
    assert one(spark, G.centre(G.corners("b"), 0), b=box) == 348.25
    assert one(spark, G.shifted(G.corners("b"), F.lit(1.0), F.lit(2.0)), b=box)[0] == [-2.5, 4.9]


@pytest.mark.parametrize(
    "text,want",
    [
        ('think {"page_elements": [1]} end', '{"page_elements": [1]}'), ("", ""), ("no json", ""), ('{"a": 1} {"b": 2}', '{"a": 1}'), ('x {bad} {"ok": {"y": 1}} z', '{"ok": {"y": 1}}'),
        ('{"page_elements": [1]} and {"c": 3}', '{"page_elements": [1]}'),
    ],
)
def test_elements_json(spark, text, want):
    assert one(spark, J.elements_json("t"), t=text) == want


def test_loose_json_and_captions(spark):
    loose = lambda t: one(spark, J.loose_json("t"), t=t)
    assert loose('{"a":1}') == '{"a":1}' and loose('x ```json\n{"a": 1}\n``` y') == '{"a": 1}' and loose('so {"a": {"b": 1}} it is') == '{"a": {"b": 1}}' and loose("none") is None
    said = lambda t, k: one(spark, J.caption_text("t", F.lit(k)), t=t)
    assert said('{"chart_type":"bar","title":"T","data_summary":"up"}', "chart") == "Bar chart. titled 'T'. showing up"
    assert said('{"title":"T","row_count":3,"columns":["a","b","c","d","e","f"],"summary":"s"}', "table") == "Table: T. 3 rows. Columns: a, b, c, d, e. s"
    assert said('{"type":"photo","description":"d","key_elements":["a","b","c","d"]}', "figure") == "Photo. d. Key elements: a, b, c"
    assert said("raw", "chart") == "raw" and said('{"x":1}', "formula") == '{"x":1}' and said("{}", "chart") == "{}"
    assert one(spark, J.key_info("t"), t='so {"a": 1} end') == '{"a": 1}' and one(spark, J.key_info("t"), t="none") == '{"raw":"none"}'
