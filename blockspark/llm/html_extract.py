"""HTML extraction: flat text blocks, their neighbours, and a small decision tree.

A page becomes a flat list of text blocks. Each has its word count and link density,
those of the blocks before and after it, and three marks of the markup around it:
whether a container names itself boilerplate (element, role, class or id), whether an
article or main element holds it, and whether it is a heading. A decision tree grown
from LABELLED, a small table of such blocks, says which blocks are text.

Null and empty pages, and those without text, give the empty text. Unclosed elements,
stray ends and unclosed comments are taken as browsers do, roughly: an unclosed script
or comment hides what follows. Pages of any length are taken whole; repeated rows are
extracted each; other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import map_batches

FEATURES = ("words", "link", "words_before", "link_before", "words_after", "link_after", "boilerplate", "article", "heading")
#: Blocks labelled by hand: the features, then 1 for text.
LABELLED = (
    # bars of links
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (6, 1.0, 3, 1.0, 8, 0.0, 0, 0, 0, 0), (12, 0.9, 0, 0.0, 40, 0.0, 0, 0, 0, 0), (25, 0.8, 4, 1.0, 30, 0.7, 0, 0, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0), (3, 1.0, 2, 1.0, 2, 1.0, 1, 1, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 0, 1, 0, 0), (4, 1.0, 30, 0.0, 3, 1.0, 0, 1, 0, 0), (3, 1.0, 4, 1.0, 40, 0.0, 0, 1, 0, 0),
    # notices, adverts, forms, sidebars, comments, footers that say so
    (9, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0), (40, 0.0, 60, 0.0, 5, 0.0, 1, 0, 0, 0), (120, 0.0, 80, 0.0, 70, 0.0, 1, 0, 0, 0), (14, 0.1, 90, 0.0, 0, 0.0, 1, 0, 0, 0), (55, 0.0, 70, 0.0, 66, 0.0, 1, 1, 0, 0), (4, 0.0, 12, 0.0, 35, 0.0, 1, 0, 1, 0), (3, 0.0, 50, 0.0, 20, 0.0, 1, 1, 1, 0),
    (300, 0.0, 10, 0.0, 12, 0.0, 1, 0, 0, 0), (18, 0.3, 25, 0.2, 9, 0.0, 1, 1, 0, 0), (1, 0.0, 2, 0.0, 1, 0.0, 1, 1, 0, 0),
    # short loose lines without an article around them
    (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 4, 0.0, 3, 1.0, 0, 0, 0, 0), (7, 0.2, 2, 0.0, 4, 0.0, 0, 0, 0, 0), (8, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0), (6, 0.0, 5, 0.0, 6, 0.0, 0, 0, 0, 0), (9, 0.4, 45, 0.0, 2, 1.0, 0, 0, 0, 0),
    # running text without an article around it
    (24, 0.0, 7, 0.0, 30, 0.0, 0, 0, 0, 1), (60, 0.05, 24, 0.0, 55, 0.0, 0, 0, 0, 1), (150, 0.0, 2, 1.0, 4, 0.0, 0, 0, 0, 1), (35, 0.2, 40, 0.0, 28, 0.1, 0, 0, 0, 1), (18, 0.0, 60, 0.0, 44, 0.0, 0, 0, 0, 1), (5, 0.0, 70, 0.0, 66, 0.0, 0, 0, 0, 1), (2, 0.0, 33, 0.0, 41, 0.0, 0, 0, 0, 1),
    (7, 0.0, 1, 1.0, 50, 0.0, 0, 0, 1, 1), (4, 0.0, 80, 0.0, 45, 0.0, 0, 0, 1, 1), (20, 0.1, 55, 0.0, 3, 0.0, 0, 0, 0, 1), (400, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (30, 0.0, 3, 0.0, 2, 1.0, 0, 0, 0, 1),
    # text in an article, however short
    (8, 0.0, 9, 0.0, 40, 0.0, 0, 1, 1, 1), (1, 0.0, 9, 0.0, 1, 0.0, 0, 1, 1, 1), (2, 0.0, 60, 0.0, 30, 0.0, 0, 1, 1, 1), (1, 0.0, 12, 0.0, 14, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 1.0, 1, 0.0, 0, 1, 0, 1), (2, 0.0, 2, 0.0, 1, 1.0, 0, 1, 0, 1), (3, 0.0, 100, 0.0, 0, 0.0, 0, 1, 0, 1),
    (45, 0.0, 8, 0.0, 60, 0.0, 0, 1, 0, 1), (300, 0.02, 45, 0.0, 8, 0.0, 0, 1, 0, 1), (12, 0.3, 40, 0.0, 25, 0.0, 0, 1, 0, 1), (20, 0.6, 30, 0.0, 28, 0.0, 0, 1, 0, 1), (6, 0.5, 5, 0.0, 7, 0.0, 0, 1, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 6, 1.0, 4, 1.0, 0, 1, 0, 1),
    (9, 1.0, 4, 0.0, 50, 0.0, 0, 1, 1, 1), (2, 1.0, 1, 1.0, 20, 0.0, 0, 1, 1, 1),
)

_HIDDEN = "script|style|noscript|template|svg|math|iframe|object|canvas|video|audio|select|textarea|button|title|datalist"
TAG = re.compile(rf"""<!--(?:>|->|.*?(?:--!?>|\Z))|<({_HIDDEN})\b(?:[^>"']+|"[^"]*"|'[^']*')*+(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.DOTALL | re.IGNORECASE)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
CONTAINERS = frozenset("div section article main nav header footer aside form ul ol dl table figure details dialog menu fieldset body center blockquote".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
SPACED = frozenset(("br", "td", "th", "input", "embed"))
BOILERPLATE = frozenset(("nav", "footer", "aside", "form", "dialog", "menu"))
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense adslot sponsor sponsored sponsors promo promos promotion promoted sidebar sidebars sidenav rail nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs header masthead topbar footer footnav copyright colophon cookie cookies cookiebar gdpr consent notice notices alert alerts popup modal overlay lightbox newsletter subscribe subscription signup login signin search searchbox share sharing sharebar social related recommended recommendations readmore comment comments commentlist commentbox respond reply replies discussion disqus widget widgets toolbar pagination pager paging skip disclaimer banner banners teaser teasers".split()
)
#: Names of the article itself, which outweigh the words above on one element.
OWN = frozenset("article post entry content main story body text".split())


def kind(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(boilerplate, article, header) as an opening tag says of itself."""
    article = tag in ("article", "main")
    if not attributes or attributes.isspace():
        return tag in BOILERPLATE, article, tag == "header"
    bad, header, own = tag in BOILERPLATE, tag == "header", article
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()))
            if words & OWN and tag not in BOILERPLATE and not words & NAMES - {"header"}:
                own = True
            header |= "header" in words
            bad |= bool(words & NAMES - {"header"}) and tag not in ("body", "article", "main")
        elif name == "role":
            bad |= value in ROLES and value != "banner"
            header |= value == "banner"
            article |= value in ("main", "article")
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            bad = True
    return bad, article or own and tag in ("div", "section") and not bad and _whole(attributes), header


def _whole(attributes: str) -> bool:
    """Whether class or id is one of the usual names of an article's container."""
    return bool(re.search(r"""(?:class|id)\s*=\s*["']?[^"'>]*\b(?:article|post|entry|story|main)(?:-?(?:content|body|text))?\b""", attributes, re.IGNORECASE))


def blocks(html: str | None) -> list[tuple[str, int, int, int, int, int]]:
    """(text, words, words in links, boilerplate, article, heading) of each block in page order."""
    if not html:
        return []
    found: list[tuple[str, int, int, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []
    bad = article = header = links = heading = own = 0

    def add(raw: str) -> None:
        if raw:
            parts.append(raw)
            if links:
                linked.append(raw)

    def flush() -> None:
        if not parts:
            return
        words = entities.unescape("".join(parts)).split()
        if words:
            inside = len(entities.unescape(" ".join(linked)).split())
            boiler = bad > 0 or own > 0 or header > 0 and not (article and heading)
            found.append((" ".join(words), len(words), min(inside, len(words)), int(boiler), int(article > 0), int(heading > 0)))
        parts.clear()
        linked.clear()

    past, last = 0, html.rfind(">") + 1
    opened: Counter[str] = Counter()
    for m in TAG.finditer(html, 0, last):
        if m.start() > past:
            add(html[past : m.start()])
        past = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1] and m[1].lower() in ("button", "select", "textarea", "iframe", "video", "audio", "object"):
                add(" ")
            continue
        end = bool(m[2] or m[5])
        if tag == "a":
            links = 0 if end else 1
        elif tag in INLINE:
            if end or tag != "span" and tag != "small":
                continue
        elif tag in SPACED:
            add(" ")
        else:
            flush()
            links = own = 0
            if tag in HEADINGS:
                heading = 0 if end else 1
            elif heading:
                heading = 0
            if tag not in CONTAINERS:
                own = int(not end and kind(tag, m[4] or m[7] or "")[0])
            else:
                if not end:
                    flags = kind(tag, m[4] or m[7] or "")
                    stack.append((tag, *flags))
                    opened[tag] += 1
                    bad, article, header = bad + flags[0], article + flags[1], header + flags[2]
                elif opened[tag]:
                    while True:
                        name, b, a, h = stack.pop()
                        opened[name] -= 1
                        bad, article, header = bad - b, article - a, header - h
                        if name == tag:
                            break
    # a script or comment that never ends hides the rest
    unfinished = re.search(rf"<(?:!--|(?:{_HIDDEN})\b)", html[past:], re.IGNORECASE)
    add(html[past : past + unfinished.start()] if unfinished else html[past:])
    flush()
    return found


def features(found: list[tuple[str, int, int, int, int, int]]) -> list[tuple[float, ...]]:
    """The rows the tree looks at, in the order of FEATURES."""
    ends = (0, 0.0)
    own = [(n, k / n) for _, n, k, *_ in found]
    return [(*o, *before, *after, b, a, h) for o, before, after, (*_, b, a, h) in zip(own, [ends, *own], [*own[1:], ends], found, strict=False)]


def grow(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A decision tree down to pure leaves by Gini impurity, flat: feature, cut, left child (right follows), value."""
    feature, cut, child, value = [0], [np.inf], [0], [0.0]
    todo = [(0, np.arange(len(y)))]
    while todo:
        k, rows = todo.pop()
        value[k] = float(y[rows].mean())
        best = (np.inf, -1, 0.0)
        if 0 < value[k] < 1:
            for j in range(x.shape[1]):
                levels = np.unique(x[rows, j])
                for c in (levels[:-1] + levels[1:]) / 2:
                    below = x[rows, j] <= c
                    n, p, q = below.sum(), y[rows][below].mean(), y[rows][~below].mean()
                    impurity = n * p * (1 - p) + (len(rows) - n) * q * (1 - q)
                    if impurity < best[0] - 1e-12:
                        best = (impurity, j, float(c))
        if best[1] >= 0:
            left = len(feature)
            below = x[rows, best[1]] <= best[2]
            feature[k], cut[k], child[k] = best[1], best[2], left
            feature += [0, 0]
            cut += [np.inf, np.inf]
            child += [left, left + 1]
            value += [0.0, 0.0]
            todo += [(left, rows[below]), (left + 1, rows[~below])]
    return np.array(feature), np.array(cut), np.array(child), np.array(value)


@lru_cache(maxsize=1)
def tree() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows = np.array(LABELLED, dtype=float)
    return grow(rows[:, :-1], rows[:, -1])


def is_text(x: np.ndarray) -> np.ndarray:
    """The tree's verdict on each row, all walked together."""
    feature, cut, child, value = tree()
    at = np.zeros(len(x), dtype=int)
    rows = np.arange(len(x))
    while True:
        after = child[at] + (x[rows, feature[at]] > cut[at])
        if (after == at).all():
            return value[at] > 0.5
        at = after


def extract_texts(pages: list[str | None]) -> list[str]:
    """The main text of each page; the blocks of all are classified at once."""
    found = [blocks(p) for p in pages]
    rows = [r for f in found for r in features(f)]
    keep = is_text(np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))) if rows else np.zeros(0, bool)
    texts, past = [], 0
    for f in found:
        texts.append("\n\n".join(b[0] for b, k in zip(f, keep[past : past + len(f)], strict=True) if k))
        past += len(f)
    return texts


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with ``text`` and ``n_chars``, one row per page."""

    def run(batch: pa.RecordBatch) -> list:
        texts = extract_texts(batch.column(len(keep)).to_pylist())
        return [*[batch.column(i) for i in range(len(keep))], texts, list(map(len, texts))]

    picked = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    columns = ", ".join(f"`{c}` {picked.schema[c].dataType.simpleString()}" for c in keep)
    return map_batches(picked, run, f"{columns}, text string, n_chars long", text=len(keep))
