"""Scalar text rules as columns: white space, content, tokens, languages, headings, hashes."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from blockspark.schemas import ABBREVIATIONS

#: White space as Python's str methods know it, for Java patterns.
SPACE = r"[\s\x1c-\x1f]"
CJK = "[一-鿿가-힯぀-ゟ゠-ヿ]"
HANGUL, HAN = "[가-힯]", "[一-鿿]"
HANGUL_AND_JAMO, LATIN_AND_HANGUL = "[가-힯ᄀ-ᇿ]", "[a-zA-Z가-힯]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def count(c: Column | str, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(col(c), F.lit(pattern)), F.lit(0))


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"(?U)^{SPACE}+|{SPACE}+$", "")


def blank(c: Column | str) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def collapse(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(col(c), rf"(?U){SPACE}+", " "))


def first_full(*columns: Column | str) -> Column:
    """The first that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in columns], F.lit(""))


def content(markdown: Column | str = "markdown", text: Column | str = "text", caption: Column | str = "caption") -> Column:
    return first_full(markdown, text, caption)


def words(c: Column | str) -> Column:
    return F.when(blank(c), F.lit(0)).otherwise(F.size(F.split(strip(c), rf"(?U){SPACE}+")))


def tokens(c: Column | str, method: str = "simple") -> Column:
    """Estimated tokens: ``simple`` weighs scripts, anything else counts words."""
    if method != "simple":
        return words(c)
    text = F.coalesce(col(c), F.lit(""))
    cjk = count(text, CJK)
    return (cjk / F.lit(1.5) + (F.length(text) - cjk) / F.lit(4.0)).cast("int")


#: Runs of white space from this length on are handed to a byte-pair encoder apart: a pattern that looks ahead of each run overflows on longer ones.
LONG_SPACE = 10_000
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_RUN = re.compile(f"[{_WHITE}]{{{LONG_SPACE},}}")


def encoder_parts(text: str, newlines: bool) -> list[tuple[bool, str]]:
    """A text cut where byte-pair patterns cut it too: (whether it is one piece, part).

    The last character of a run of white space goes with what follows it. newlines: the
    pattern also ends a piece after the last line end of a run, and lets marks take the
    line ends behind them.
    """
    if len(text) < LONG_SPACE:
        return [(False, text)]
    out: list[tuple[bool, str]] = []
    past = 0
    for m in _LONG_RUN.finditer(text):
        start, end = m.span()
        if newlines and start and unicodedata.category(text[start - 1])[0] not in "LN":
            while start < end and text[start] in "\r\n":
                start += 1
        out.append((False, text[past:start]))
        last = max(text.rfind("\n", start, end), text.rfind("\r", start, end)) + 1 if newlines else 0
        stop = end if end == len(text) else max(start, last, end - 1)
        out += [(True, text[i:j]) for i, j in ((start, last), (max(start, last), stop)) if i < j]
        past = stop
    return [*out, (False, text[past:])]


def bpe_tokens(c: Column | str, ranks: str | None = None) -> Column:
    """Tokens by a byte-pair vocabulary file; without one, the simple estimate.

    An Arrow UDF, as no built-in expression can merge byte pairs.
    """
    if ranks is None:
        return tokens(c)
    @F.pandas_udf("int")
    def counted(texts: pd.Series) -> pd.Series:
        import base64

        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        pattern = r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
        encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        count_of = lambda one, part: len(encoding._encode_single_piece(part)) if one else len(encoding.encode_ordinary(part))
        return texts.map(lambda t: sum(count_of(*p) for p in encoder_parts(t or "", True)))

    return counted(col(c))


def language(c: Column | str) -> Column:
    """ko, zh, en or unknown, by shares of Hangul, Han and ASCII letters."""

    def judge(n: Column) -> Column:
        total = (n["ko"] + n["zh"] + n["en"]).cast("double")
        return F.when(total == 0, "unknown").when(n["ko"] > total * 0.3, "ko").when(n["zh"] > total * 0.3, "zh").when(n["en"] > total * 0.5, "en").otherwise("unknown")

    return bind(F.struct(count(c, HANGUL).alias("ko"), count(c, HAN).alias("zh"), count(c, "[a-zA-Z]").alias("en")), judge)


def language_pair(c: Column | str) -> Column:
    """ko or en; Jamo count for Korean but not among all letters."""
    ko, total = count(c, HANGUL_AND_JAMO), count(c, LATIN_AND_HANGUL)
    return F.when((total > 0) & (ko > total * F.lit(0.3)), "ko").otherwise("en")


def heading_level(text: Column | str, label: Column | str | None = None) -> Column:
    """1 to 3 or null: by label, else chapter patterns, capitals and title case of short lines."""
    t = strip(text)
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    title = t.rlike(r"[\p{Lu}\p{Lt}]") & ~t.rlike(rf"(?<!{cased})\p{{Ll}}") & ~t.rlike(rf"(?<={cased})[\p{{Lu}}\p{{Lt}}]")
    upper = t.rlike(r"\p{Lu}") & ~t.rlike(r"[\p{Ll}\p{Lt}]")
    guess = F.when(blank(text) | (words(text) >= 10), None).when(t.rlike(r"(?i)^(Chapter|Section) \d+"), 1).when(upper & (F.length(t) > 4), 2).when(title, 3)
    guess = guess.cast("int")
    return guess if label is None else F.when(col(label) == "Title", 1).when(col(label) == "Section-header", 2).otherwise(guess)


def anchor(page: Column | str = "page", type: Column | str = "type", order: Column | str = "reading_order") -> Column:
    short = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    abbreviation = F.coalesce(F.try_element_at(short, F.lower(col(type))), F.substring(col(type), 1, 3))
    return F.concat(F.lit("[@p"), col(page).cast("string"), F.lit("_"), abbreviation, F.coalesce(col(order).cast("string"), F.lit("None")), F.lit("]"))


def is_visual(type: Column | str = "type") -> Column:
    return F.lower(col(type)).isin("figure", "picture", "chart", "table", "formula")


def sha(c: Column | str, digits: int = 64) -> Column:
    return F.substring(F.sha2(col(c).cast("binary"), 256), 1, digits)


def doc_id(file: Column | str = "content") -> Column:
    return sha(file, 16)


def doc_id_of_pages(first_page: Column | str, seen: Column | str) -> Column:
    """The id of a document that came without its file: of its first page's picture, or of the time where it has no page."""
    return F.coalesce(sha(first_page, 16), sha(col(seen).cast("string"), 16))


def content_hash(c: Column | str = "text") -> Column:
    return sha(c, 12)


def text_hash(c: Column | str = "text") -> Column:
    """Hash of the lower-cased text with single spaces."""
    return sha(collapse(F.lower(col(c))))


def url_key(c: Column | str = "url") -> Column:
    """Lower case, slashes cut off the end, then all from the first question mark."""
    return F.substring_index(F.rtrim(F.lower(col(c)), F.lit("/")), "?", 1)


def url_hash(c: Column | str = "url") -> Column:
    return sha(url_key(c), 16)


def average_hash(pixels: Column | str) -> Column:
    """Sixteen hex digits of 64 grey values: a bit is set above their mean."""
    p = col(pixels)
    mean = F.aggregate(p, F.lit(0.0), lambda a, x: a + x, lambda a: a / F.size(p))
    bits = F.array_join(F.transform(p, lambda x: F.when(x > mean, "1").otherwise("0")), "")
    return F.lower(F.lpad(F.conv(bits, 2, 16), 16, "0"))


def preview(c: Column | str, length: int = 100) -> Column:
    return F.when(F.length(col(c)) > length, F.concat(F.substring(col(c), 1, length), F.lit("..."))).otherwise(col(c))


def citation(doc: Column | str, first: Column | str, last: Column | str, blocks: Column | str) -> Column:
    pages = F.when(col(first) == col(last), F.concat(F.lit("p."), col(first).cast("string"))).otherwise(F.concat(F.lit("p."), col(first).cast("string"), F.lit("-"), col(last).cast("string")))
    return F.concat(F.lit("[Source: "), col(doc).cast("string"), F.lit(", "), pages, F.lit(", blocks: "), col(blocks).cast("string"), F.lit("]"))


def comparable(c: Column | str) -> Column:
    """Letters, digits, underscores and single spaces only."""
    return collapse(F.regexp_replace(col(c), rf"(?U)[^\w{SPACE[1:-1]}가-힣]", " "))


def similarity(a: Column | str, b: Column | str) -> Column:
    """struct(ratio, longest): difflib's ratio of two texts and the length of their longest common substring."""
    @F.pandas_udf("ratio double, longest int")
    def compared(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        import difflib

        rows = []
        for x, y in zip(left.fillna(""), right.fillna(""), strict=True):
            m = difflib.SequenceMatcher(None, x, y)
            rows.append((m.ratio(), m.find_longest_match(0, len(x), 0, len(y)).size))
        return pd.DataFrame(rows, columns=["ratio", "longest"])

    return compared(col(a), col(b))
