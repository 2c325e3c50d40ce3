"""Blocks and elements as markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockspark.functions.text import SPACE, col, first_full, strip


IMAGE = r"[!]\[[^\]]*][(][^)]+[)]"


def plus(*parts: Column | str) -> Column:
    """Concatenation in which null is empty; strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def text_block(type: Column | str = "type", text: Column | str = "text", order: Column | str = "reading_order") -> Column:
    t, x = col(type), F.coalesce(col(text), F.lit(""))
    return F.when(t == "title", plus("# ", x)).when(t == "section_header", plus("## ", x)).when(t == "caption", plus("*", x, "*")).when(t == "footnote", plus("[^", F.coalesce(col(order).cast("string"), F.lit("None")), "]: ", x)).otherwise(x)


def visual_block(type: Column | str = "type", anchor: Column | str = "anchor", caption: Column | str = "caption", image: Column | str = "image_path") -> Column:
    t = col(type)
    said = F.coalesce(F.nullif(col(caption), F.lit("")), F.lit("No description available"))
    tail = plus(col(anchor), "\n\n*", said, "*")
    picture = F.when(first_full(image) != "", plus("![", t, "](", col(image), ")\n\n*", said, "*"))
    return F.when(t == "chart", plus("[Chart] ", tail)).when(t == "formula", plus("[Formula] ", tail)).otherwise(F.coalesce(picture, plus("[Figure] ", tail)))


def figure_block(type: Column | str = "type", page: Column | str = "page", caption: Column | str = "caption", image: Column | str = "image_path") -> Column:
    alt = F.coalesce(F.nullif(col(caption), F.lit("")), plus(col(type), " on page ", col(page)))
    head = F.when(first_full(image) != "", plus("![", alt, "](", col(image), ")")).otherwise(plus("[", F.initcap(col(type)), "]"))
    return plus(head, F.when(first_full(caption) != "", plus("\n\n*Figure: ", col(caption), "*")))


def table_block(text: Column | str = "text", caption: Column | str = "caption", structure: Column | str | None = None) -> Column:
    said = F.when(first_full(caption) != "", plus("\n\n*Table: ", col(caption), "*"))
    plain = F.when(first_full(text) != "", plus("[Table]\n\n```\n", col(text), "\n```", said)).otherwise(plus("[Table]", said))
    return plain if structure is None else F.coalesce(F.concat(html_table(structure), F.coalesce(said, F.lit(""))), plain)


def block(with_anchors: bool = False, structure: Column | str | None = None) -> Column:
    """A block of the writer: by type, the anchor only behind plain text."""
    t = col("type")
    titled = strip(first_full("text", "markdown"))
    plain = first_full("markdown", "text")
    if with_anchors:
        plain = F.when((plain != "") & (first_full("anchor") != ""), plus(plain, " ", col("anchor"))).otherwise(plain)
    return (
        F.when(t.isin("title", "doc_title"), plus("# ", titled))
        .when(t.isin("section_title", "paragraph_title"), plus("## ", titled))
        .when(t == "table", table_block(structure=structure))
        .when(t.isin("figure", "chart"), figure_block())
        .when(t.isin("header", "footer"), plus("*", titled, "*"))
        .otherwise(plain)
    )


def footer(doc: str = "doc_id", pages: str = "total_pages", created: str = "created_at", version: str = "parser_version", title: str = "title") -> Column:
    """Lines of the metadata table, a line feed between."""
    head = plus("\n---\n\n## Document Metadata\n\n| Property | Value |\n" + f"|{10 * '-'}|{7 * '-'}|\n" + "| Document ID | `", col(doc), "` |\n| Pages | ", col(pages), " |\n| Processed | ", col(created), " |\n| Parser Version | ", col(version), " |")
    return plus(head, F.when(first_full(title) != "", plus("\n| Title | ", col(title), " |")))


def element(type: Column | str, content: Column | str, metadata: Column | str) -> Column:
    """An element of the model's answer as markdown; metadata may be null."""
    t, c, m = col(type), F.coalesce(col(content), F.lit("")), col(metadata)
    number = F.coalesce(F.try_element_at(m, F.lit("section_number")), F.lit(""))
    numbered = F.when(number != "", plus(number, " ", c)).otherwise(c)
    figure = plus("![", F.coalesce(F.try_element_at(m, F.lit("figure_number")), F.lit("")), ": ", F.coalesce(F.try_element_at(m, F.lit("caption")), c), "](placeholder)")
    return (
        F.when(t == "title", plus("# ", c))
        .when(t == "author", plus("**Authors**: ", c))
        .when(t == "affiliation", plus("*", c, "*"))
        .when(t == "abstract", plus("## Abstract\n\n", c))
        .when(t == "section", plus("## ", numbered))
        .when(t == "subsection", plus("### ", numbered))
        .when(t == "figure", figure)
        .otherwise(c)
    )


def html_table(html: Column | str) -> Column:
    """The first table of a page as markdown, or null.

    The first row with cells is the header; a cell's colspan adds blank cells; other
    rows are filled up or cut to the header's width. For well-formed tables that are
    not nested.
    """
    table = F.regexp_extract(col(html), r"(?is)<table\b[^>]*>(.*?)</table>", 1)
    rows = F.transform(F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1), _cells)
    full = F.filter(rows, lambda r: F.size(r) > 0)
    header = F.get(full, F.lit(0))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    width = F.size(header)
    body = F.transform(F.slice(full, 2, F.greatest(F.size(full), F.lit(1))), lambda r: line(F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), 1, width)))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width), "|"), F.lit("|"))
    return F.when(F.size(full) > 0, F.array_join(F.concat(F.array(line(header), rule), body), "\n"))


def _cells(row: Column) -> Column:
    pattern = F.lit(r"(?is)<t[dh]\b[^>]*>.*?</t[dh]>")

    def cell(raw: Column) -> Column:
        pieces = F.transform(F.split(F.regexp_replace(raw, r"(?is)^<t[dh]\b[^>]*>|</t[dh]>$", ""), r"(?s)<[^>]*>"), strip)
        text = F.array_join(pieces, "")
        for entity, letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(letter))
        span = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(raw, r"(?is)^<t[dh]\b[^>]*?\bcolspan\s*=\s*[\"']?(\d{1,4})", 1), F.lit("")), F.lit("9999")).cast("int"), F.lit(1))
        return F.concat(F.array(text), F.array_repeat(F.lit(""), F.greatest(span - 1, F.lit(0))))

    return F.flatten(F.transform(F.regexp_extract_all(row, pattern, 0), cell))


def image_links(c: Column | str) -> Column:
    return F.coalesce(F.regexp_count(col(c), F.lit(IMAGE)), F.lit(0))


def page_marks(c: Column | str) -> Column:
    return F.coalesce(F.regexp_count(col(c), F.lit(r"<!-- Page \d+ -->")), F.lit(0))


def absolute_images(c: Column | str, folder: str) -> Column:
    """Links to images by their place under ``folder``, a leading ./ dropped."""
    return F.regexp_replace(col(c), r"[!]\[([^\]]*)][(](?:\./)?([^)/][^)]*)[)]", f"![$1]({folder.rstrip('/')}/$2)")


def image_parts(c: Column | str) -> Column:
    """Text and image links in their order, blank parts dropped."""
    marked = F.regexp_replace(col(c), f"({IMAGE})", "\u0001$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda p: ~(F.coalesce(F.regexp_replace(p, rf"(?U){SPACE}+", ""), F.lit("")) == ""))
