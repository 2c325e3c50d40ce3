"""Blocks from a model's answers and from markdown, and their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockspark.functions import json_text as J
from blockspark.functions import markdown as M
from blockspark.functions import text as T
from blockspark.schemas import ELEMENT_TYPES, ELEMENTS, MODEL_CONFIDENCE, PARSER_SOURCE, TEXT_TYPES, VISUAL_TYPES


def element_blocks(responses: DataFrame) -> DataFrame:
    """One row per page element of (doc_id, page, response); answers without any give no row.

    A missing type is a paragraph, an unknown one text; null metadata counts as empty.
    """
    parsed = responses.withColumn("e", F.from_json(J.elements_json("response"), ELEMENTS)["page_elements"])
    # an inner explode would bring a filter on its input's size, which makes and parses each answer once more
    rows = parsed.select("doc_id", "page", F.posexplode_outer("e").alias("reading_order", "e")).filter("reading_order IS NOT NULL")
    types = F.create_map(*[F.lit(x) for pair in ELEMENT_TYPES.items() for x in pair])
    kind = F.coalesce(F.col("e.type"), F.lit("paragraph"))
    said = F.coalesce(F.col("e.content"), F.lit(""))
    return rows.select(
        "doc_id", "page", F.col("reading_order").alias("pos"), F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("_b"), F.col("reading_order").cast("string")).alias("block_id"),
        F.coalesce(F.try_element_at(types, kind), F.lit("text")).alias("type"), F.lit(None).cast("array<double>").alias("bbox"), "reading_order", said.alias("text"), M.element(kind, said, "e.metadata").alias("markdown"),
        F.lit(PARSER_SOURCE).alias("parser_source"), F.col("e.metadata").alias("raw_data"), F.lit(None).cast("string").alias("caption"), F.lit(None).cast("string").alias("image_path"),
        F.lit(0.0).alias("confidence"), F.lit("unknown").alias("lang"),
    )


def enriched(blocks: DataFrame) -> DataFrame:
    """Known types only; text types without a box get markdown, confidence and language; then anchors.

    ``pos`` counts a document's blocks in reading order: page, order (null as 999), text
    before pictures, then as they came.
    """
    texts = F.col("type").isin(*TEXT_TYPES)
    plain = texts & F.col("bbox").isNull()
    out = blocks.filter(texts | F.col("type").isin(*VISUAL_TYPES))
    out = out.withColumn("markdown", F.when(plain & (T.first_full("markdown") == ""), M.text_block()).otherwise(F.col("markdown")))
    out = out.withColumn("lang", F.when(plain & (F.col("lang") == "unknown") & (T.first_full("text") != ""), T.language("text")).otherwise(F.col("lang")))
    out = out.withColumn("confidence", F.when(plain & (F.col("confidence") == 0), F.lit(MODEL_CONFIDENCE)).otherwise(F.col("confidence")))
    return ordered(out.withColumn("anchor", T.anchor()))


def ordered(blocks: DataFrame) -> DataFrame:
    """``pos`` renumbered per document in reading order."""
    visual = F.when(F.col("type").isin(*VISUAL_TYPES), 1).otherwise(0)
    order = Window.partitionBy("doc_id").orderBy("page", F.coalesce("reading_order", F.lit(999)), visual, "pos")
    return blocks.withColumn("pos", F.row_number().over(order) - 1)


def doc_titles(blocks: DataFrame) -> DataFrame:
    """(doc_id, title): the first title with any text on the first page where its trimmed text isn't empty."""
    titles = blocks.filter((F.col("type") == "title") & (T.first_full("text") != ""))
    pages = titles.groupBy("doc_id", "page").agg(F.min_by(T.strip("text"), F.struct(F.coalesce("reading_order", F.lit(999)), "pos")).alias("title"))
    return pages.filter("title <> ''").groupBy("doc_id").agg(F.min_by("title", "page").alias("title"))


def heading() -> Column:
    """What ``first_title`` takes of a block: null if it can't give the title."""
    return F.when((F.col("type") == "title") & (T.first_full("text") != ""), F.struct("page", F.coalesce("reading_order", F.lit(999)).alias("o"), "pos", T.strip("text").alias("title")))


def first_title(headings: Column | str) -> Column:
    """The title of doc_titles as one aggregate of a document's blocks, beside others; it holds all headings of a document."""

    def first(rows: Column) -> Column:
        tops = F.filter(rows, lambda r, i: r["page"].isNotNull() & ~F.get(rows, i - 1)["page"].eqNullSafe(r["page"]) & (r["title"] != ""))
        return F.get(tops, F.lit(0))["title"]

    return T.bind(F.sort_array(F.collect_list(headings)), first)


def fallback_blocks(pages: DataFrame, blocks: DataFrame, read: DataFrame) -> DataFrame:
    """A single text block for each page without one, from (doc_id, page, text, confidence) of a whole-page reading."""
    bare = pages.select("doc_id", F.col("page_num").alias("page"), "width", "height").join(blocks.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti")
    rows = bare.join(read, ["doc_id", "page"], "left")
    said = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", "page", F.lit(0).alias("pos"), F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("_b0")).alias("block_id"), F.lit("text").alias("type"), F.array(F.lit(0.0), F.lit(0.0), "width", "height").alias("bbox"),
        F.lit(0).alias("reading_order"), said.alias("text"), said.alias("markdown"), T.language(said).alias("lang"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )


def _line_kind(line: Column) -> Column:
    s = T.strip(line)
    return (
        F.when(T.blank(line), "B").when(s.rlike(r"(?U)^#{1,6}\s+.+$"), "H").when(s.rlike(r"^[!]\[[^\]]*][(][^)]*[)]$"), "F").when(s.rlike(r"^\|.+\|$"), "T").when(s.rlike(r"^\$\$.+\$\$$"), "M").otherwise("P")
    )


def markdown_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of (doc_id, page, markdown): headings, figures, tables, formulas, paragraphs.

    Neighbouring plain lines are a paragraph. A table goes on over blank lines, headings
    and figures until another line ends it, and is numbered where it ends.
    """
    lines = pages.select("doc_id", "page", F.posexplode(F.split("markdown", "\n")).alias("i", "line")).withColumn("kind", _line_kind(F.col("line")))
    page = Window.partitionBy("doc_id", "page").orderBy("i")
    ended = F.count_if(F.col("kind").isin("P", "M")).over(page)
    fresh = (F.col("kind") == "P") & (F.coalesce(F.lag("kind").over(page), F.lit("")) != "P")
    lines = lines.withColumn("para", F.count_if(fresh).over(page)).withColumn("table", ended)
    last = F.max("i").over(Window.partitionBy("doc_id", "page"))
    ends = F.min(F.when(F.col("kind").isin("P", "M"), F.col("i"))).over(page.rowsBetween(1, Window.unboundedFollowing))
    lines = lines.withColumn("n", last + 1).withColumn("ends", ends)
    group = F.when(F.col("kind") == "P", F.concat(F.lit("P"), "para")).when(F.col("kind") == "T", F.concat(F.lit("T"), "table")).otherwise(F.concat(F.lit("L"), "i"))
    blocks = lines.filter("kind <> 'B'").withColumn("g", group).groupBy("doc_id", "page", "g").agg(
        F.first("kind").alias("kind"), F.max("i").alias("upto"), F.max("n").alias("n"), F.max("ends").alias("ends"), F.array_sort(F.collect_list(F.struct("i", "line"))).alias("rows"))
    at = F.when(F.col("kind") == "P", F.struct((F.col("upto") + 1).alias("a"), F.lit(0).alias("b"))).when(F.col("kind") == "T", F.when(F.col("ends").isNotNull(), F.struct(F.col("ends").alias("a"), F.lit(0).alias("b"))).otherwise(F.struct(F.col("n").alias("a"), F.lit(1).alias("b")))).otherwise(F.struct(F.col("upto").alias("a"), F.lit(1).alias("b")))
    order = (F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(at)) - 1).alias("reading_order")
    raw = F.transform("rows", lambda r: r["line"])
    head = T.strip(F.get(raw, F.lit(0)))
    joined = T.strip(F.array_join(raw, "\n"))
    marks = F.regexp_extract(head, r"^(#{1,6})", 1)
    title = T.strip(F.regexp_extract(head, r"(?U)^#{1,6}\s+(.+)$", 1))
    caption = T.strip(F.regexp_extract(head, r"^[!]\[([^\]]*)][(][^)]*[)]$", 1))
    rows = F.transform(raw, T.strip)
    cells = F.transform(F.filter(rows, lambda r: ~r.rlike(r"(?U)^\|[\s\-|]+\|$")), lambda r: F.array_join(F.transform(F.split(F.regexp_replace(r, r"^\|+|\|+$", ""), r"\|"), T.strip), " | "))
    kind = F.col("kind")
    text = F.when(kind == "H", title).when(kind == "F", F.when(caption != "", caption).otherwise("[Figure]")).when(kind == "M", T.strip(F.regexp_extract(head, r"^\$\$(.+)\$\$$", 1))).when(kind == "T", F.array_join(cells, "\n")).otherwise(joined)
    md = F.when(kind == "H", F.concat(marks, F.lit(" "), title)).when(kind == "T", F.array_join(rows, "\n")).when(kind == "M", head).when(kind == "P", joined)
    types = F.create_map(*[F.lit(x) for x in ("H", "title", "F", "figure", "T", "table", "M", "formula", "P", "text")])
    out = blocks.select("doc_id", "page", order, types[kind].alias("type"), text.alias("text"), md.alias("markdown"), F.when(kind == "F", caption).alias("caption"), F.when(kind == "H", F.length(marks)).alias("heading_level"))
    return out.withColumn("block_id", F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("_b"), F.col("reading_order").cast("string")))


def of_type(blocks: DataFrame, type: str) -> DataFrame:
    """Blocks of a type, upper and lower case alike."""
    return blocks.filter(F.lower("type") == type.lower())


def find(blocks: DataFrame, block_id: str | None = None, anchor: str | None = None) -> DataFrame:
    """The first block, in document order, of each document with that id or that anchor."""
    wanted = F.lit(True)
    if block_id is not None:
        wanted = wanted & (F.col("block_id") == block_id)
    if anchor is not None:
        wanted = wanted & (F.col("anchor") == anchor)
    rest = [c for c in blocks.columns if c != "doc_id"]
    return blocks.filter(wanted).groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.struct("page", F.coalesce("reading_order", F.lit(999)), "pos")).alias("b")).select("doc_id", "b.*").select(blocks.columns)
