"""Pages of labelled regions as markdown, the older way: readings of text, captions of pictures.

The pictures of pages, their regions and crops, and the models' answers come in as
tables from a backend; nothing here reads an image.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.functions import geometry as G
from blockspark.functions import markdown as M
from blockspark.functions import text as T

TEXT_LABELS = ("Text", "Section-header", "Title", "ListItem", "Caption", "Footer", "Header", "PageHeader", "PageFooter", "SectionHeader")
PICTURE_LABELS = ("Picture", "Chart", "Figure", "Formula", "Table")
CONTENT_LABELS = ("Text", "Section-header", "Title", "ListItem", "Caption", "Table", "Picture", "Chart", "Figure", "Formula", "SectionHeader")


def has_content(regions: DataFrame) -> DataFrame:
    """(doc_id, page, content): whether any region of a page has a label that counts; others are read as a whole."""
    return regions.groupBy("doc_id", "page").agg(F.bool_or(F.coalesce(F.col("label").isin(*CONTENT_LABELS), F.lit(False))).alias("content"))


def crops(regions: DataFrame, width: Column | str, height: Column | str) -> DataFrame:
    """Regions with their box inside the page and the crop's file name; those without area or box are left out.

    Names are of the place and the label, so a repeated task writes the same file again.
    """
    name = F.concat(F.lower("label"), F.lit("_p"), F.col("page").cast("string"), F.lit("_"), T.sha(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("page").cast("string"), F.col("region").cast("string")), 8), F.lit(".png"))
    inside = regions.filter(F.col("bbox").isNotNull()).withColumn("bbox", G.clamped("bbox", width, height))
    return inside.filter(F.coalesce(G.has_area("bbox"), F.lit(False))).withColumn("crop", name)


def page_markdown(regions: DataFrame, pictures: str = "images") -> DataFrame:
    """(doc_id, page, markdown) of regions with label, region (their number), order, text, caption and crop.

    Regions go by order, those without one last; headings get their level from label or
    text; a picture gets its link and, where there is one, its caption. Pages without
    any region that counts are left out.
    """
    level = T.heading_level("text", "label")
    said = F.coalesce("text", F.lit(""))
    head = F.when(level == 1, M.plus("# ", said)).when(level == 2, M.plus("## ", said)).when(level == 3, M.plus("### ", said)).otherwise(said)
    link = F.coalesce("crop", F.lit("placeholder"))
    kind = F.when(F.col("label") == "Table", "Table Summary").otherwise("Caption")
    caption = F.when(T.first_full("caption") != "", M.plus("\n*AI ", kind, ": ", F.col("caption"), "*\n"))
    picture = M.plus("\n![", F.col("label"), f"]({pictures}/", link, ")\n<!-- ", F.col("label"), " detected -->\n", caption)
    rows = regions.withColumn("md", F.when(F.col("label").isin(*TEXT_LABELS), head).when(F.col("label").isin(*PICTURE_LABELS), picture)).filter("md <> ''")
    parts = F.array_sort(F.collect_list(F.struct(F.col("order").isNull().alias("last"), "order", "region", "md")))
    pages = rows.groupBy("doc_id", "page").agg(F.array_join(F.transform(parts, lambda r: r["md"]), "\n\n").alias("body"))
    kept = pages.join(has_content(regions).filter("content").select("doc_id", "page"), ["doc_id", "page"], "left_semi")
    return kept.select("doc_id", "page", M.plus("<!-- Page ", F.col("page"), " -->\n\n", F.col("body")).alias("markdown"))
