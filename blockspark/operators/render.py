"""Documents as markdown and as metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.functions import markdown as M
from blockspark.functions import text as T


def writer_markdown(blocks: DataFrame, docs: DataFrame, with_anchors: bool = False) -> DataFrame:
    """(doc_id, markdown): the title, each block and a mark before every later page.

    docs: (doc_id, title, total_pages, created_at, parser_version). Empty blocks are left out.
    """
    return written(docs.join(_collected(blocks, writer_row(with_anchors)), "doc_id", "left"), with_anchors)


def writer_row(with_anchors: bool = False) -> Column:
    """What ``written`` takes of a block."""
    return _row(M.block(with_anchors))


def written(docs: DataFrame, with_anchors: bool = False) -> DataFrame:
    """(doc_id, markdown) of writer_markdown's docs with ``rows``, their blocks' writer_row in order."""

    def body(rows: Column) -> Column:
        def part(r: Column, i: Column) -> Column:
            mark = F.when((F.col("total_pages") > 1) & (F.get(rows, i - 1)["page"] != r["page"]), M.plus("\n---\n<!-- Page ", r["page"], " -->\n\n"))
            return F.concat(F.coalesce(mark, F.lit("")), F.when(r["p"] != "", M.plus(r["p"], "\n\n")).otherwise(""))

        return F.array_join(F.transform(rows, part), "")

    text = M.plus(_title(), T.bind(F.col("rows"), body), M.footer() if with_anchors else "")
    # lines are joined, so the last line feed goes unless a footer follows
    return docs.select("doc_id", (text if with_anchors else F.regexp_replace(text, r"\n\z", "")).alias("markdown"))


def export_markdown(blocks: DataFrame, docs: DataFrame, with_anchors: bool = False) -> DataFrame:
    """(doc_id, markdown) of the other export: an anchor behind every block, a list as footer, no page marks."""
    return exported(docs.join(_collected(blocks, export_row(with_anchors)), "doc_id", "left"), with_anchors)


def export_row(with_anchors: bool = False) -> Column:
    """What ``exported`` takes of a block."""
    body = T.first_full("markdown", "text")
    if with_anchors:
        body = F.when(T.first_full("anchor") != "", M.plus(body, " ", F.col("anchor"))).otherwise(body)
    return _row(body)


def exported(docs: DataFrame, with_anchors: bool = False) -> DataFrame:
    """(doc_id, markdown) of export_markdown's docs with ``rows``, their blocks' export_row in order."""
    body = F.array_join(F.transform(F.filter("rows", lambda r: r["p"] != ""), lambda r: F.concat(r["p"], F.lit("\n\n"))), "")
    foot = M.plus("---\n\n## Document Metadata\n\n- **Document ID**: ", F.col("doc_id"), "\n- **Pages**: ", F.col("total_pages"), "\n- **Processed**: ", F.col("created_at"), "\n- **Parser Version**: ", F.col("parser_version")) if with_anchors else F.lit("")
    text = F.concat(M.plus(_title(), body), foot)
    return docs.select("doc_id", (text if with_anchors else F.regexp_replace(text, r"\n\z", "")).alias("markdown"))


def in_order(rows: Column | str = "row") -> Column:
    """An aggregate: a document's rows by page, reading order (null as 999) and place."""
    return F.sort_array(F.collect_list(rows))


def _row(body: Column) -> Column:
    return F.struct("page", F.coalesce("reading_order", F.lit(999)).alias("o"), "pos", body.alias("p"))


def _collected(blocks: DataFrame, row: Column) -> DataFrame:
    # the row is made below the aggregate, which would interpret it
    return blocks.select("doc_id", row.alias("row")).groupBy("doc_id").agg(in_order().alias("rows"))


def _title() -> Column:
    return F.when(T.first_full("title") != "", M.plus("# ", F.col("title"), "\n\n"))


def metadata(blocks: DataFrame) -> DataFrame:
    """(doc_id, total_blocks, total_text_chars, avg_confidence): the mean is over positive confidences, 0 if there is none."""
    return blocks.groupBy("doc_id").agg(
        F.count("*").alias("total_blocks"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("total_text_chars"),
        F.coalesce(F.round(F.avg(F.when(F.col("confidence") > 0, F.col("confidence"))), 4), F.lit(0.0)).alias("avg_confidence"),
    )


def type_histogram(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("doc_id", "type").agg(F.count("*").alias("blocks"))


def metadata_json(blocks: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, json) with the types' counts as an object; nulls are written."""
    types = type_histogram(blocks).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "blocks")))).alias("block_types"))
    rows = docs.join(metadata(blocks), "doc_id", "left").join(types, "doc_id", "left")
    fields = [c for c in ("doc_id", "source_path", "filename", "title", "total_pages", "total_blocks", "block_types", "total_text_chars", "avg_confidence", "created_at", "parser_version", "authors") if c in rows.columns]
    return rows.select("doc_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))
