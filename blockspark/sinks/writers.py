"""Markdown, JSON lines and metadata as files; the places where they go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.functions import text as T
from blockspark.operators import render


def output_path(mode: str, folder: str, name: Column | str = "filename", doc: Column | str = "doc_id") -> Column:
    """Markdown alone goes flat by name, other modes to a folder per document."""
    base = folder.rstrip("/")
    if mode == "markdown":
        stem = F.regexp_replace(T.col(name), r"\.[^.]*$", "")
        return F.concat(F.lit(base + "/"), stem, F.lit("_qwenvl.md"))
    return F.concat(F.lit(base + "/"), T.col(doc).cast("string"))


def beside(path: Column | str, suffix: str) -> Column:
    """``a/b.md`` as ``a/b_suffix.md``."""
    p = T.col(path)
    return F.concat(F.regexp_replace(p, r"(\.[^./]*)?$", ""), F.lit(suffix), F.regexp_extract(p, r"(\.[^./]*)$", 1))


def translated_path(path: Column | str, root: str) -> Column:
    """Where the translation of a file below ``root`` goes: the same place below ``root_translated``."""
    base = root.rstrip("/")
    return F.concat(F.lit(base + "_translated"), F.substring(T.col(path), len(base) + 1, 1 << 30))


def crop_path(folder: str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), "block_id", F.lit("_"), F.substring("source_hash", 1, 8), F.lit(".png"))


def blocks_json(blocks: DataFrame) -> DataFrame:
    """(doc_id, value): a line of JSON per block, nulls written; stored order."""
    return blocks.select("doc_id", F.to_json(F.struct(*[c for c in blocks.columns]), {"ignoreNullFields": "false"}).alias("value"))


def chunks_json(chunks: DataFrame) -> DataFrame:
    """The same of chunks: pages as a pair, the embedding never written out."""
    rest = [c for c in chunks.columns if c not in ("page_start", "page_end", "embedding")]
    row = F.struct(*rest, F.array("page_start", "page_end").alias("page_range"), F.lit(None).cast("string").alias("embedding"))
    return chunks.select("doc_id", F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def _lines(rows: DataFrame, path: str, each: bool, buckets: int) -> None:
    if each:
        return rows.write.mode("overwrite").partitionBy("doc_id").text(path)
    # a document's rows stay together, in as many directories as there are buckets
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")).repartition("bucket", F.pmod(F.xxhash64(F.lit("file"), "doc_id"), F.lit(8)))
    spread.write.mode("overwrite").partitionBy("bucket").json(path)


def write_all(blocks: DataFrame, docs: DataFrame, folder: str, chunks: DataFrame | None = None, with_anchors: bool = False, each: bool = True, buckets: int = 256) -> None:
    """Markdown, blocks, metadata and, if any, chunks: a folder of each.

    ``each``: a directory per document, for as many as a file system lists with ease;
    otherwise rows (doc_id, value) of JSON in ``buckets`` directories by the id's hash.
    """
    base = folder.rstrip("/")
    _lines(render.writer_markdown(blocks, docs, with_anchors).select("doc_id", F.col("markdown").alias("value")), f"{base}/markdown", each, buckets)
    _lines(blocks_json(blocks), f"{base}/blocks", each, buckets)
    _lines(render.metadata_json(blocks, docs).select("doc_id", F.col("json").alias("value")), f"{base}/metadata", each, buckets)
    if chunks is not None:
        _lines(chunks_json(chunks), f"{base}/chunks", each, buckets)


def append_events(events: DataFrame, path: str) -> None:
    """Registrations and queue changes are appended, never rewritten."""
    events.write.mode("append").parquet(path)
