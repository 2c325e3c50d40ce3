"""Whole runs: files in, tables of results out. Nothing is written here; sinks take the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.backends.base import Backend
from blockspark.config import ProcessorConfig
from blockspark.functions import text as T
from blockspark.operators import chunk, codescan, dedup, pages, parse, render, translate
from blockspark.schemas import PARSER_VERSION
from blockspark.sinks import writers


@dataclass(frozen=True)
class Processed:
    """What a run over PDF files gives; chunks only if the settings ask for them."""

    skipped: DataFrame
    blocks: DataFrame
    documents: DataFrame
    markdown: DataFrame
    metadata: DataFrame
    chunks: DataFrame | None
    registrations: DataFrame


def process(files: DataFrame, requests: DataFrame, backend: Backend, config: ProcessorConfig, created_at: str, registry: DataFrame | None = None, fallback: DataFrame | None = None, decisions: DataFrame | None = None) -> Processed:
    """Files (doc_id, source_path, filename, content) with page requests (doc_id, page, ...) through a page parser.

    Registered files are skipped before any model is asked, with the reason. fallback:
    whole-page readings for pages without blocks; decisions: answers for page merging.
    """
    keyed = files.select("doc_id", "source_path", "filename", F.lit("pdfs").alias("kind"), F.sha2("content", 256).alias("hash"))
    skipped = keyed.limit(0).withColumn("reason", F.lit("duplicate"))
    if registry is not None and config.check_duplicates:
        skipped = dedup.duplicates(keyed, registry).select(*keyed.columns, F.concat(F.lit("duplicate of "), F.coalesce("original_path", F.lit(""))).alias("reason"))
        keyed = dedup.fresh(keyed, registry)
    wanted = requests.join(keyed.select("doc_id").distinct(), "doc_id", "left_semi")
    answered = backend.answer(wanted)
    blocks = parse.element_blocks(answered.select("doc_id", "page", "response"))
    if fallback is not None:
        sheets = wanted.select("doc_id", F.col("page").alias("page_num"), F.lit(0.0).alias("width"), F.lit(0.0).alias("height"))
        blocks = blocks.unionByName(parse.fallback_blocks(sheets, blocks, fallback), allowMissingColumns=True)
    blocks = parse.enriched(blocks)
    totals = wanted.groupBy("doc_id").agg(F.max("page").alias("total_pages"))
    docs = keyed.join(totals, "doc_id", "left").join(parse.doc_titles(blocks), "doc_id", "left")
    docs = docs.select("doc_id", "source_path", "filename", F.coalesce("total_pages", F.lit(0)).alias("total_pages"), F.lit(created_at).alias("created_at"), F.lit(PARSER_VERSION).alias("parser_version"), "title", F.array().cast("array<string>").alias("authors"))
    markdown = render.writer_markdown(blocks, docs, config.with_anchors)
    if config.merge_pages and decisions is not None:
        markdown = pages.merge(markdown, decisions, config.merge_context_chars)
    chunks = chunk.chunk_blocks(blocks, config.chunking) if config.enable_chunking else None
    registrations = keyed.select("kind", "hash", F.col("source_path").alias("path"), F.lit(created_at).alias("date"), F.lit(None).cast("string").alias("preview"))
    return Processed(skipped, blocks, docs, markdown, render.metadata_json(blocks, docs), chunks, registrations)


def translated(texts: DataFrame, translations: DataFrame, root: str, two_languages: bool = False) -> DataFrame:
    """(path, content) of translated files below ``root``, at their places below its translated twin."""
    docs = texts.select(F.col("path").alias("doc_id"), F.col("content").alias("markdown"))
    parts = translate.paragraphs(docs)
    whole = (translate.bilingual if two_languages else translate.monolingual)(parts, translations)
    return whole.select(writers.translated_path("doc_id", root).alias("path"), F.col("markdown").alias("content"))


def reviewed(files: DataFrame) -> DataFrame:
    """(path, report): the review of each file, a row each; a reader joins those it wants by path."""
    return codescan.review(files).orderBy("path")


def language_of(texts: DataFrame) -> DataFrame:
    """(path, source, target) of each file: Korean goes to English, all else to Korean."""
    return texts.select("path", T.language_pair("content").alias("source")).withColumn("target", F.when(F.col("source") == "ko", "en").otherwise("ko"))
