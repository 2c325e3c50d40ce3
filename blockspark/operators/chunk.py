"""Chunks of ordered blocks, as one linear fold per document over numbers and short labels.

An open chunk is always a run of neighbouring blocks, and overlap keeps a suffix of it,
so the fold's state is the run's start and the section; tokens are prefix sums, in which
the overlap's start is searched by halving. The fold runs over Arrow batches, as a fold
of expressions copies the list of closed runs at each step. Text never enters it; it is
joined to the closed runs afterwards.

Blocks without a document id are one document; blocks without text count as blank;
an empty table has no chunk; other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.config import ChunkingConfig
from blockspark.functions import text as T
from blockspark.session import ship

#: Documents whose arrays are turned into Python objects at a time.
SLICE = 64


def lines_as_blocks(docs: DataFrame, per_page: int = 20, title_every: int = 7) -> DataFrame:
    """Blocks from the lines of plain documents: every seventh is a title, twenty make a page."""
    lines = docs.select(F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    page, order = (F.floor(F.col("pos") / per_page) + 1).cast("int"), (F.col("pos") % per_page).cast("int")
    kind = F.when(F.col("pos") % title_every == 0, "title").otherwise("text")
    return lines.select(
        "doc_id", page.alias("page"), "pos", F.concat(F.lit("p"), page.cast("string"), F.lit("_b"), order.cast("string")).alias("block_id"), kind.alias("type"), order.alias("reading_order"), "text",
        F.lit(None).cast("string").alias("markdown"), F.lit(None).cast("string").alias("caption"), T.anchor(page, kind, order).alias("anchor"),
    )


def _lists(column: pa.Array) -> tuple[list, list[int]]:
    """The values of a list column one after another, and where each row's start."""
    ends = column.offsets.to_pylist()
    return column.flatten().to_pylist(), [e - ends[0] for e in ends]


def fold(tokens: list[int], heads: list[bool], blanks: list[bool], labels: list[str | None], config: ChunkingConfig) -> list[tuple[int, int, str | None]]:
    """(first block, last block, section) of each chunk of a document."""
    before = [0]
    for n in tokens:
        before.append(before[-1] + n)

    def overlap(s: int, n: int) -> int:
        """First block of the longest suffix of blocks s .. n-1 with few enough tokens."""
        return n if config.overlap_tokens <= 0 else max(s, min(n, bisect_left(before, before[n] - config.overlap_tokens, 0, len(tokens))))

    out: list[tuple[int, int, str | None]] = []
    s, section = 0, None
    for i, head in enumerate(heads):
        if head:
            if s < i and before[i] - before[s] >= config.min_chunk_size:
                out.append((s, i - 1, section))
                s = overlap(s, i)
            section = labels[i]
        held = before[i + 1] - before[s]
        if held >= config.chunk_size and (config.respect_paragraphs and blanks[i] or held >= config.max_chunk_size):
            out.append((s, i, section))
            s = overlap(s, i + 1)
    if s < len(tokens):
        out.append((s, len(tokens) - 1, section))
    return out


def chunk_runs(blocks: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """(doc_id, k, s, e, section): each chunk as a run of block numbers.

    blocks: one row a block with doc_id, pos and the content columns, in the order of pos.
    """
    said = T.content()
    header = F.col("type").isin("title", "section_header") if config.respect_sections else F.lit(False)
    thin = blocks.select("doc_id", F.struct(F.col("pos").alias("i"), T.tokens(said, config.token_method).cast("long").alias("tok"), F.coalesce(header, F.lit(False)).alias("head"), T.blank(said).alias("blank"), F.when(header, T.strip(said)).alias("label")).alias("b"))
    docs = thin.groupBy("doc_id").agg(F.array_sort(F.collect_list("b")).alias("b"))
    docs = docs.select("doc_id", *[F.col(f"b.{c}").alias(c) for c in ("tok", "head", "blank", "label")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                (tok, ends), (head, _), (blank, _), (label, _) = (_lists(part.column(c)) for c in (1, 2, 3, 4))
                rows, ks, found = [], [], []
                for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                    runs = fold(tok[a:b], head[a:b], blank[a:b], label[a:b], config)
                    rows += [i] * len(runs)
                    ks += range(len(runs))
                    found += runs
                s, e, section = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(ks, pa.int32()), pa.array(s, pa.int32()), pa.array(e, pa.int32()), pa.array(section, pa.string())], names=["doc_id", "k", "s", "e", "section"])

    ship(blocks.sparkSession)
    return docs.mapInArrow(run, f"doc_id {docs.schema[0].dataType.simpleString()}, k int, s int, e int, section string")


def chunk_blocks(blocks: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """Chunks with their text, pages, orders, block ids and anchors; ``pos`` counts a document's blocks from 0."""
    runs = chunk_runs(blocks, config).withColumn("pos", F.explode(F.sequence("s", "e")))
    parts = runs.join(blocks, ["doc_id", "pos"])
    said = T.content()
    row = F.struct("pos", said.alias("c"), "block_id", "anchor")
    chunks = parts.groupBy("doc_id", "k", "section").agg(
        F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.coalesce(F.min("reading_order"), F.lit(0)).alias("reading_order_start"), F.coalesce(F.max("reading_order"), F.lit(0)).alias("reading_order_end"), F.array_sort(F.collect_list(row)).alias("rows")
    )
    texts = chunks.withColumn("text", F.array_join(F.filter(F.transform("rows", lambda r: r["c"]), lambda c: c != ""), "\n\n"))
    anchors = F.filter(F.transform("rows", lambda r: r["anchor"]), lambda a: a.isNotNull() & (a != "")) if config.include_anchors else F.array().cast("array<string>")
    return texts.select(
        F.concat(F.substring("doc_id", 1, 8), F.lit("_c"), F.col("k").cast("string")).alias("chunk_id"), "doc_id", "page_start", "page_end", F.transform("rows", lambda r: r["block_id"]).alias("block_ids"), "section", "text",
        T.tokens("text", config.token_method).alias("token_count"), F.length("text").alias("char_count"), "reading_order_start", "reading_order_end", anchors.alias("anchors"), F.lit(None).cast("string").alias("translation"), F.lit(None).cast("array<float>").alias("embedding"),
    )


def fold_lines(words: list[int], levels: list[int], titles: list[str], bars: list[bool], images: list[bool], blanks: list[bool], chunk_size: int, heading_min: int, table_min: int) -> list[tuple[int, int, str]]:
    """(first line, last line, section) of each chunk of a markdown text."""
    out: list[tuple[int, int, str]] = []
    s = held = 0
    section, in_table = "Introduction", False
    for i, (n, level, bar) in enumerate(zip(words, levels, bars, strict=True)):
        head, table = 1 <= level <= 2, bar and not level
        if s < i and (head and held > heading_min or table and not in_table and held > table_min):
            out.append((s, i - 1, section))
            s, held = i, 0
        held += n
        if head:
            section = titles[i]
        in_table = bar
        if not level and not bar and not images[i] and blanks[i] and held >= chunk_size:
            out.append((s, i, section))
            s, held, in_table = i + 1, 0, False
    if s < len(words):
        out.append((s, len(words) - 1, section))
    return out


def legacy_chunks(markdown: DataFrame, chunk_size: int = 1000, heading_min: int = 100, table_min: int = 500) -> DataFrame:
    """(doc_id, k, section, content) of whole markdown texts, counted in words.

    Level one and two headings and the start of a table close a chunk that is long
    enough; a blank line closes one that reached the size. Texts stay where they are:
    nothing is shuffled.
    """
    each = lambda f: F.transform("lines", f)
    lines = markdown.select("doc_id", F.split("markdown", "\n").alias("lines"))
    marked = lines.select(
        "doc_id", "lines", each(T.words).alias("n"), each(lambda x: F.length(F.regexp_extract(x, r"^(#+)(?U:\s)+(.+)$", 1))).alias("level"), each(lambda x: F.regexp_extract(x, r"^#+(?U:\s)+(.+)$", 1)).alias("title"),
        each(lambda x: T.strip(x).startswith("|")).alias("bar"), each(lambda x: T.strip(x).startswith("![")).alias("image"), each(T.blank).alias("blank"),
    ).filter(F.col("lines").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                (line, ends), *rest = (_lists(c) for c in part.columns[1:])
                rows, ks, sections, contents = [], [], [], []
                for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                    text = line[a:b]
                    for k, (s, e, section) in enumerate(fold_lines(*[values[a:b] for values, _ in rest], chunk_size, heading_min, table_min)):
                        rows.append(i)
                        ks.append(k)
                        sections.append(section)
                        contents.append("\n".join(text[s : e + 1]))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(ks, pa.int32()), pa.array(sections, pa.string()), pa.array(contents, pa.string())], names=["doc_id", "k", "section", "content"])

    ship(markdown.sparkSession)
    return marked.mapInArrow(run, f"doc_id {marked.schema[0].dataType.simpleString()}, k int, section string, content string")
