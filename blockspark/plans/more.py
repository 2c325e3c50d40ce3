"""Queries of sources, sinks, backends and single functions, with their SQL twins.

Those of sources and sinks write to the shared folder first, each run to its own place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockspark.backends import base as B
from blockspark.config import ChunkingConfig
from blockspark.functions import geometry as G
from blockspark.functions import json_text as J
from blockspark.functions import markdown as M
from blockspark.functions import text as T
from blockspark.operators import cache, chunk, codescan, dedup, eda, layout, ocr, parse, render, translate
from blockspark.plans import fixtures as X
from blockspark.plans import runs
from blockspark.plans import sql as S
from blockspark.plans.registry import query
from blockspark.session import shared_dir
from blockspark.sinks import writers
from blockspark.sources import files


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _nation_files(spark: SparkSession, sf: str, suffix: str = "") -> str:
    """A folder with a text file for each nation, below a folder named by its key."""
    folder = _place(spark, "files")
    rows = X.table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.concat(F.lit("# "), "n_name", F.lit("\nregion "), F.col("n_regionkey").cast("string")).alias("value"))
    rows.repartition(1).write.partitionBy("k").text(folder)
    return folder


_FILE = f"('# ' || n_name || {S.NL} || 'region ' || n_regionkey || {S.NL})"
def _key():
    return F.regexp_extract("path", r"/k=(\d+)/", 1).cast("long").alias("k")



@query(f"SELECT n_nationkey::BIGINT AS k, {_FILE} AS content FROM nation")
def source_texts(spark, sf):
    return files.texts(spark, _nation_files(spark, sf)).select(_key(), "content")


@query(f"SELECT n_nationkey::BIGINT AS k, {_FILE} AS content FROM nation")
def source_code(spark, sf):
    return files.code(spark, _nation_files(spark, sf), extensions=(".txt",)).select(_key(), "content")


@query("SELECT n_nationkey::BIGINT AS k, length('# ' || n_name || 'region ' || n_regionkey) + 2 AS length FROM nation")
def source_listing(spark, sf):
    return files.listing(spark, _nation_files(spark, sf), (".txt",)).select(_key(), "length")


@query("SELECT 'stdin' AS path, 'a' || chr(10) || 'b' AS content")
def source_stdin(spark, sf):
    return files.one_text(spark, "a\nb")


@query("SELECT n_nationkey::BIGINT AS k, kind, n_name AS name, n_regionkey::BIGINT AS region FROM nation, (VALUES ('csv'), ('json'), ('parquet')) f(kind)")
def source_tabular(spark, sf):
    nation = X.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").repartition(1)
    out = None
    for kind in ("csv", "json", "parquet"):
        path = f"{_place(spark, 'table')}.{kind}"
        if kind == "json":  # an array of records, as a file of tabular JSON is
            nation.agg(F.to_json(F.collect_list(F.struct(*nation.columns))).alias("value")).write.text(path)
        else:
            nation.write.option("header", True).format(kind).save(path)
        part = files.tabular(spark, path).select(F.col("n_nationkey").cast("long").alias("k"), F.lit(kind).alias("kind"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("region"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT 'q' || r_regionkey AS question, r_name AS answer, CASE WHEN r_regionkey > 1 THEN 'a,b' END AS options FROM region")
def source_questions(spark, sf):
    row = F.struct(F.concat(F.lit("q"), F.col("r_regionkey").cast("string")).alias("question"), F.col("r_name").alias("answer"), F.when(F.col("r_regionkey") > 1, F.array(F.lit("a"), F.lit("b"))).alias("options"))
    path = _place(spark, "questions")
    X.table(spark, sf, "region").agg(F.to_json(F.array_sort(F.collect_list(row))).alias("value")).write.text(path)
    return files.questions(spark, path).withColumn("options", F.array_join("options", ","))


@query("SELECT 'texts' AS kind, n_nationkey::VARCHAR AS hash, n_name AS path, 'd' AS date FROM nation UNION ALL SELECT 'urls', r_regionkey::VARCHAR, r_name, 'e' FROM region")
def source_json_registry(spark, sf):
    """A registry kept as JSON, a corrupt one and a missing one."""
    entry = lambda t, k, n, field, date: X.table(spark, sf, t).agg(F.map_from_entries(F.collect_list(F.struct(F.col(k).cast("string"), F.struct(F.col(n).alias(field), F.lit(date).alias("date"))))).alias(field))
    both = entry("nation", "n_nationkey", "n_name", "path", "d").crossJoin(entry("region", "r_regionkey", "r_name", "url", "e"))  # one row each
    path, corrupt = _place(spark, "registry"), _place(spark, "registry")
    both.select(F.to_json(F.struct(F.col("path").alias("texts"), F.col("url").alias("urls"))).alias("value")).repartition(1).write.text(path)
    spark.createDataFrame([("{not json",)], "value string").repartition(1).write.text(corrupt)
    found = [files.json_registry(spark, p) for p in (path, corrupt, _place(spark, "missing"))]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("kind", "hash", "path", "date")


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'empty' ELSE 'unreadable' END AS status, CASE WHEN page_id % 3 = 0 THEN substr(sha256('%PDF-1.7' || url), 1, 16) END AS doc_id FROM pages")
def source_status(spark, sf):
    page = X.table(spark, sf, "pages")
    content = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("%PDF-1.7"), "url")).when(F.col("page_id") % 3 == 1, "").otherwise(F.col("url")).cast("binary")
    rows = files.readable(page.select("page_id", F.concat(F.lit("f"), F.col("page_id").cast("string"), F.lit(".PDF")).alias("filename"), content.alias("content")))
    return rows.select("page_id", "status", F.when(F.col("status") == "ok", T.doc_id("content")).alias("doc_id"))


@query("SELECT page_id, coalesce(nullif(substr(sha256(CASE WHEN page_id % 2 = 0 THEN url END), 1, 16), ''), substr(sha256(page_id::VARCHAR), 1, 16)) AS doc_id FROM pages")
def doc_id_fallback(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", T.doc_id_of_pages(F.when(F.col("page_id") % 2 == 0, F.col("url")), F.col("page_id")).alias("doc_id"))


@query(f"SELECT doc_id, i::INTEGER AS pos, block_id, type, text FROM ({S.BLOCKS})")
def sink_blocks(spark, sf):
    """Lines of JSON written in buckets and read again."""
    path = _place(spark, "blocks")
    writers._lines(writers.blocks_json(X.blocks(spark, sf)), path, False, 4)
    rows = files.objects(spark.read.schema("doc_id string, value string").json(path), "value", "doc_id string, pos int, block_id string, type string, text string")
    return rows.select("doc_id", "pos", "block_id", "type", "text")


@query(f"SELECT chunk_id, doc_id, page_start, page_end, text, token_count FROM ({S.chunks(ChunkingConfig())})")
def sink_chunks(spark, sf):
    rows = files.objects(writers.chunks_json(chunk.chunk_blocks(X.blocks(spark, sf))), "value", "chunk_id string, doc_id string, page_range array<int>, text string, token_count int, embedding string")
    return rows.filter("embedding IS NULL").select("chunk_id", "doc_id", F.get("page_range", F.lit(0)).alias("page_start"), F.get("page_range", F.lit(1)).alias("page_end"), "text", "token_count")


@query("SELECT page_id, 'out/f' || page_id || '_qwenvl.md' AS flat, 'out/' || page_id AS folder, 'in/f' || page_id || '_merged.md' AS merged, 'in_translated/f' || page_id || '.md' AS translated, 'crops/b' || page_id || '_' || substr(sha256(url), 1, 8) || '.png' AS crop FROM pages")
def sink_paths(spark, sf):
    f = F.concat(F.lit("f"), F.col("page_id").cast("string"))
    rows = X.table(spark, sf, "pages").select("page_id", F.concat(f, F.lit(".pdf")).alias("filename"), F.concat(F.lit("in/"), f, F.lit(".md")).alias("path"), F.col("page_id").alias("doc_id"), F.concat(F.lit("b"), F.col("page_id").cast("string")).alias("block_id"), T.sha("url").alias("source_hash"))
    return rows.select("page_id", writers.output_path("markdown", "out").alias("flat"), writers.output_path("both", "out/").alias("folder"), writers.beside("path", "_merged").alias("merged"), writers.translated_path("path", "in").alias("translated"), writers.crop_path("crops").alias("crop"))


@query("SELECT event_type AS kind, min(event_id) AS first, count(*) AS events FROM events GROUP BY event_type")
def sink_events(spark, sf):
    """Registrations appended twice over and read as one log."""
    path = _place(spark, "log")
    rows = X.table(spark, sf, "events").select("event_id", "event_type")
    writers.append_events(rows.filter("event_id % 2 = 0"), path)
    writers.append_events(rows.filter("event_id % 2 = 1"), path)
    return files.table_or_empty(spark, path, "event_id long, event_type string").groupBy(F.col("event_type").alias("kind")).agg(F.min("event_id").alias("first"), F.count("*").alias("events"))


@query(f"SELECT 'in_translated/' || doc_id || '.md' AS path, string_agg(coalesce(translation, content), {S.NL} ORDER BY part) AS content FROM ({S.TRANSLATED}) GROUP BY doc_id")
def translated_files(spark, sf):
    texts = X.conversations_as_markdown(spark, sf).select(F.concat(F.lit("in/"), "doc_id", F.lit(".md")).alias("path"), F.col("markdown").alias("content"))
    parts = translate.paragraphs(texts.select(F.col("path").alias("doc_id"), F.col("content").alias("markdown")))
    said = parts.filter("para_idx % 3 <> 0").select("doc_id", "para_idx", F.concat(F.lit("T"), F.col("para_idx").cast("string"), F.lit(" "), F.left("content", F.lit(20))).alias("translation"))
    return runs.translated(texts, said, "in")


@query(f"SELECT doc_id, part::BIGINT AS part, content AS original, coalesce(translation, '') AS translation FROM ({S.TRANSLATED}) WHERE NOT special")
def translation_pairs(spark, sf):
    docs = X.conversations_as_markdown(spark, sf)
    parts = translate.paragraphs(docs)
    said = parts.filter("para_idx % 3 <> 0").select("doc_id", "para_idx", F.concat(F.lit("T"), F.col("para_idx").cast("string"), F.lit(" "), F.left("content", F.lit(20))).alias("translation"))
    return translate.pairs(parts, said)


@query("SELECT conv_id, turn, 'Translate from English to Korean. Give the translation only, with the same formatting and lines.' || chr(10) || chr(10) || 'Text:' || chr(10) || coalesce(text, '') || chr(10) || chr(10) || 'Translation:' AS prompt, false AS passes FROM conversations")
def translation_prompts(spark, sf):
    return X.table(spark, sf, "conversations").select("conv_id", "turn", translate.prompt("text", "en", "ko").alias("prompt"), F.lit(translate.passes_through("en", "en", batch=True)).alias("passes"))


_TYPES = ["Figure", "chart", "text", "TABLE", "formula", "picture", "caption"]
_TYPE = f"({_TYPES!r})[event_id % 7 + 1]"


def _typed(spark, sf):
    return X.table(spark, sf, "events").withColumn("type", F.get(F.array(*[F.lit(t) for t in _TYPES]), (F.col("event_id") % 7).cast("int")))


@query(
    f"SELECT event_id, lower({_TYPE}) <> 'text' AND lower({_TYPE}) <> 'caption' AS visual, CASE lower({_TYPE}) WHEN 'chart' THEN 'Describe the chart: its kind, title, axes and what the data show.' WHEN 'table' THEN 'Describe the table: its title, columns and main findings.' "
    f"WHEN 'formula' THEN 'Write the formula as LaTeX and say what it states.' WHEN 'figure' THEN 'Describe the figure and its main parts.' ELSE 'Describe the picture.' END || chr(10) || chr(10) || 'Text near it: ' || left(props, 300) AS asked, "
    f"CASE lower({_TYPE}) WHEN 'table' THEN CASE WHEN event_id % 2 = 0 THEN props ELSE '<!-- table data not extracted -->' END WHEN 'chart' THEN CASE WHEN event_id % 2 = 0 THEN '**[Chart]**' || chr(10) || props ELSE '<!-- chart data not extracted -->' END END AS data, to_base64(event_type::BLOB) AS encoded FROM events"
)
def picture_requests(spark, sf):
    rows = _typed(spark, sf)
    return rows.select("event_id", T.is_visual().alias("visual"), B.picture_prompt(context="props").alias("asked"), B.extraction("type", F.when(F.col("event_id") % 2 == 0, F.col("props"))).alias("data"), F.base64(F.col("event_type").cast("binary")).alias("encoded"))


@query("SELECT l_orderkey AS o, l_linenumber::INTEGER AS n, greatest(1, floor(w * least(1.0::DOUBLE, 1024.0::DOUBLE / greatest(w, h))))::INTEGER AS width, greatest(1, floor(h * least(1.0::DOUBLE, 1024.0::DOUBLE / greatest(w, h))))::INTEGER AS height FROM (SELECT *, l_partkey % 3000 + 1 AS w, l_suppkey % 2000 + 1 AS h FROM lineitem)")
def picture_sizes(spark, sf):
    size = B.fitted(F.col("l_partkey") % 3000 + 1, F.col("l_suppkey") % 2000 + 1)
    return X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("int").alias("n"), size["width"].alias("width"), size["height"].alias("height"))


@query(
    "SELECT o, n, greatest(0, x - 50)::INTEGER AS x1, greatest(0, y - 10)::INTEGER AS y1, least(600, x + 30)::INTEGER AS x2, least(800, y + 40)::INTEGER AS y2, least(600, x + 30) > greatest(0, x - 50) AND least(800, y + 40) > greatest(0, y - 10) AS area FROM (SELECT l_orderkey AS o, l_linenumber::INTEGER AS n, l_partkey % 700 AS x, l_suppkey % 900 AS y FROM lineitem)"
)
def boxes_on_page(spark, sf):
    x, y = F.col("l_partkey") % 700, F.col("l_suppkey") % 900
    box = F.array((x - 50).cast("double"), (y - 10).cast("double"), (x + 30).cast("double"), (y + 40).cast("double"))
    rows = X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("int").alias("n"), G.clamped(box, F.lit(600), F.lit(800)).alias("b"))
    return rows.select("o", "n", *[F.get("b", F.lit(i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))], G.has_area("b").alias("area"))


@query("SELECT doc_id, '[Source: ' || doc_id || ', ' || CASE WHEN n_chars % 3 = 0 THEN 'p.1' ELSE 'p.1-' || (n_chars % 3 + 1) END || ', blocks: ' || n_chars || ']' AS citation FROM documents")
def citations(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", T.citation("doc_id", F.lit(1), F.col("n_chars") % 3 + 1, "n_chars").alias("citation"))


@query("SELECT event_id, sha256(props) AS hash, substr(sha256(props), 1, 16) AS id, event_type || CASE WHEN event_id % 2 = 0 THEN '_' || props ELSE '' END AS key FROM events")
def content_keys(spark, sf):
    return X.table(spark, sf, "events").select("event_id", T.sha("props").alias("hash"), T.doc_id("props").alias("id"), cache.cache_key("event_type", F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise("")).alias("key"))


@query("SELECT vec_id, lower(lpad(hex(list_sum(list_transform(range(63), lambda i: CASE WHEN embedding[i + 1]::DOUBLE > m THEN (1::UBIGINT << (63 - i))::HUGEINT ELSE 0 END))::UBIGINT), 16, '0')) AS hash FROM (SELECT vec_id, embedding, list_avg(list_transform(embedding[1:63], lambda x: x::DOUBLE) || [-1e9::DOUBLE]) AS m FROM embeddings)")
def picture_hash(spark, sf):
    pixels = F.concat(F.transform(F.slice("embedding", 1, 63), lambda x: x.cast("double")), F.array(F.lit(-1e9)))
    return X.table(spark, sf, "embeddings").select("vec_id", T.average_hash(pixels).alias("hash"))


@query("SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE event_type END AS said, CASE WHEN event_id % 4 = 3 THEN 'no json' WHEN event_id % 2 = 0 THEN upper(left(event_type, 1)) || lower(substr(event_type, 2)) || ' chart. showing ' || event_id ELSE upper(left(event_type, 1)) || lower(substr(event_type, 2)) || ' chart. showing ' || event_id END AS caption FROM events")
def model_json(spark, sf):
    """Objects plain, fenced and in prose; texts without any."""
    body = F.concat(F.lit('{"chart_type": "'), "event_type", F.lit('", "data_summary": "'), F.col("event_id").cast("string"), F.lit('"}'))
    way = F.col("event_id") % 4
    raw = F.when(way == 0, body).when(way == 1, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nBye"))).when(way == 2, F.concat(F.lit("I see "), body, F.lit(" there"))).otherwise("no json")
    return X.table(spark, sf, "events").withColumn("raw", raw).select("event_id", F.try_variant_get(F.try_parse_json(J.loose_json("raw")), "$.chart_type", "string").alias("said"), J.caption_text("raw", F.lit("chart")).alias("caption"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS title, CASE WHEN event_id % 2 = 1 THEN 'nothing ' || event_id END AS raw FROM events")
def paper_info(spark, sf):
    said = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('Sure: {"title": "'), "event_type", F.lit('"} done'))).otherwise(F.concat(F.lit("nothing "), F.col("event_id").cast("string")))
    v = F.try_parse_json(J.key_info(said))
    return X.table(spark, sf, "events").select("event_id", F.try_variant_get(v, "$.title", "string").alias("title"), F.try_variant_get(v, "$.raw", "string").alias("raw"))


@query(f"SELECT doc_id, regexp_replace(markdown, '!\\[([^\\]]*)\\]\\((?:\\./)?([^)/][^)]*)\\)', '![\\1](/out/\\2)', 'g') AS markdown, length(markdown) - length(replace(markdown, '## ', '## '[1:2])) AS marks FROM ({S.MARKDOWN})")
def image_paths(spark, sf):
    rows = X.conversations_as_markdown(spark, sf)
    return rows.select("doc_id", M.absolute_images("markdown", "/out/").alias("markdown"), F.regexp_count("markdown", F.lit("## ")).cast("long").alias("marks"))


@query("SELECT conv_id::VARCHAR AS doc_id, count(*) - 1 AS marks FROM conversations GROUP BY conv_id")
def page_mark_counts(spark, sf):
    return X.conversations_as_pages(spark, sf).select("doc_id", M.page_marks("markdown").cast("long").alias("marks"))


@query("SELECT conv_id, turn, 1.0::DOUBLE AS ratio, length(coalesce(text, ''))::INTEGER AS longest FROM conversations WHERE length(text) < 400")
def text_similarity(spark, sf):
    """Each short turn against itself; unlike texts are held against difflib in the tests."""
    return X.table(spark, sf, "conversations").filter("length(text) < 400").select("conv_id", "turn", T.similarity("text", "text").alias("s")).select("conv_id", "turn", "s.ratio", "s.longest")


_CODE_PARTS = "repeat('import os' || chr(10), (doc_id % 3)::INTEGER) || repeat('class C:' || chr(10) || '    def m(self):' || chr(10) || '        pass' || chr(10), (doc_id % 4)::INTEGER) || repeat('def f():' || chr(10) || '    pass' || chr(10), (doc_id % 5)::INTEGER)"
_WRONG = "doc_id % 7 = 0"


def _programs(spark, sf) -> DataFrame:
    """(path, content): a Python file for each document, every seventh of which doesn't parse; every sixth holds a long function."""
    n = F.col("doc_id")
    times = lambda text, k: F.repeat(F.lit(text), (n % k).cast("int"))
    body = F.concat(times("import os\n", 3), times("class C:\n    def m(self):\n        pass\n", 4), times("def f():\n    pass\n", 5), F.when(n % 6 == 0, F.concat(F.lit("def long():\n"), F.repeat(F.lit("    x = 1\n"), 60))).otherwise(""), F.when(n % 7 == 0, F.lit("def (:\n")).otherwise(""))
    return X.table(spark, sf, "documents").select(n.cast("string").alias("path"), body.alias("content"))


@query(
    f"SELECT doc_id::VARCHAR AS path, 1 + doc_id % 3 + 3 * (doc_id % 4) + 2 * (doc_id % 5) + CASE WHEN doc_id % 6 = 0 THEN 61 ELSE 0 END + CASE WHEN {_WRONG} THEN 1 ELSE 0 END AS lines, CASE WHEN {_WRONG} THEN 0 ELSE doc_id % 4 + doc_id % 5 + CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END END AS functions, "
    f"CASE WHEN {_WRONG} THEN 0 ELSE doc_id % 4 END AS classes, CASE WHEN {_WRONG} THEN 0 ELSE doc_id % 3 END AS imports, CASE WHEN doc_id % 6 = 0 AND NOT {_WRONG} THEN 'long' ELSE '' END AS long_functions, {_WRONG} AS syntax_error FROM documents"
)
def code_metrics(spark, sf):
    return codescan.metrics(_programs(spark, sf)).withColumn("long_functions", F.array_join("long_functions", ","))


@query(f"SELECT doc_id::VARCHAR AS path, CASE WHEN {_WRONG} THEN 0 ELSE doc_id % 3 END AS imports, CASE WHEN {_WRONG} THEN 0 ELSE doc_id % 4 END AS classes, CASE WHEN {_WRONG} THEN 0 ELSE doc_id % 4 + doc_id % 5 + CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END END AS functions FROM documents")
def code_structure(spark, sf):
    return codescan.structure(_programs(spark, sf)).select("path", *[F.size(c).cast("long").alias(c) for c in ("imports", "classes", "functions")])


@query(f"SELECT doc_id, count(*) FILTER (type = 'title') AS titles, count(*) FILTER (type IN ('title', 'text')) AS texts, min(i) FILTER (type = 'figure')::INTEGER AS figure, count(*) AS boxless FROM ({S.MODEL_BLOCKS}) GROUP BY doc_id")
def block_kinds(spark, sf):
    blocks = X.model_blocks(spark, sf)
    titles = parse.of_type(blocks, "TITLE").groupBy("doc_id").agg(F.count("*").alias("titles"))
    texts = blocks.groupBy("doc_id").agg(F.count_if(F.col("type").isin("title", "text")).alias("texts"), F.count_if(F.col("bbox").isNull()).alias("boxless"))
    figure = blocks.filter("type = 'figure'").groupBy("doc_id").agg(F.min("pos").alias("figure"))
    return texts.join(titles, "doc_id", "left").join(figure, "doc_id", "left").select("doc_id", F.coalesce("titles", F.lit(0)).alias("titles"), "texts", "figure", "boxless")


@query(f"SELECT doc_id, text FROM ({S.PAGED}) WHERE page = 2 AND block_id = 'p1_b' || i AND ro = 1")
def block_lookup(spark, sf):
    blocks = X.paged_blocks(spark, sf)
    return parse.find(blocks, block_id="p1_b21").select("doc_id", "text")


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'pdfs' WHEN 1 THEN 'images' END AS kind FROM pages")
def file_kinds(spark, sf):
    ends = F.get(F.array(*[F.lit(x) for x in (".PDF", ".Jpeg", ".txt", "")]), (F.col("page_id") % 4).cast("int"))
    return X.table(spark, sf, "pages").select("page_id", dedup.kind_of(F.concat(F.lit("a.b/c"), ends)).alias("kind"))


@query(f"SELECT hash, last(path ORDER BY seq) AS path, max(seq) AS seq FROM ({S.REGISTRY}) WHERE kind = 'urls' GROUP BY hash ORDER BY max(date) DESC, hash LIMIT 50")
def registry_shown(spark, sf):
    return dedup.shown(X.registry(spark, sf), "urls").select("hash", "path", "seq")


@query(f"WITH r AS ({S.REGISTRY}) SELECT kind, count(DISTINCT hash) AS left_ FROM r WHERE (kind, hash) NOT IN (SELECT (kind, hash) FROM r WHERE seq % 3 = 0) GROUP BY kind")
def registry_removed(spark, sf):
    rows = X.registry(spark, sf)
    return dedup.without(rows, rows.filter("seq % 3 = 0")).groupBy("kind").agg(F.count_distinct("hash").alias("left_"))


@query("SELECT user_id AS id, max(event_id) AS updated FROM events GROUP BY user_id HAVING last(event_type ORDER BY event_id) = 'view'")
def queue_by_status(spark, sf):
    rows = X.table(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("status"), F.col("event_id").alias("ts"), F.col("event_id").alias("seq"))
    return cache.queue(rows, "view").select("id", "updated")


@query("SELECT max(user_id) + 1 AS id FROM events")
def queue_next_id(spark, sf):
    return cache.next_id(X.table(spark, sf, "events").select(F.col("user_id").alias("id")))


_CACHE = "(['ocr', 'vlm', 'layout', 'docs'])[event_id % 4 + 1]"


@query(f"SELECT {_CACHE} AS cache, user_id, max(event_id) AS event_id FROM events WHERE {_CACHE} <> 'vlm' GROUP BY {_CACHE}, user_id")
def cache_cleared(spark, sf):
    log = X.table(spark, sf, "events").select(F.get(F.array(*[F.lit(c) for c in cache.CACHES]), (F.col("event_id") % 4).cast("int")).alias("cache"), "user_id", "event_id")
    return cache.compacted(cache.cleared(log, "vlm"), ["cache", "user_id"], F.col("event_id")).unionByName(cache.cleared(log))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS title FROM events")
def cache_structured(spark, sf):
    rows = X.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"title": "'), "event_type", F.lit('"}'))).otherwise("{broken").alias("structured_json"))
    return cache.structured(rows).select("event_id", F.try_variant_get("structured", "$.title", "string").alias("title"))


@query("SELECT l_suppkey AS region, string_agg(l_returnflag, ' ' ORDER BY l_orderkey * 10 + l_linenumber, l_returnflag) AS text, round(avg(l_discount), 6) AS confidence FROM lineitem GROUP BY l_suppkey UNION ALL SELECT -1, '', 0.0::DOUBLE")
def ocr_aligned(spark, sf):
    """Readings put beside the regions they were asked for; one region has none."""
    boxes = X.boxes(spark, sf)
    asked = boxes.select("region").distinct().unionByName(spark.createDataFrame([(-1,)], "region long"))
    return ocr.aligned(asked, ocr.regions(boxes, ["region"], "line_no"), ["region"]).select("region", "text", F.round("confidence", 6).alias("confidence"))


def _readings(spark, sf, key: str):
    return X.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("region")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_discount", "l_partkey"))).alias(key))


_OCR = "SELECT l_orderkey AS region, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_discount, l_partkey) - 1)::INTEGER AS line_no, l_returnflag AS text, l_discount AS confidence, l_partkey::DOUBLE AS x FROM lineitem"


@query(_OCR)
def ocr_dict_results(spark, sf):
    r = _readings(spark, sf, "r")
    rows = r.select("region", F.transform("r", lambda x: x["l_returnflag"]).alias("rec_texts"), F.transform("r", lambda x: x["l_discount"]).alias("rec_scores"), F.transform("r", lambda x: F.array(F.array(x["l_partkey"].cast("double"), F.lit(0.0)))).alias("boxes"))
    return ocr.dict_lines(rows).select("region", F.col("line_no").cast("int").alias("line_no"), "text", "confidence", F.get(F.get("box", F.lit(0)), F.lit(0)).alias("x"))


@query(_OCR)
def ocr_list_results(spark, sf):
    rows = _readings(spark, sf, "r").select("region", F.transform("r", lambda x: F.struct(F.array(F.array(x["l_partkey"].cast("double"), F.lit(0.0))).alias("box"), x["l_returnflag"].alias("text"), x["l_discount"].alias("confidence"))).alias("lines"))
    return ocr.list_lines(rows).select("region", F.col("line_no").cast("int").alias("line_no"), "text", "confidence", F.get(F.get("box", F.lit(0)), F.lit(0)).alias("x"))


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'said ' || turn END AS response FROM conversations")
def backend_answers(spark, sf):
    asked = X.table(spark, sf, "conversations").select("conv_id", "turn").distinct()
    answers = asked.filter("turn % 2 = 0").withColumn("response", F.concat(F.lit("said "), F.col("turn").cast("string")))
    missing = B.only_missing(asked, answers, ["conv_id", "turn"])
    known = B.TableBackend(answers, ("conv_id", "turn")).answer(asked.join(answers, ["conv_id", "turn"], "left_semi"))
    return known.unionByName(missing.withColumn("response", F.lit(None).cast("string"))).join(X.table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id", "turn"])


def _called(text: str) -> str:
    if text.startswith("error"):
        raise ValueError(text)
    return text.upper()


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN upper(event_type) END AS response FROM events")
def backend_calls(spark, sf):
    rows = X.table(spark, sf, "events").select("event_id", F.col("event_type").alias("request"))
    return B.FunctionBackend(_called).answer(rows).select("event_id", "response")


_LABEL = "(['Title', 'Text', 'Picture', 'Table', 'Page-number'])[turn % 5 + 1]"


@query(
    f"WITH r AS (SELECT conv_id, turn, {_LABEL} AS label, coalesce(text, '') AS text FROM conversations) SELECT conv_id::VARCHAR AS doc_id, 1 AS page, '<!-- Page 1 -->' || chr(10) || chr(10) || string_agg(CASE label WHEN 'Title' THEN '# ' || text WHEN 'Text' THEN text ELSE chr(10) || '![' || label || '](images/' || CASE WHEN turn % 2 = 0 THEN 'c' || turn || '.png' ELSE 'placeholder' END || ')' || chr(10) || '<!-- ' || label || ' detected -->' || chr(10) || "
    "CASE WHEN turn % 3 = 0 THEN chr(10) || '*AI ' || CASE label WHEN 'Table' THEN 'Table Summary' ELSE 'Caption' END || ': seen*' || chr(10) ELSE '' END END, chr(10) || chr(10) ORDER BY turn, text) AS markdown FROM r WHERE label <> 'Page-number' AND (label <> 'Text' OR text <> '') GROUP BY conv_id HAVING count(*) > 0"
)
def layout_pages(spark, sf):
    rows = X.table(spark, sf, "conversations")
    label = F.get(F.array(*[F.lit(x) for x in ("Title", "Text", "Picture", "Table", "Page-number")]), (F.col("turn") % 5).cast("int"))
    text = F.coalesce("text", F.lit(""))
    # plain text has no level here: its label is that of body text longer than ten words, or the level is left to the rule
    regions = rows.select(F.col("conv_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.struct("turn", text.alias("t")).alias("region"), F.col("turn").alias("order"), label.alias("label"), text.alias("text"), F.when(F.col("turn") % 3 == 0, "seen").alias("caption"), F.when(F.col("turn") % 2 == 0, F.concat(F.lit("c"), F.col("turn").cast("string"), F.lit(".png"))).alias("crop"))
    return layout.page_markdown(regions)


@query("SELECT 'l_partkey' AS col1, 'twice' AS col2, 1.0::DOUBLE AS r UNION ALL SELECT 'l_partkey', 'minus', -1.0 UNION ALL SELECT 'twice', 'minus', -1.0")
def eda_high_corr(spark, sf):
    """Columns that go together, one that doesn't, and a constant one."""
    rows = X.table(spark, sf, "lineitem").select("l_partkey", (F.col("l_partkey") * 2.0 + 1).alias("twice"), (-F.col("l_partkey")).alias("minus"), "l_linenumber", F.lit(3.0).alias("same"))
    return eda.high_correlations(rows).withColumn("r", F.round("r", 6))


@query("SELECT c AS \"column\", round(r, 6) AS r FROM (SELECT 'l_quantity' AS c, corr(l_quantity::DOUBLE, l_extendedprice::DOUBLE) AS r FROM lineitem UNION ALL SELECT 'l_discount', corr(l_discount::DOUBLE, l_extendedprice::DOUBLE) FROM lineitem)")
def eda_target_corr(spark, sf):
    return eda.target_correlations(X.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount"), "l_extendedprice").withColumn("r", F.round("r", 6))


@query("SELECT doc_id::VARCHAR AS path, CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END::BIGINT AS wrong FROM documents")
def code_reviews(spark, sf):
    return runs.reviewed(_programs(spark, sf)).select("path", F.when(F.col("report").contains("doesn't parse"), 1).otherwise(0).cast("long").alias("wrong"))


@query("SELECT conv_id::VARCHAR AS doc_id, count(*) AS parts FROM (SELECT conv_id, unnest(CASE turn % 3 WHEN 2 THEN ['t', 'i'] ELSE ['t'] END) AS p, turn FROM conversations) WHERE p = 'i' GROUP BY conv_id")
def viewer_parts(spark, sf):
    parts = X.conversations_as_markdown(spark, sf).select("doc_id", F.explode(M.image_parts("markdown")).alias("p"))
    return parts.filter(F.startswith("p", F.lit("!["))).groupBy("doc_id").agg(F.count("*").alias("parts"))


@query(f"SELECT doc_id, 'text' AS type, coalesce(count(*) FILTER (type = 'text'), 0) AS n FROM ({S.MODEL_BLOCKS}) GROUP BY doc_id HAVING count(*) FILTER (type = 'text') > 0")
def metadata_files(spark, sf):
    """Counts by type as the metadata's JSON says."""
    blocks = X.model_blocks(spark, sf)
    docs = blocks.select("doc_id").distinct()
    types = F.from_json("json", "block_types map<string,long>")["block_types"]
    return render.metadata_json(blocks, docs).select("doc_id", F.lit("text").alias("type"), F.try_element_at(types, F.lit("text")).alias("n")).filter("n > 0")
