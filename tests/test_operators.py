"""Operators on small hand-made inputs with the results their rules give."""

import random

import pytest
from pyspark.sql import functions as F

from blockspark.backends import base as B
from blockspark.config import ChunkingConfig, ProcessorConfig
from blockspark.functions import markdown as M
from blockspark.functions import text as T
from blockspark.operators import cache, chunk, codescan, dedup, eda, evaluate, ocr, pages, parse, render, translate
from blockspark.plans.fixtures import CODE
from blockspark.sinks import writers
from blockspark.sources import files

BLOCK = "doc_id string, pos int, page int, block_id string, type string, reading_order int, text string, markdown string, caption string, anchor string"


def make(spark, rows):
    """rows: (type, text) in order."""
    return spark.createDataFrame([("d" * 16, i, 1, f"p1_b{i}", t, i, x, None, None, f"[{i}]") for i, (t, x) in enumerate(rows)], BLOCK)


def model(rows, c):
    """The chunker row by row: (s, e, section)."""
    toks = [len(x) // 4 for _, x in rows]
    out, s, k, sec = [], 0, 0, None

    def overlap(s, e):
        z, total = e + 1, 0
        while z > s and total + toks[z - 1] <= c.overlap_tokens:
            z -= 1
            total += toks[z]
        return z if c.overlap_tokens > 0 else e + 1

    for i, (kind, x) in enumerate(rows):
        if kind in ("title", "section_header") and c.respect_sections:
            if s < i and k >= c.min_chunk_size:
                out.append((s, i - 1, sec))
                s = overlap(s, i - 1)
                k = sum(toks[s:i])
            sec = x.strip()
        k += toks[i]
        if k >= c.chunk_size and (c.respect_paragraphs and not x.strip() or k >= c.max_chunk_size):
            out.append((s, i, sec))
            s = overlap(s, i)
            k = sum(toks[s : i + 1])
    if s < len(rows):
        out.append((s, len(rows) - 1, sec))
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("change", [{}, {"overlap_tokens": 0}, {"respect_sections": False}, {"respect_paragraphs": False}])
def test_chunker_same_as_row_by_row(spark, seed, change):
    r = random.Random(seed)
    c = ChunkingConfig(**({"chunk_size": 40, "overlap_tokens": 12, "min_chunk_size": 8, "max_chunk_size": 70} | change))
    rows = [(r.choice(["text", "text", "text", "title", "section_header"]), r.choice(["", "   ", "x" * r.randint(1, 90), "y" * r.randint(1, 90)])) for _ in range(60)]
    got = [(x.s, x.e, x.section) for x in chunk.chunk_runs(make(spark, rows), c).orderBy("k").collect()]
    assert got == model(rows, c)


def test_chunk_text_and_tokens(spark):
    got = chunk.chunk_blocks(make(spark, [("text", ("A sentence of 18. " * 50))] * 5), ChunkingConfig(chunk_size=500, overlap_tokens=50)).collect()
    assert len(got) == 1 and got[0].char_count == 4508 and got[0].token_count == 1127 and len(got[0].block_ids) == 5 and got[0].section is None and got[0].chunk_id == "dddddddd_c0"


def test_config_presets():
    assert (ProcessorConfig().mode, ProcessorConfig().dpi) == ("markdown", 200)
    assert ProcessorConfig.rag().mode == "both" and ProcessorConfig.rag().enable_chunking
    assert ProcessorConfig().with_chunks(chunk_size=5).chunking.chunk_size == 5


@pytest.mark.parametrize("words,closed", [(100, False), (101, True)])
def test_legacy_heading_limit(spark, words, closed):
    text = " ".join(["w"] * words) + "\n## Next\nend"
    rows = chunk.legacy_chunks(spark.createDataFrame([("a", text)], "doc_id string, markdown string")).orderBy("k").collect()
    assert [r.section for r in rows] == (["Introduction", "Next"] if closed else ["Next"])


@pytest.mark.parametrize("words,closed", [(500, False), (501, True)])
def test_legacy_table_limit(spark, words, closed):
    text = " ".join(["w"] * words) + "\n| a |\n| b |"
    assert chunk.legacy_chunks(spark.createDataFrame([("a", text)], "doc_id string, markdown string")).count() == 1 + closed


def test_model_answers(spark):
    rows = [
        ("a", 1, 'so: {"page_elements":[{"type":"section","content":"S","metadata":{"section_number":"2.1"}},{"content":"no type"},{"type":"odd","content":"o","metadata":null},{"content":"c","type":"figure","metadata":{"figure_number":"Fig 1","caption":"cap"}}]}'),
        ("b", 1, "nothing"), ("c", 1, '{"page_elements":[]}'), ("d", 1, None),
    ]
    got = parse.enriched(parse.element_blocks(spark.createDataFrame(rows, "doc_id string, page int, response string"))).orderBy("pos").collect()
    assert [(g.doc_id, g.block_id, g.type, g.markdown, g.confidence) for g in got] == [
        ("a", "p1_b0", "title", "## 2.1 S", 0.95), ("a", "p1_b1", "text", "no type", 0.95), ("a", "p1_b2", "text", "o", 0.95), ("a", "p1_b3", "figure", "![Fig 1: cap](placeholder)", 0.0),
    ]


def blocks_of(spark, text):
    rows = parse.markdown_blocks(spark.createDataFrame([("a", 1, text)], "doc_id string, page int, markdown string")).orderBy("reading_order").collect()
    return [(r.type, r.text) for r in rows]


def test_markdown_blocks(spark):
    assert blocks_of(spark, "| a | b |\n|---|---|\n\n| c | d |\nend") == [("table", "a | b\nc | d"), ("text", "end")]
    assert blocks_of(spark, "| a |\n# H\n| b |\ntext") == [("title", "H"), ("table", "a\nb"), ("text", "text")]
    assert blocks_of(spark, "p1\np2\n\n$$x$$\n![](i.png)\n| a |") == [("text", "p1\np2"), ("formula", "x"), ("figure", "[Figure]"), ("table", "a")]
    assert blocks_of(spark, "  \n") == []


def test_order_and_titles(spark):
    rows = [("d", i, 1, "", t, o, x, None, None, "") for i, (t, o, x) in enumerate([("text", 1000, "c"), ("text", None, "b"), ("text", 5, "a"), ("title", 6, "  ")])] + [("d", 9, 2, "", "title", 0, "T", None, None, "")]
    blocks = spark.createDataFrame(rows, BLOCK)
    assert [r.text for r in parse.ordered(blocks).filter("type = 'text'").orderBy("pos").collect()] == ["a", "b", "c"]
    assert parse.doc_titles(blocks).first().title == "T"


def test_writer(spark):
    rows = [("d", 0, 1, "", "title", 0, "T", None, None, "[a]"), ("d", 1, 1, "", "text", 1, "x", None, None, "[b]"), ("d", 2, 2, "", "table", 0, "t", None, "cap", "[c]"), ("d", 3, 2, "", "figure", 1, None, None, "F", "[d]"), ("d", 4, 2, "", "header", 2, "h", None, None, "[e]"), ("d", 5, 2, "", "text", 3, "", "", None, "[f]")]
    blocks = spark.createDataFrame(rows, BLOCK).withColumn("image_path", F.when(F.col("type") == "figure", "i.png"))
    docs = spark.createDataFrame([("d", "T", 2, "now", "2.0.0"), ("e", None, 0, "now", "2.0.0")], "doc_id string, title string, total_pages int, created_at string, parser_version string")
    got = {r.doc_id: r.markdown for r in render.writer_markdown(blocks, docs).collect()}
    assert got["d"] == "# T\n\n# T\n\nx\n\n\n---\n<!-- Page 2 -->\n\n[Table]\n\n```\nt\n```\n\n*Table: cap*\n\n![F](i.png)\n\n*Figure: F*\n\n*h*\n"
    assert got["e"] == ""
    with_anchors = {r.doc_id: r.markdown for r in render.writer_markdown(blocks, docs, True).collect()}["d"]
    assert "x [b]\n" in with_anchors and with_anchors.endswith("| Parser Version | 2.0.0 |\n| Title | T |")
    other = {r.doc_id: r.markdown for r in render.export_markdown(blocks, docs, True).collect()}["d"]
    assert other.startswith("# T\n\nT [a]\n\nx [b]\n\n") and other.endswith("- **Parser Version**: 2.0.0")
    assert spark.range(1).select(M.visual_block(F.lit("chart"), F.lit("[a]"), F.lit(None).cast("string"), F.lit(None).cast("string"))).first()[0] == "[Chart] [a]\n\n*No description available*"
    assert spark.range(1).select(M.text_block(F.lit("footnote"), F.lit("n"), F.lit(3))).first()[0] == "[^3]: n"


def test_metadata_without_confidence(spark):
    blocks = spark.createDataFrame([("d", "text", None, 0.0), ("d", "text", "ab", 0.0)], "doc_id string, type string, text string, confidence double")
    got = render.metadata(blocks).first()
    assert (got.total_blocks, got.total_text_chars, got.avg_confidence) == (2, 2, 0.0)


def merged(spark, text, answers, context=500):
    docs = spark.createDataFrame([("d", text)], "doc_id string, markdown string")
    table = spark.createDataFrame([("d", i, a) for i, a in enumerate(answers)], "doc_id string, boundary int, output string")
    return pages.merge(docs, table, context).first().markdown


def test_page_merge(spark):
    mark = "\n---\n<!-- Page 2 -->\n"
    assert merged(spark, f"one two-{mark}three. four", ["NO_MERGE_REQUIRED, as said"]) == f"one two-{mark}three. four"
    assert merged(spark, f"one two-{mark}three. four", ["twothree"], 4) == "one \n\ntwothree\n\ne. four"
    assert merged(spark, f"one{mark}     rest", ["x"], 3) == "\n\nx\n\n  rest"
    assert merged(spark, "no marks", []) == "no marks"
    both = f"a{mark}b{mark.replace('2', '3')}c"
    assert merged(spark, both, [None, "BC"]) == f"a{mark}\n\nBC\n\n"


def test_paragraphs_and_translations(spark):
    text = "# H\npara one\nstill one\n\n```\ncode\n```\n- item\n*AI note\n> quote"
    parts = translate.paragraphs(spark.createDataFrame([("d", text)], "doc_id string, markdown string"))
    got = [(r.special, r.content) for r in parts.orderBy("part").collect()]
    assert got == [(True, "# H"), (False, "para one\nstill one"), (True, ""), (True, "```"), (False, "code"), (True, "```"), (False, "- item"), (True, "*AI note"), (True, "> quote")]
    said = spark.createDataFrame([("d", 0, "T0"), ("d", 1, "")], "doc_id string, para_idx long, translation string")
    two = translate.bilingual(parts, said).first().markdown
    assert two.startswith("# H\npara one\nstill one\n\n> *T0*\n\n\n```\ncode\n\n> *(translation unavailable)*\n\n```")
    assert translate.monolingual(parts, said).first().markdown == "# H\nT0\n\n```\ncode\n```\n- item\n*AI note\n> quote"


def line_order(items, width):
    """Column-aware order by recursion: (x, y, height) each."""
    if len(items) > 10:
        mid = width / 2
        left, right = [i for i in items if i[0] < mid], [i for i in items if i[0] >= mid]
        if left and right:
            low = [min(i[1] for i in side) for side in (left, right)]
            high = [max(i[1] + i[2] for i in side) for side in (left, right)]
            total = max(high) - min(low)
            if total > 0 and max(0, min(high) - max(low)) / total > 0.3:
                return line_order(left, mid) + line_order(right, width - mid)
    return sorted(items, key=lambda i: (int((i[1] + i[2] / 2) / 10) * 10, i[0]))


@pytest.mark.parametrize("n,seed", [(10, 1), (11, 2), (12, 3), (60, 4), (200, 5), (300, 6)])
def test_line_order(spark, n, seed):
    r = random.Random(seed)
    items = [(r.random() * 600, r.random() * 800, 8.0) for _ in range(n)]
    rows = [(0, i, [[x, y], [x, y], [x, y + h], [x, y + h]], 600.0) for i, (x, y, h) in enumerate(items)]
    df = spark.createDataFrame(rows, "region int, line_no int, box array<array<double>>, width double")
    got = [items[g.line_no] for g in ocr.reading_order(df, ["region"]).orderBy("nth").collect()]
    assert got == line_order(items, 600.0)


def test_ocr_parsing(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [0.5], [[[0.0, 0.0]], [[1.0, 1.0]]]), (2, ["x"], [], []), (3, [], [], [])], "region int, rec_texts array<string>, rec_scores array<double>, boxes array<array<array<double>>>")
    got = sorted((r.region, r.line_no, r.text, r.confidence, len(r.box)) for r in ocr.dict_lines(df).collect())
    assert got == [(1, 0, "a", 0.5, 1), (1, 1, "b", 0.0, 1), (2, 0, "x", 0.0, 4)]
    found = ocr.regions(ocr.dict_lines(df), ["region"], "line_no")
    back = ocr.aligned(spark.createDataFrame([(1,), (9,)], "region int"), found, ["region"]).orderBy("region").collect()
    assert [(r.text, r.confidence) for r in back] == [("a b", 0.25), ("", 0.0)]


def test_security_rules(spark):
    got = codescan.findings(spark.createDataFrame([("f", CODE.replace("~", "\n")), ("n", None)], "path string, content string")).collect()
    assert {g.message for g in got} == {m for _, m, _ in codescan.RULES}
    assert sorted(g.line for g in got if g.line == 8) == [8, 8]
    assert 13 not in {g.line for g in got}


def test_code_metrics(spark):
    long = "def f():\n" + "    x = 1\n" * 60
    rows = [("a", "import os\nfrom x import y\nclass A:\n    async def m(self): pass\n"), ("b", long), ("c", "def ("), ("d", None)]
    got = {r.path: r for r in codescan.metrics(spark.createDataFrame(rows, "path string, content string")).collect()}
    assert (got["a"].functions, got["a"].classes, got["a"].imports, got["a"].lines) == (1, 1, 2, 5)
    assert got["b"].long_functions == ["f"] and got["c"].syntax_error and got["d"].lines == 1
    shape = codescan.structure(spark.createDataFrame([("a", '"""Doc."""\nimport os\ndef _p(): pass\ndef q(): pass\nclass A:\n    def __init__(self): pass\n')], "path string, content string")).first()
    assert (shape.imports, shape.classes, sorted(shape.functions), shape.docstring) == (["os"], ["A"], ["__init__", "q"], "Doc.")
    assert "## Security\n\nnone" in codescan.review(spark.createDataFrame([("a", "x = 1")], "path string, content string")).first().report


def test_eda_edges(spark):
    df = spark.createDataFrame([(1.0, 1, 5, "b"), (float("nan"), 2, 5, "a"), (None, 3, 5, "a"), (100.0, 4, 5, "b")], "x double, y int, k int, s string")
    gone = {r["column"]: r.missing for r in eda.missing(df).collect()}
    assert gone == {"x": 2, "y": 0, "k": 0, "s": 0}
    stats = {r["column"]: r for r in eda.describe(df).collect()}
    assert stats["x"]["count"] == 2 and stats["k"]["std"] == 0.0 and stats["y"]["q25"] == 1.75
    assert eda.categorical(df).first().top == "a"
    r = {(c.col1, c.col2): c.r for c in eda.correlations(df).collect()}
    assert r["x", "k"] is None and abs(r["x", "y"] - 1) < 1e-12
    assert [(c.col1, c.col2) for c in eda.high_correlations(df).collect()] == [("x", "y")]
    assert eda.outliers(df, "other").count() == 0
    assert "# Exploratory analysis: t" in eda.report(df, "t")


def test_dedup(spark):
    rows = [("pdfs", "h1", "a", "1", None, 1), ("pdfs", "h1", "b", "2", None, 2), ("urls", "u", "c", "3", None, 3)]
    events = spark.createDataFrame(rows, "kind string, hash string, path string, date string, preview string, seq long")
    assert {(r.hash, r.path) for r in dedup.registered(events).collect()} == {("h1", "b"), ("u", "c")}
    assert {(r.hash, r.path) for r in dedup.registered(events, "first").collect()} == {("h1", "a"), ("u", "c")}
    assert {r.kind: r.total for r in dedup.stats(events).collect()} == {"pdfs": 1, "images": 0, "urls": 1, "texts": 0}
    assert dedup.without(events, spark.createDataFrame([("pdfs", "h1")], "kind string, hash string")).count() == 1
    assert [r.date for r in dedup.listing(events).collect()] == ["3", "2"] and dedup.listing(events, "urls").count() == 1
    kinds = spark.createDataFrame([("A.PDF",), ("x/y.jpeg",), ("z.txt",), ("none",)], "p string").select(dedup.kind_of("p").alias("k")).collect()
    assert [k.k for k in kinds] == ["pdfs", "images", None, None]


def test_cache_and_queue(spark):
    writes = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1)], "image_hash string, created_at int")
    reads = spark.createDataFrame([("a", 2), ("a", 6), ("a", 7), ("c", 1)], "image_hash string, created_at int")
    assert {r.image_hash: r.hit_count for r in cache.hits(writes, reads, ["image_hash"]).collect()} == {"a": 2, "b": 0}
    events = spark.createDataFrame([(1, "p", "pending", "t1", 1), (1, None, "done", "t2", 2), (2, "q", "pending", "t3", 3), (2, None, "removed", "t4", 4)], "id long, path string, status string, ts string, seq long")
    got = cache.queue(events).collect()
    assert [(g.id, g.path, g.status, g.added, g.updated) for g in got] == [(1, "p", "done", "t1", "t2")]
    assert cache.queue(events, "pending").count() == 0 and cache.next_id(events).first().id == 3


def test_evaluate(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), (None, "a")], "predicted string, answer string")
    assert evaluate.accuracy(df).first()[:] == (3, 1, 1 / 3) and evaluate.accuracy(df.limit(0)).first().accuracy == 0.0
    assert evaluate.remaining_seconds(6, None, 2) == 90.0


def test_backends(spark):
    asked = spark.createDataFrame([("a", 1, "x"), ("b", 1, "boom")], "doc_id string, page int, request string")
    table = B.TableBackend(spark.createDataFrame([("a", 1, "R")], "doc_id string, page int, response string"), ("doc_id", "page"))
    assert {r.doc_id: r.response for r in table.answer(asked).collect()} == {"a": "R", "b": None}

    def call(text):
        if text == "boom":
            raise ValueError(text)
        return text.upper()

    assert {r.doc_id: r.response for r in B.FunctionBackend(call).answer(asked).collect()} == {"a": "X", "b": None}
    assert B.only_missing(asked, asked.limit(1), ["doc_id"]).count() == 1
    assert "Text near it: abc" in spark.createDataFrame([("chart", "abc")], "type string, c string").select(B.picture_prompt(context="c")).first()[0]


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/node_modules").mkdir()
    for name, text in (("in/a.md", "# A"), ("in/sub/b.txt", "b"), ("in/x.PDF", "pdf"), ("in/sub/y.pdf", "no"), ("in/c.py", "eval(x)"), ("in/node_modules/d.py", "eval(x)")):
        (tmp_path / name).write_text(text)
    root = f"{tmp_path}/in"
    assert files.texts(spark, root).count() == 2
    assert [r.filename for r in files.pdfs(spark, root).collect()] == ["x.PDF"]
    assert [r.path.rsplit("/", 1)[1] for r in files.code(spark, root).collect()] == ["c.py"]
    assert files.tabular(spark, "x.xlsx") is None
    assert files.table_or_empty(spark, f"{tmp_path}/none", "a int").count() == 0
    assert files.one_text(spark, "x").count() == 1
    assert [r.filename for r in files.listing(spark, root).collect()] == ["a.md"]
    (tmp_path / "q.json").write_text('[{"question": "q", "answer": "a"}]')
    assert files.questions(spark, f"{tmp_path}/q.json").first().answer == "a"
    paths = spark.createDataFrame([("a/b.md", "r/s/t.md")], "p string, q string").select(writers.beside("p", "_merged").alias("x"), writers.translated_path("q", "r").alias("y"), writers.output_path("markdown", "o", F.lit("f.pdf")).alias("z"), writers.output_path("both", "o/", doc=F.lit("d")).alias("w")).first()
    assert paths[:] == ("a/b_merged.md", "r_translated/s/t.md", "o/f_qwenvl.md", "o/d")
    blocks = make(spark, [("title", "T"), ("text", "é")]).withColumn("image_path", F.lit(None).cast("string")).withColumn("confidence", F.lit(0.9))
    docs = spark.createDataFrame([("d" * 16, "T", 1, "now", "2.0.0")], "doc_id string, title string, total_pages int, created_at string, parser_version string")
    writers.write_all(blocks, docs, f"{tmp_path}/out", chunk.chunk_blocks(blocks))
    for kind, want in (("markdown", "# T"), ("blocks", '"markdown":null'), ("metadata", '"block_types":{"text":1,"title":1}'), ("chunks", '"page_range":[1,1]')):
        text = "".join(p.read_text() for p in (tmp_path / "out" / kind).rglob("part-*"))
        assert want in text and ("é" in text or kind == "metadata")


def test_streaming(spark, tmp_path):
    from blockspark.streaming import ingest

    (tmp_path / "s").mkdir()
    for name, text in (("a.txt", "same"), ("b.txt", "same"), ("c.txt", "other")):
        (tmp_path / "s" / name).write_text(text)
    stream = ingest.without_copies(ingest.text_stream(spark, f"{tmp_path}/s"))
    q = stream.writeStream.format("memory").queryName("ingested").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.content for r in spark.table("ingested").collect()) == ["other", "same"]


def test_find_and_pairs(spark):
    blocks = make(spark, [("title", "T"), ("Text", "x"), ("text", "y")])
    assert parse.of_type(blocks, "TEXT").count() == 2
    assert [r.text for r in parse.find(blocks, block_id="p1_b1").collect()] == ["x"]
    assert [r.text for r in parse.find(blocks.withColumn("anchor", F.lit("[a]")), anchor="[a]").collect()] == ["T"]
    parts = translate.paragraphs(spark.createDataFrame([("d", "# H\none\n\ntwo")], "doc_id string, markdown string"))
    said = spark.createDataFrame([("d", 0, "eins")], "doc_id string, para_idx long, translation string")
    assert [(r.original, r.translation) for r in translate.pairs(parts, said).orderBy("part").collect()] == [("one", "eins"), ("two", "")]


def test_runs(spark):
    from blockspark.plans import runs

    files_ = spark.createDataFrame([("a" * 16, "in/a.pdf", "a.pdf", b"A"), ("b" * 16, "in/b.pdf", "b.pdf", b"B")], "doc_id string, source_path string, filename string, content binary")
    asked = spark.createDataFrame([("a" * 16, 1), ("a" * 16, 2), ("b" * 16, 1)], "doc_id string, page int")
    answers = spark.createDataFrame([("a" * 16, 1, '{"page_elements":[{"content":"Head","type":"title"},{"content":"body","type":"paragraph"}]}'), ("a" * 16, 2, "none"), ("b" * 16, 1, "{}")], "doc_id string, page int, response string")
    registry = spark.createDataFrame([("pdfs", "x", "old.pdf", "d", None, 1)], "kind string, hash string, path string, date string, preview string, seq long")
    registry = registry.withColumn("hash", F.sha2(F.lit(b"B"), 256))
    read = spark.createDataFrame([("a" * 16, 2, "read", 0.5)], "doc_id string, page int, text string, confidence double")
    got = runs.process(files_, asked, B.TableBackend(answers, ("doc_id", "page")), ProcessorConfig.rag(), "now", registry, read)
    assert [(r.filename, r.reason) for r in got.skipped.collect()] == [("b.pdf", "duplicate of old.pdf")]
    assert [(r.page, r.text) for r in got.blocks.orderBy("pos").collect()] == [(1, "Head"), (1, "body"), (2, "read")]
    assert got.documents.first().title == "Head" and got.documents.count() == 1
    assert "<!-- Page 2 -->" in got.markdown.first().markdown and '"total_blocks":3' in got.metadata.first().json
    assert got.chunks.first().section == "# Head" and got.registrations.count() == 1
    texts = spark.createDataFrame([("in/x.md", "# H\none")], "path string, content string")
    out = runs.translated(texts, spark.createDataFrame([("in/x.md", 0, "eins")], "doc_id string, para_idx long, translation string"), "in").first()
    assert (out.path, out.content) == ("in_translated/x.md", "# H\neins")
    assert runs.language_of(texts).first().target == "ko"
    assert [r.path for r in runs.reviewed(texts).collect()] == [r.path for r in texts.orderBy('path').collect()]


def test_long_documents_chunk_in_linear_time(spark):
    import time

    from blockspark.config import ChunkingConfig

    n = 50_000
    text = "\n".join("" if k % 9 == 8 else f"line {k} of a very long document" for k in range(n))
    start = time.time()
    blocks = chunk.lines_as_blocks(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    runs_ = chunk.chunk_runs(blocks, ChunkingConfig()).orderBy("k").collect()
    assert runs_[0].s == 0 and runs_[-1].e == n - 1 and all(a.e >= b.s - 1 and a.s < b.s for a, b in zip(runs_, runs_[1:], strict=False))
    old = chunk.legacy_chunks(spark.createDataFrame([("a", text)], "doc_id string, markdown string"), chunk_size=50).orderBy("k").collect()
    assert "\n".join(r.content for r in old) == text and len(old) > 1000
    assert time.time() - start < 60


def test_order_statistics_and_correlations_match_numpy(spark):
    import numpy as np

    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=500) * 1e6, [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324], np.repeat(7.25, 300)])
    y = np.where(r.random(len(x)) < 0.1, np.nan, np.where(np.isfinite(x), x, 0) * 2 + r.normal(size=len(x)))
    df = spark.createDataFrame([(float(a), None if k % 11 == 0 else float(b), 4.0, None) for k, (a, b) in enumerate(zip(x, y, strict=True))], "x double, y double, c double, gone int").repartition(5)
    ys = np.array([b for k, b in enumerate(y) if k % 11 and not np.isnan(b)])
    got = eda.quantiles(df, ["x", "y", "c", "gone"], (0.0, 0.1, 0.25, 0.5, 0.9, 1.0))
    assert np.allclose(got[1], np.percentile(ys, [0, 10, 25, 50, 90, 100]), rtol=0, atol=1e-6)
    assert got[0][0] == -np.inf and got[0][-1] == np.inf and got[0][3] == np.sort(x)[len(x) // 2 - 1 : len(x) // 2 + 1].mean()
    assert got[2] == [4.0] * 6 and got[3] == [None] * 6
    assert eda.quantiles(df.limit(0), ["x"]) == [[None] * 3]
    fine = df.filter("abs(x) < 1e300")
    r_ = {(p.col1, p.col2): p.r for p in eda.correlations(fine).collect()}
    both = [(a, b) for k, (a, b) in enumerate(zip(x, y, strict=True)) if k % 11 and not np.isnan(b) and np.isfinite(a)]
    assert abs(r_["x", "y"] - np.corrcoef(np.array(both).T)[0, 1]) < 1e-9
    assert r_["x", "c"] is None and r_["x", "gone"] is None and len(r_) == 6
    assert [p.r for p in eda.correlations(fine.limit(0)).collect()] == [None] * 6
    assert eda.describe(df.limit(0)).count() == 4 and eda.outliers(df.limit(0)).count() == 4


def test_parser_errors_of_any_kind(spark):
    rows = [("deep", "(" * 50_000), ("nul", "a\0b"), ("fine", "x = 1"), ("none", None)]
    got = {r.path: r.syntax_error for r in codescan.metrics(spark.createDataFrame(rows, "path string, content string")).collect()}
    assert got == {"deep": True, "nul": True, "fine": False, "none": False}
    assert codescan.structure(spark.createDataFrame(rows, "path string, content string")).count() == 4


def test_similarity_same_as_difflib(spark):
    import difflib

    rows = [("abcd", "bcde"), ("", "x"), (None, None), ("the quick fox", "a quick dog")]
    for r in spark.createDataFrame(rows, "a string, b string").select("a", "b", T.similarity("a", "b").alias("s")).collect():
        assert abs(r.s.ratio - difflib.SequenceMatcher(None, r.a or "", r.b or "").ratio()) < 1e-12


def test_unreadable_files_and_strict_objects(spark):
    from blockspark.sources import files

    rows = spark.createDataFrame([("a.pdf", b"%PDF-1.4"), ("b.PDF", b"junk"), ("c.pdf", b""), ("d.pdf", None), ("e.txt", b"x")], "filename string, content binary")
    assert {r.filename: r.status for r in files.readable(rows).collect()} == {"a.pdf": "ok", "b.PDF": "unreadable", "c.pdf": "empty", "d.pdf": "empty", "e.txt": "ok"}
    said = spark.createDataFrame([('{"a": 1}',), ("broken",)], "v string")
    assert [r.a for r in files.objects(said, "v", "a int").collect()] == [1, None]
    with pytest.raises(Exception, match="unknown keys"):
        files.objects(spark.createDataFrame([('{"a": 1, "z": 2}',)], "v string"), "v", "a int", strict=True).collect()


def test_region_crops(spark):
    from blockspark.operators import layout

    rows = spark.createDataFrame([("d", 1, 1, "Table", [-5.0, 2.0, 900.0, 50.0]), ("d", 1, 2, "Figure", [10.0, 10.0, 10.0, 40.0]), ("d", 1, 3, "Chart", None)], "doc_id string, page int, region int, label string, bbox array<double>")
    got = layout.crops(rows, F.lit(600), F.lit(800)).collect()
    assert [(r.region, r.bbox) for r in got] == [(1, [0, 2, 600, 50])] and got[0].crop.startswith("table_p1_")


def test_insight_prompt(spark):
    said = eda.insight_prompt(spark.createDataFrame([(1.0, "a"), (3.0, None)], "x double, t string"))
    assert "2 rows, 2 columns" in said and '"mean": 2.0' in said and '"t": 50.0' in said
