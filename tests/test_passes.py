"""Queries over a model's answers read and parse them once, and what was several passes gives the same in one."""

import pytest
from pyspark.sql import functions as F

from blockspark.functions import json_text as J
from blockspark.operators import parse, render
from blockspark.plans import fixtures as X
from blockspark.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_answers_are_parsed_once(spark, sf):
    rows = parse.element_blocks(X.responses(spark, sf))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    answers = spark.createDataFrame([("a", 1, '{"page_elements":[]}'), ("b", 1, None), ("c", 1, "none"), ("d", 1, '{"page_elements":[null,{"content":"x"}]}')], "doc_id string, page int, response string")
    assert [(r.doc_id, r.pos, r.text) for r in parse.element_blocks(answers).orderBy("doc_id", "pos").collect()] == [("d", 0, ""), ("d", 1, "x")]


@pytest.mark.parametrize("name", ["render_markdown", "export_markdown"])
def test_one_pass(spark, sf, name):
    found = plan(registry.queries()[name](spark, sf))
    assert found.count("FileScan parquet") == 1 and found.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("text,want", [('} {"page_elements": []} {', '{"page_elements": []}'), ('{"page_elements"', ""), ('} "page_elements" {', ""), ('{"a": "page_elements"} b', '{"a": "page_elements"}'), (None, "")])
def test_elements_span(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(J.elements_json("t")).first()[0] == want


def test_title_in_one_pass(spark):
    rows = [("d", 2, 0, 0, "title", "late"), ("d", 1, 5, 1, "title", "no"), ("d", 1, None, 2, "title", "no"), ("d", 1, 1, 3, "title", " \n"), ("d", 1, 0, 4, "title", ""), ("d", 1, 0, 5, "text", "no"), ("d", None, 0, 6, "title", "no"), ("e", 1, 0, 0, "text", "x"), ("f", 3, 1, 0, "title", " T ")]
    blocks = spark.createDataFrame(rows, "doc_id string, page int, reading_order int, pos int, type string, text string")
    got = {r.doc_id: r.title for r in blocks.withColumn("heading", parse.heading()).groupBy("doc_id").agg(parse.first_title("heading").alias("title")).collect()}
    assert got == {"d": "late", "e": None, "f": "T"}
    assert {r.doc_id: r.title for r in parse.doc_titles(blocks).collect()} == {k: v for k, v in got.items() if v}


def test_marks_of_nulls_and_empty_blocks(spark):
    rows = [("d", None, 0, "a"), ("d", 1, 1, "b"), ("d", 2, 2, ""), ("d", 3, 3, "c"), ("x", 1, 0, "no document")]
    blocks = spark.createDataFrame(rows, "doc_id string, page int, pos int, text string").select("*", F.lit("text").alias("type"), *[F.lit(None).cast("string").alias(c) for c in ("markdown", "caption", "image_path", "anchor")], F.lit(None).cast("int").alias("reading_order"))
    docs = spark.createDataFrame([("d", None, 3, None, "2")], "doc_id string, title string, total_pages int, created_at string, parser_version string")
    assert [r.markdown for r in render.writer_markdown(blocks, docs).collect()] == ["a\n\nb\n\n\n---\n<!-- Page 2 -->\n\n\n---\n<!-- Page 3 -->\n\nc\n"]
