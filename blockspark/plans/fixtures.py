"""Inputs of the registered queries, derived from whole tables; each has an SQL twin in ``sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockspark.functions import text as T
from blockspark.operators import chunk, parse


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.lines_as_blocks(documents(spark, sf_dir))


def conversations_as_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, markdown): a heading for each turn, then its text, a table or a figure and formula by turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turn = F.col("turn").cast("string")
    extra = F.when(F.col("turn") % 3 == 1, F.concat(F.lit("| a | b |\n|---|---|\n| "), turn, F.lit(" | x |\n"))).when(F.col("turn") % 3 == 2, F.concat(F.lit("![fig "), turn, F.lit("](img/"), turn, F.lit(".png)\n$$x_"), turn, F.lit("$$\n"))).otherwise("")
    part = F.concat(F.lit("## "), "role", F.lit(" "), turn, F.lit("\n"), "text", F.lit("\n"), extra, F.when(F.col("turn") % 2 == 0, "\n").otherwise(""))
    return turns.groupBy(F.col("conv_id").cast("string").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", part.alias("p")))), lambda r: r["p"]), "").alias("markdown"))


def conversations_as_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, markdown): a page for each turn, with marks between."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    pages = turns.groupBy(F.col("conv_id").cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    part = F.transform("t", lambda r, i: F.concat(F.when(i > 0, F.concat(F.lit("\n---\n<!-- Page "), (i + 1).cast("string"), F.lit(" -->\n"))).otherwise(""), r["text"]))
    return pages.select("doc_id", F.array_join(part, "").alias("markdown"))


ELEMENT_CYCLE = ("title", "author", "affiliation", "abstract", "section", "subsection", "paragraph", "table", "figure", "sidebar")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, response): a model's answer for each document, a line being an element."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.get(F.array(*[F.lit(t) for t in ELEMENT_CYCLE]), i % 10).alias("type"), line.alias("content"), F.lit(0).alias("level"),
            F.when(i % 10 == 4, F.create_map(F.lit("section_number"), i.cast("string"))).when(i % 10 == 8, F.create_map(F.lit("figure_number"), i.cast("string"))).alias("metadata"),
        ),
    )
    docs = documents(spark, sf_dir)
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.concat(F.lit("Here it is:\n"), F.to_json(F.struct(lines.alias("page_elements"))), F.lit("\nDone.")).alias("response"))


def model_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.enriched(parse.element_blocks(responses(spark, sf_dir)))


def paged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same blocks on pages of twenty, their order starting again on each."""
    rows = model_blocks(spark, sf_dir)
    return rows.withColumn("page", (F.floor(F.col("pos") / 20) + 1).cast("int")).withColumn("reading_order", (F.col("pos") % 20).cast("int"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations of all document texts and page URLs in the order of their ids."""
    texts = documents(spark, sf_dir).select(F.lit("texts").alias("kind"), T.text_hash("text").alias("hash"), F.col("source").alias("path"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("date"), F.col("doc_id").alias("seq"))
    urls = table(spark, sf_dir, "pages").select(F.lit("urls").alias("kind"), T.url_hash("url").alias("hash"), F.col("url").alias("path"), F.lpad(F.col("page_id").cast("string"), 12, "0").alias("date"), F.col("page_id").cast("long").alias("seq"))
    return texts.unionByName(urls)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines with boxes on a page 600 wide for each supplier, from all line items."""
    item = table(spark, sf_dir, "lineitem")
    x, y = (F.col("l_partkey") % 600).cast("double"), (F.col("l_orderkey") % 800).cast("double")
    box = F.array(F.array(x, y), F.array(x + 10, y), F.array(x + 10, y + 8), F.array(x, y + 8))
    return item.select(F.col("l_suppkey").alias("region"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no"), F.col("l_returnflag").alias("text"), F.col("l_discount").alias("confidence"), box.alias("box"), F.lit(600.0).alias("width"))


#: A source file for the scan; ~ stands for a line feed.
CODE = "import os~x = eval(s)~os.system(cmd)~run(a, shell = True)~password = 'abc'~API_KEY=\"k\"~q = f'SELECT {x}'~exec (s); eval(t)~pickle.load(f)~yaml.load(f)~q = 'SELECT a FROM t WHERE x = %s' % y~q = '{}'.format(t) + 'SELECT'~print(1)"


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = spark.createDataFrame([("app.py", CODE.replace("~", "\n"))], "path string, content string")
    return documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content")).unionByName(one)
