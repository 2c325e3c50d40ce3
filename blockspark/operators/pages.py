"""Page boundaries in markdown, and sentences merged across them.

A model's answer for each boundary is an input table. Texts around a boundary are cut
at the pages' ends, so that two boundaries close together never share one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockspark.functions import text as T

MARK = r"\n-{3}\n<!-{2} Page \d+ -{2}>\n"
SENTINEL = "NO_MERGE_REQUIRED"


def pages(docs: DataFrame) -> DataFrame:
    """(doc_id, k, text, mark): the text of each page and the mark behind it, null for the last."""
    rows = docs.select("doc_id", F.posexplode(F.split("markdown", MARK)).alias("k", "text"), F.regexp_extract_all("markdown", F.lit(MARK), F.lit(0)).alias("m"))
    return rows.select("doc_id", "k", "text", F.get("m", F.col("k")).alias("mark"))


def boundaries(docs: DataFrame, context: int = 500) -> DataFrame:
    """(doc_id, boundary, start, stop, tail, head): places of each mark and the stripped text around it."""
    order = Window.partitionBy("doc_id").orderBy("k")
    rows = pages(docs).withColumn("after", F.lead("text").over(order))
    length = F.length("text") + F.coalesce(F.length("mark"), F.lit(0))
    rows = rows.withColumn("stop", F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0))).filter("mark IS NOT NULL")
    return rows.select(
        "doc_id", F.col("k").alias("boundary"), (F.col("stop") - F.length("mark")).cast("int").alias("start"), F.col("stop").cast("int").alias("stop"),
        T.strip(F.right("text", F.lit(context))).alias("tail"), T.strip(F.left("after", F.lit(context))).alias("head"),
    )


def decided(output) -> F.Column:
    """The merged text of an answer, or null if it says not to merge or says nothing."""
    said = T.strip(output)
    return F.when(~said.contains(SENTINEL) & (said != ""), said)


def merge(docs: DataFrame, decisions: DataFrame, context: int = 500) -> DataFrame:
    """(doc_id, markdown) with the answers of (doc_id, boundary, output) in place of marks.

    The tail before and the head after a merged mark go with it. Where the next page
    begins with nothing but white space, its first ``context`` characters go.
    """
    order = Window.partitionBy("doc_id").orderBy("k")
    rows = pages(docs).join(decisions.select("doc_id", F.col("boundary").alias("k"), decided(F.col("output")).alias("merged")), ["doc_id", "k"], "left")
    rows = rows.withColumn("merged", F.when(F.col("mark").isNotNull(), F.col("merged"))).withColumn("above", F.lag("merged").over(order))
    start = F.left("text", F.lit(context))
    lead = F.length(start) - F.length(F.regexp_replace(start, rf"(?U)^{T.SPACE}+", ""))
    head = F.when(F.col("above").isNull(), 0).when(T.blank(start), F.length(start)).otherwise(lead + F.length(T.strip(start)))
    stop = F.right("text", F.lit(context))
    bare = T.strip(stop)
    trail = F.length(stop) - F.length(F.regexp_replace(stop, rf"(?U){T.SPACE}+$", ""))
    cut = F.when(F.col("merged").isNull() | (bare == ""), F.length("text")).otherwise(F.length("text") - trail - F.length(bare))
    body = F.substring(F.col("text"), head + 1, F.greatest(cut - head, F.lit(0)))
    part = F.concat(body, F.coalesce(F.concat(F.lit("\n\n"), "merged", F.lit("\n\n")), "mark", F.lit("")))
    return rows.withColumn("p", part).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "p"))), lambda r: r["p"]), "").alias("markdown"))
