"""Markdown as paragraphs, and the assembly of translations. Translations are an input table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockspark.functions import markdown as M
from blockspark.functions import text as T

PREFIXES = ("#", "![", "<!--", "*AI ", "|", "```", ">")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, part, special, content, para_idx): special lines by themselves, other neighbours together.

    para_idx counts the parts to translate, null for others.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("markdown", "\n")).alias("i", "line"))
    special = T.blank("line")
    for prefix in PREFIXES:
        special = special | F.startswith("line", F.lit(prefix))
    order = Window.partitionBy("doc_id").orderBy("i")
    lines = lines.withColumn("special", special)
    opens = F.col("special") | F.coalesce(F.lag("special").over(order), F.lit(True))
    lines = lines.withColumn("part", F.count_if(opens).over(order))
    rows = lines.groupBy("doc_id", "part").agg(F.bool_or("special").alias("special"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda r: r["line"]), "\n").alias("content"))
    wanted = ~F.col("special") & ~T.blank("content")
    order = Window.partitionBy("doc_id").orderBy("part")
    return rows.withColumn("para_idx", F.when(wanted, F.count_if(wanted).over(order) - 1)).withColumn("part", F.col("part") - 1)


def _joined(rows: DataFrame, part: F.Column) -> DataFrame:
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col("part").alias("k"), part.alias("p")))), lambda r: r["p"])
    return rows.groupBy("doc_id").agg(F.array_join(parts, "\n").alias("markdown"))


def bilingual(parts: DataFrame, translations: DataFrame) -> DataFrame:
    """(doc_id, markdown): each paragraph with its translation quoted below, or a notice that there is none."""
    rows = parts.join(translations, ["doc_id", "para_idx"], "left")
    said = F.when(T.first_full("translation") != "", M.plus("> *", F.col("translation"), "*")).otherwise("> *(translation unavailable)*")
    return _joined(rows, F.when(F.col("para_idx").isNotNull(), M.plus(F.col("content"), "\n\n", said, "\n")).otherwise(F.col("content")))


def monolingual(parts: DataFrame, translations: DataFrame) -> DataFrame:
    """(doc_id, markdown): paragraphs translated, those without a translation as they were."""
    rows = parts.join(translations, ["doc_id", "para_idx"], "left")
    return _joined(rows, F.when(F.col("para_idx").isNotNull(), T.first_full("translation", "content")).otherwise(F.col("content")))


def prompt(text: F.Column | str, source: str, target: str) -> F.Column:
    """The request for one paragraph."""
    names = {"ko": "Korean", "en": "English"}
    return M.plus(f"Translate from {names.get(source, source)} to {names.get(target, target)}. Give the translation only, with the same formatting and lines.\n\nText:\n", T.col(text), "\n\nTranslation:")


def passes_through(source: str, target: str, batch: bool = False) -> bool:
    """Whether text needs no call: single calls skip equal languages, batches don't."""
    return source == target and not batch


def pairs(parts: DataFrame, translations: DataFrame) -> DataFrame:
    """(doc_id, part, original, translation) of the text parts; '' where there is none."""
    rows = parts.filter(~F.col("special")).join(translations, ["doc_id", "para_idx"], "left")
    return rows.select("doc_id", "part", F.col("content").alias("original"), T.first_full("translation").alias("translation"))
