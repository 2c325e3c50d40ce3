"""Recognised text lines: parsing, reading order over columns, confidence, page coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockspark.functions import geometry as G
from blockspark.functions import text as T



def dict_lines(results: DataFrame) -> DataFrame:
    """(region keys, line_no, text, confidence, box) of parallel arrays rec_texts, rec_scores, boxes.

    As many lines as both texts and boxes reach; without boxes, all texts. A missing
    score is 0, a missing box four zero points.
    """
    keys = [c for c in results.columns if c not in ("rec_texts", "rec_scores", "boxes")]
    rows = results.withColumn("boxes", F.coalesce("boxes", F.array().cast("array<array<array<double>>>")))
    n = F.when(F.size("boxes") > 0, F.least(F.size("rec_texts"), F.size("boxes"))).otherwise(F.size("rec_texts"))
    zero = F.array_repeat(F.array(F.lit(0.0), F.lit(0.0)), 4)
    rows = rows.withColumn("line_no", F.explode(F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: i < n)))
    return rows.select(*keys, "line_no", F.get("rec_texts", F.col("line_no")).alias("text"), F.coalesce(F.get("rec_scores", F.col("line_no")), F.lit(0.0)).alias("confidence"), F.coalesce(F.get("boxes", F.col("line_no")), zero).alias("box"))


def list_lines(results: DataFrame) -> DataFrame:
    """The same of an array ``lines`` of (box, text, confidence); a missing confidence is 0."""
    keys = [c for c in results.columns if c != "lines"]
    rows = results.select(*keys, F.posexplode("lines").alias("line_no", "l"))
    return rows.select(*keys, "line_no", F.col("l.text").alias("text"), F.coalesce("l.confidence", F.lit(0.0)).alias("confidence"), F.col("l.box").alias("box"))


def halvings(rows: DataFrame, x: str, width: str) -> int:
    """Halvings of the width until only lines at the very edge are left of it: no group splits after that."""
    n = rows.filter((F.col(x) > 0) & (F.col(width) > F.col(x))).agg(F.max(F.ceil(F.log2(F.col(width) / F.col(x))))).first()[0]
    return max(1, int(n or 1))


def reading_order(lines: DataFrame, keys: list[str], width: str = "width") -> DataFrame:
    """``lines`` (with points in ``box`` and a line_no) numbered in ``nth`` by columns, bands of ten, and x.

    A group of more than ten lines splits at half its width if both halves have lines
    and overlap by over 0.3 of their height; only the left half can split again, as the
    right one's places stay those of the page. How often is measured from the lines first.
    """
    rows = lines.withColumn("__x", G.centre("box", 0)).withColumn("__y", G.centre("box", 1))
    rows = rows.withColumn("__lo", F.array_min(F.transform("box", lambda p: F.get(p, F.lit(1))))).withColumn("__hi", F.array_max(F.transform("box", lambda p: F.get(p, F.lit(1)))))
    group = Window.partitionBy(*keys)
    levels = halvings(rows.select("__x", F.col(width).cast("double").alias("__w")), "__x", "__w")
    rows = rows.withColumn("__right", F.lit(None).cast("int")).withColumn("__open", F.lit(True)).withColumn("__w", F.col(width).cast("double"))
    for level in range(levels):
        here = F.col("__right").isNull() & F.col("__open")
        mid = F.col("__w") / (2.0 ** (level + 1))
        left, right = here & (F.col("__x") < mid), here & (F.col("__x") >= mid)
        stat = lambda f, mask, c: f(F.when(mask, F.col(c))).over(group)
        low_l, high_l, low_r, high_r = stat(F.min, left, "__lo"), stat(F.max, left, "__hi"), stat(F.min, right, "__lo"), stat(F.max, right, "__hi")
        total = F.greatest(high_l, high_r) - F.least(low_l, low_r)
        overlap = F.greatest(F.lit(0.0), F.least(high_l, high_r) - F.greatest(low_l, low_r))
        split = (F.count_if(here).over(group) > 10) & (F.count_if(left).over(group) > 0) & (F.count_if(right).over(group) > 0) & (total > 0) & (F.try_divide(overlap, total) > 0.3)
        rows = rows.withColumn("__split", F.coalesce(split, F.lit(False)))
        rows = rows.withColumn("__right", F.when(F.col("__split") & right, F.lit(level)).otherwise(F.col("__right"))).withColumn("__open", F.col("__open") & F.col("__split"))
    order = Window.partitionBy(*keys).orderBy(F.coalesce("__right", F.lit(levels)).desc(), (F.col("__y") / 10).cast("long"), "__x", "line_no")
    return rows.withColumn("nth", F.row_number().over(order) - 1).drop("__x", "__y", "__lo", "__hi", "__right", "__open", "__w", "__split")


def regions(lines: DataFrame, keys: list[str], order: str = "nth") -> DataFrame:
    """(keys, text, confidence): a region's lines joined by spaces, and their mean confidence."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce("text", F.lit("")).alias("t")))), lambda r: r["t"])
    return lines.groupBy(*keys).agg(T.strip(F.array_join(texts, " ")).alias("text"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("confidence"))


def aligned(blocks: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks with the text and confidence of their region; '' and 0 where there is none."""
    held = found.select(*keys, F.col("text").alias("__text"), F.col("confidence").alias("__confidence"))
    out = blocks.join(held, keys, "left")
    return out.withColumn("text", F.coalesce("__text", F.lit(""))).withColumn("confidence", F.coalesce("__confidence", F.lit(0.0))).drop("__text", "__confidence")


def to_page(lines: DataFrame, dx: Column | str, dy: Column | str) -> DataFrame:
    """Lines with a box moved by the crop's corner and marked as the page's; empty boxes stay as they are."""
    has = F.size(F.coalesce("box", F.array().cast("array<array<double>>"))) > 0
    return lines.withColumn("box_page_absolute", has).withColumn("box", F.when(has, G.shifted("box", dx, dy)).otherwise(F.col("box")))
