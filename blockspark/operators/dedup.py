"""Exact duplicates by hash, and the registry of what was seen.

The registry is append-only: (kind, hash, path, date, preview, seq). Its state is the
latest or the first row of each key, found by a partial aggregate, so a hash that a
third of all rows share meets no task as a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.functions import text as T

KINDS = ("pdfs", "images", "urls", "texts")
IMAGES = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".bmp")


def kind_of(path: Column | str) -> Column:
    """pdfs, images or null, by the extension."""
    extension = F.lower(F.regexp_extract(T.col(path), r"[^/.](\.[^./]*)$", 1))
    return F.when(extension == ".pdf", "pdfs").when(extension.isin(*IMAGES), "images")


def registered(events: DataFrame, keep: str = "last") -> DataFrame:
    """One row per (kind, hash): the last registration, or the first with ``keep="first"``."""
    rest = [c for c in events.columns if c not in ("kind", "hash")]
    pick = F.max_by if keep == "last" else F.min_by
    return events.groupBy("kind", "hash").agg(pick(F.struct(*rest), F.col("seq")).alias("r")).select("kind", "hash", "r.*")


def fresh(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates whose (kind, hash) isn't registered."""
    return candidates.join(registry.select("kind", "hash").distinct(), ["kind", "hash"], "left_anti")


def duplicates(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates that are registered, with the original's path and date."""
    known = registered(registry).select("kind", "hash", F.col("path").alias("original_path"), F.col("date").alias("original_date"))
    return candidates.join(known, ["kind", "hash"])


def first_wins(rows: DataFrame) -> DataFrame:
    """One row per hash, the earliest, with how many share it."""
    return rows.groupBy("hash").agg(F.min("seq").alias("seq"), F.count("*").alias("copies"))


def stats(events: DataFrame) -> DataFrame:
    """(kind, total) of distinct registered hashes, a row for each kind."""
    spark = events.sparkSession
    kinds = spark.createDataFrame([(k,) for k in KINDS], "kind string")
    counts = events.groupBy("kind").agg(F.count_distinct("hash").alias("n"))
    return kinds.join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).cast("long").alias("total"))


def listing(events: DataFrame, kind: str | None = None) -> DataFrame:
    """Registered entries: of one kind, or all with the newest first."""
    state = registered(events)
    return state.filter(F.col("kind") == kind) if kind in KINDS else state.orderBy(F.desc("date"), "kind", "hash")


def shown(events: DataFrame, kind: str | None = None, most: int = 50) -> DataFrame:
    """What a viewer lists: the newest entries, ``most`` of them."""
    return listing(events, kind).orderBy(F.desc("date"), "kind", "hash").limit(most)


def without(events: DataFrame, removed: DataFrame) -> DataFrame:
    """The registry after removals of (kind, hash)."""
    return events.join(removed.select("kind", "hash").distinct(), ["kind", "hash"], "left_anti")
