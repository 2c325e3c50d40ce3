"""Result caches and the reading queue as append-only logs with a latest view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.functions import json_text as J


def latest(events: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of each key; a partial aggregate, so hot keys meet no task as a group."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def cache_key(image: Column | str, prompt: Column | str | None = None) -> Column:
    image = F.col(image) if isinstance(image, str) else image
    if prompt is None:
        return image
    prompt = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.concat(image, F.coalesce(F.concat(F.lit("_"), F.nullif(prompt, F.lit(""))), F.lit("")))


def probe(wanted: DataFrame, cached: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """``wanted`` with the cached row of its key, nulls where there is none, and ``hit``."""
    state = latest(cached, keys, order).withColumn("hit", F.lit(True))
    return wanted.join(state, keys, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def hits(writes: DataFrame, reads: DataFrame, keys: list[str], at: str = "created_at") -> DataFrame:
    """(keys, hit_count): reads of each key since its last write; a write resets the count."""
    last = writes.groupBy(*keys).agg(F.max(at).alias("__written"))
    counted = reads.groupBy(*keys, at).agg(F.count("*").alias("n"))
    return last.join(counted, keys, "left").groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col(at) >= F.col("__written"), F.col("n"))), F.lit(0)).alias("hit_count"))


def stats(entries: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """(entries, hits) of one kind of cache."""
    n = entries.agg(F.count("*").alias("entries"))
    total = counted.agg(F.coalesce(F.sum("hit_count"), F.lit(0)).cast("long").alias("hits")) if counted is not None else entries.sparkSession.createDataFrame([(0,)], "hits long")
    return n.join(F.broadcast(total))


#: The caches that can be cleared one at a time.
CACHES = ("ocr", "vlm", "layout", "docs")


def cleared(events: DataFrame, kind: str | None = None) -> DataFrame:
    """The log of all caches (with a column ``cache``) after one kind, or all, was cleared; a kind that is none clears nothing."""
    return events.filter(F.lit(False)) if kind is None else events.filter(~F.coalesce(F.col("cache") == kind, F.lit(False)) | ~F.lit(kind in CACHES))


def compacted(events: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The log with its superseded rows gone, as a store that reclaims space leaves it: write it in place of the log."""
    return latest(events, keys, order).select(events.columns)


def structured(captions: DataFrame) -> DataFrame:
    """Cached captions with their JSON parsed, null where it doesn't parse."""
    return captions.withColumn("structured", F.try_parse_json(J.loose_json("structured_json")))


def queue(events: DataFrame, status: str | None = None) -> DataFrame:
    """The reading queue: each id's last event, removed ids left out; by status if one is named.

    Later events keep what they leave null.
    """
    rest = [c for c in events.columns if c not in ("id", "seq", "status", "ts")]
    kept = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in rest]
    state = events.groupBy("id").agg(*kept, F.max_by("status", "seq").alias("status"), F.min("ts").alias("added"), F.max("ts").alias("updated")).filter("status <> 'removed'")
    return state.filter(F.col("status") == status) if status else state


def next_id(events: DataFrame) -> DataFrame:
    """One row with the id a new entry gets: ids are never used again."""
    return events.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id"))
