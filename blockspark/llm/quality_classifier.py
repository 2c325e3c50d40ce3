"""Quality classifier: boosted trees over document statistics.

The model learns from labelled documents that are not held out, at most about
SAMPLE of them, drawn by a hash of their id; that bound is a parameter. Every document
is then scored from its whole text by the flat forest.

Null texts count as empty and get a score too, as do texts without words; texts of any
length are taken whole. Ids may be null (never learnt from) or repeated (each row is
scored; the row with the least text is learnt from) and of any type. Labels that are null
are ignored; of several labels of an id the greatest counts. Without any label the score
is one half. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm import statistics, trees
from blockspark.llm.common import held_out, map_batches

#: Labelled documents the model learns from, about; a documented bound.
SAMPLE = 20_000
#: At this score and above a document is kept.
KEEP = 0.3


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, y) of labelled rows outside the held-out fifth, about ``size`` at most."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, size / max(1, known.count()))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    # about ``size`` ids and small numbers: a bounded broadcast; of rows that share an id one is learnt from
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known.filter(drawn)), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", size: int = SAMPLE) -> trees.Forest:
    """The forest, trained on the driver from a bounded sample's statistics."""

    def run(batch: pa.RecordBatch) -> list:
        return [batch.column(2), [statistics.features(t) for t in batch.column(1).to_pylist()], batch.column(0).cast(pa.string())]

    rows = map_batches(labelled_sample(docs, labels, label, size), run, "y int, x array<double>, doc_id string", text=1).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(statistics.FEATURES))
    return trees.train(x, rows["y"].to_numpy(dtype=float))


def score(docs: DataFrame, forest: trees.Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""

    def run(batch: pa.RecordBatch) -> list:
        x = np.array([statistics.features(t) for t in batch.column(1).to_pylist()], dtype=float).reshape(batch.num_rows, len(statistics.FEATURES))
        return [batch.column(0), pa.array(forest.score(x))]

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return map_batches(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, score double", text=1)


def digest(scored: DataFrame, at: float = KEEP) -> DataFrame:
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, forest: trees.Forest, text_col: str = "text", at: float = KEEP) -> DataFrame:
    """``docs`` without the rows whose score is below ``at``; all columns stay."""

    def run(batch: pa.RecordBatch) -> list:
        texts = batch.column(column).to_pylist()
        x = np.array([statistics.features(t) for t in texts], dtype=float).reshape(len(texts), len(statistics.FEATURES))
        return list(batch.filter(pa.array(forest.score(x) >= at)).columns)

    column = docs.columns.index(text_col)
    return map_batches(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), text=column)
