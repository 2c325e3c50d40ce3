"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``; its result
is written as Parquet to the folder all executors share and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

Null and empty texts are documents like any other: the classifier scores them, and those
it keeps have fingerprint zero and are near duplicates of each other. Texts of any length
are taken whole. Rows without an id stay, as no group of near duplicates can be named by
them; repeated rows of one id and text become one row, unlike texts of one id are told
apart, ties going to the least hash of the text. Columns beyond those of ``documents``
pass through all stages but the last, whatever their names. An empty table gives an empty
result. What a stage wrote is removed as soon as the next one has written its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blockspark.llm import decontamination, pieces, quality_classifier, secrets, simhash
from blockspark.llm.common import table
from blockspark.session import discard, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark."""
    return secrets.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentation's ids of each document, those of all N hashed, and whether decoding gives the text."""
    return pieces.encoded(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", encoded),
]

#: SQL can express neither boosted trees nor the lattice search; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; all but the last are written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                discard(spark, f"{folder}/{k - 1}")
    return docs
