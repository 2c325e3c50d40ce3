"""New files as a stream: ids, exact duplicates dropped, chunks per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockspark.functions import text as T


def text_stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """(path, doc_id, content, seen) of whole text files as they come."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", per_trigger).load(path)
    return files.select("path", T.doc_id("content").alias("doc_id"), F.decode("content", "UTF-8").alias("content"), F.col("modificationTime").alias("seen"))


def without_copies(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """The first file of each id; state of ids older than the watermark goes."""
    return stream.withWatermark("seen", late).dropDuplicatesWithinWatermark(["doc_id"])


def counts(stream: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(start, files, characters) of each window."""
    out = stream.withWatermark("seen", late).groupBy(F.window("seen", window)).agg(F.count("*").alias("files"), F.sum(F.length("content")).alias("characters"))
    return out.select(F.col("window.start").alias("start"), "files", "characters")
