"""Files as tables: PDFs, texts, code, tabular files, listings. A file that can't be read is a row with a status."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockspark.functions import text as T

CODE = (".py", ".js", ".ts")
SKIPPED = r"(^|/)(\.[^/]*|node_modules|__pycache__|venv|env)/"


def _name(path="path"):
    return F.element_at(F.split(path, "/"), -1)


def pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, source_path, filename, content) of a PDF or of those directly in a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
    files = reader.load(path) if path.lower().endswith(".pdf") else reader.option("pathGlobFilter", "*.[pP][dD][fF]").load(path)
    return files.select(T.doc_id("content").alias("doc_id"), F.col("path").alias("source_path"), _name().alias("filename"), "content")


def texts(spark: SparkSession, path: str, extensions: tuple[str, ...] = (".md", ".txt"), recursive: bool = True) -> DataFrame:
    """(path, content): whole UTF-8 files with one of the extensions."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    wanted = F.lit(False)
    for e in extensions:
        wanted = wanted | F.endswith(F.lower("path"), F.lit(e))
    return files.filter(wanted).select("path", F.decode("content", "UTF-8").alias("content"))


def code(spark: SparkSession, path: str, recursive: bool = True, extensions: tuple[str, ...] = CODE) -> DataFrame:
    """Source files below ``path``, without hidden, dependency and environment folders."""
    root = path.removeprefix("file://").rstrip("/")
    below = F.substring_index(F.col("path"), root + "/", -1)
    return texts(spark, path, extensions, recursive).filter(~below.rlike(SKIPPED))


def one_text(spark: SparkSession, content: str, path: str = "stdin") -> DataFrame:
    return spark.createDataFrame([(path, content)], "path string, content string")


def tabular(spark: SparkSession, path: str) -> DataFrame | None:
    """A csv, json or parquet file by its extension; None for others (there is no reader for spreadsheets here)."""
    kind = PurePosixPath(path).suffix.lower()
    if kind == ".csv":
        return spark.read.csv(path, header=True, inferSchema=True)
    if kind == ".json":
        return spark.read.json(path, multiLine=True)
    return spark.read.parquet(path) if kind == ".parquet" else None


def questions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("question string, answer string, options array<string>").json(path, multiLine=True)


def readable(files: DataFrame, column: str = "content") -> DataFrame:
    """Files with a status: ``ok``, ``empty`` where nothing was read, ``unreadable`` where a PDF's head is missing.

    One bad file never ends a run: it is a row that later steps leave out.
    """
    head = F.substring(F.col(column), 1, 1024)
    pdf = F.hex(head).contains("255044462D")  # %PDF-
    n = F.coalesce(F.length(column), F.lit(0))
    return files.withColumn("status", F.when(n == 0, "empty").when(F.endswith(F.lower("filename"), F.lit(".pdf")) & ~F.coalesce(pdf, F.lit(False)), "unreadable").otherwise("ok"))


def json_registry(spark: SparkSession, path: str) -> DataFrame:
    """(kind, hash, path, date, preview): a registry kept as one JSON object of kinds, hashes and entries; empty where it is missing or no JSON."""
    from pyspark.errors import AnalysisException

    schema = "kind string, hash string, path string, date string, preview string"
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    kinds = F.from_json("value", "map<string,map<string,struct<path:string,url:string,date:string,preview:string>>>", {"mode": "PERMISSIVE"})
    entries = text.select(F.explode(kinds).alias("kind", "held")).select("kind", F.explode("held").alias("hash", "e"))
    return entries.select("kind", "hash", F.coalesce("e.path", "e.url").alias("path"), "e.date", "e.preview")


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A registry or queue; empty where there is none yet or it is no table."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def listing(spark: SparkSession, path: str, extensions: tuple[str, ...] = (".md", ".png", ".jpg", ".jpeg")) -> DataFrame:
    """(path, filename, length) of a result folder, by name; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    wanted = F.lit(False)
    for e in extensions:
        wanted = wanted | F.endswith(F.lower("path"), F.lit(e))
    return files.filter(wanted).select("path", _name().alias("filename"), "length").orderBy("filename", "path")


def images_large_enough(images: DataFrame, least: float = 50.0) -> DataFrame:
    """Embedded images with no side shorter than ``least``."""
    return images.filter((F.col("width") >= least) & (F.col("height") >= least))


def objects(rows: DataFrame, column: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows from JSON texts; a text that doesn't parse gives nulls, unknown keys are left out, or end the job if ``strict``."""
    if strict:
        known = [f.name for f in rows.sparkSession.createDataFrame([], schema).schema]
        extra = F.array_except(F.coalesce(F.json_object_keys(column), F.array().cast("array<string>")), F.array(*[F.lit(k) for k in known]))
        rows = rows.withColumn(column, F.when(F.size(extra) > 0, F.raise_error(F.concat(F.lit("unknown keys: "), F.array_join(extra, ", ")))).otherwise(F.col(column)))
    return rows.select(F.from_json(column, schema).alias("o")).select("o.*")
