"""Source code: security findings by line, metrics and structure of Python files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.functions import text as T
from blockspark.session import ship

#: Pattern, message, severity. Case doesn't count.
RULES = (
    (r"eval\s*\(", "eval() runs any text as code", "critical"),
    (r"exec\s*\(", "exec() runs any text as code", "critical"),
    (r"os\.system\s*\(", "os.system() goes through a shell", "warning"),
    (r"shell\s*=\s*True", "subprocess goes through a shell", "warning"),
    (r"password\s*=\s*[\"'][^\"']+[\"']", "password in the source", "critical"),
    (r"api_key\s*=\s*[\"'][^\"']+[\"']", "API key in the source", "critical"),
    (r"SELECT\s.*\sFROM\s.*%", "SQL put together by %", "critical"),
    (r"f[\"'].*SELECT.*\{", "SQL put together by an f-string", "critical"),
    (r"\.format\(.*\).*SELECT", "SQL put together by format()", "critical"),
    (r"pickle\.loads?\s*\(", "pickle runs code from its input", "warning"),
    (r"yaml[.]load\s*[(][^,]+[)]", "yaml.load() without a safe loader", "warning"),
)


def findings(files: DataFrame) -> DataFrame:
    """(path, line, message, severity, code): a row for each rule that a line breaks; null contents break none.

    The eleven rules are an array literal, so each line is tested where it is read.
    """
    lines = files.select("path", F.posexplode(F.split("content", "\n")).alias("i", "code"))
    hits = [F.when(F.col("code").rlike(f"(?i){pattern}"), F.struct(F.lit(message).alias("message"), F.lit(severity).alias("severity"))) for pattern, message, severity in RULES]
    found = lines.select("path", (F.col("i") + 1).alias("line"), T.strip("code").alias("code"), F.explode(F.array_compact(F.array(*hits))).alias("f"))
    return found.select("path", "line", "f.message", "f.severity", "code")


#: What Python's parser raises on text that is no program, however long or deeply nested.
UNPARSED = (SyntaxError, ValueError, MemoryError, RecursionError)
METRICS = "path string, lines long, functions long, classes long, imports long, long_functions array<string>, syntax_error boolean"


def metrics(files: DataFrame, longest: int = 50) -> DataFrame:
    """(path, lines, functions, classes, imports, long_functions, syntax_error); needs Python's own parser, so Arrow batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ast

        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"].fillna(""), strict=True):
                functions = classes = imports = 0
                long: list[str] = []
                wrong = False
                try:
                    for node in ast.walk(ast.parse(content)):
                        if isinstance(node, ast.FunctionDef | ast.AsyncFunctionDef):
                            functions += 1
                            if (node.end_lineno or node.lineno) - node.lineno > longest:
                                long.append(node.name)
                        classes += isinstance(node, ast.ClassDef)
                        imports += isinstance(node, ast.Import | ast.ImportFrom)
                except UNPARSED:
                    functions = classes = imports = 0
                    wrong = True
                rows.append((path, content.count("\n") + 1, functions, classes, imports, long, wrong))
            yield pd.DataFrame(rows, columns=["path", "lines", "functions", "classes", "imports", "long_functions", "syntax_error"])

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, METRICS)


def structure(files: DataFrame) -> DataFrame:
    """(path, imports, classes, functions, docstring): public functions and constructors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ast

        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"].fillna(""), strict=True):
                imports: list[str] = []
                classes: list[str] = []
                functions: list[str] = []
                said = None
                try:
                    module = ast.parse(content)
                    said = ast.get_docstring(module) or None
                    every = list(ast.walk(module))
                    imports = [name for n in every for name in ([a.name for a in n.names] if isinstance(n, ast.Import) else [str(n.module)] if isinstance(n, ast.ImportFrom) else [])]
                    classes = [n.name for n in every if isinstance(n, ast.ClassDef)]
                    functions = [n.name for n in every if isinstance(n, ast.FunctionDef) and (n.name == "__init__" or n.name[:1] != "_")]
                except UNPARSED:
                    pass
                rows.append((path, imports, classes, functions, said))
            yield pd.DataFrame(rows, columns=["path", "imports", "classes", "functions", "docstring"])

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "path string, imports array<string>, classes array<string>, functions array<string>, docstring string")


def review(files: DataFrame) -> DataFrame:
    """(path, report): findings and metrics as markdown."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("line", "severity", "message"))), lambda r: F.concat(F.lit("- line "), r["line"].cast("string"), F.lit(" ["), r["severity"], F.lit("] "), r["message"]))
    found = findings(files).groupBy("path").agg(F.array_join(lines, "\n").alias("found"))
    rows = metrics(files).join(found, "path", "left")
    head = F.concat(F.lit("# Review: "), F.col("path"), F.lit("\n\n- lines: "), F.col("lines").cast("string"), F.lit("\n- functions: "), F.col("functions").cast("string"), F.lit("\n- classes: "), F.col("classes").cast("string"), F.lit("\n- imports: "), F.col("imports").cast("string"))
    return rows.select("path", F.concat(head, F.when(F.col("syntax_error"), "\n- doesn't parse").otherwise(""), F.lit("\n\n## Security\n\n"), F.coalesce("found", F.lit("none"))).alias("report"))
