"""Exploratory statistics in long form: one scan for all numeric columns, one per categorical.

Exact quartiles are found without gathering or sorting values: a double's bits, made to
sort like it, are narrowed down sixteen at a time by counting, so four scans find any
rank, and what a task holds and sends is bounded by the bins. Correlations take two
scans: the least values, which the second takes off so that sums stay small, and sums of
products of whole Arrow batches, a row per pair of columns leaving each task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from blockspark.session import ship

QUARTILES = (0.25, 0.5, 0.75)
#: Bits that a pass of the rank search settles.
RADIX = 16


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def categorical_columns(df: DataFrame, most: int = 5) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)][:most]


def value(df: DataFrame, c: str) -> Column:
    """The column as a double, NaN being missing."""
    d = F.col(c).cast("double")
    return F.when(~F.isnan(d), d)


def _long(df: DataFrame, rows: list[tuple[str, dict[str, Column]]], names: tuple[str, ...]) -> DataFrame:
    """One aggregate of all cells, unpivoted into (column, names...)."""
    cells = [v.alias(f"{i}_{n}") for i, (_, cell) in enumerate(rows) for n, v in cell.items()]
    one = df.agg(*cells)
    structs = [F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{n}").alias(n) for n in names]) for i, (c, _) in enumerate(rows)]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def missing(df: DataFrame) -> DataFrame:
    """(column, dtype, rows, missing, missing_pct); null and NaN are missing."""
    rows = []
    for f in df.schema:
        gone = F.col(f.name).isNull()
        if isinstance(f.dataType, NumericType):
            gone = gone | F.isnan(F.col(f.name).cast("double"))
        n = F.count("*")
        rows.append((f.name, {"dtype": F.lit(f.dataType.simpleString()), "rows": n, "missing": F.count_if(gone), "missing_pct": F.round(F.try_divide(F.count_if(gone) * 100.0, n), 2)}))
    return _long(df, rows, ("dtype", "rows", "missing", "missing_pct"))


def _bits(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles."""
    raw = (x + 0.0).view(np.uint64)
    return np.where(raw >> np.uint64(63) == 1, ~raw, raw | np.uint64(1 << 63))


def _double(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else ~bits & (1 << 64) - 1
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def order_statistics(df: DataFrame, columns: list[str], ranks: list[list[int]]) -> list[dict[int, float]]:
    """The values at ranks (from 0, missing values left out) of each column, exactly.

    Each pass counts the values below every prefix still open by their next bits; at most
    2 ** RADIX counts of each prefix are put in order, and two numbers of each rank reach
    the driver.
    """
    ship(df.sparkSession)
    picked = df.select(*[value(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    known = {(i, r): (0, r) for i, rs in enumerate(ranks) for r in rs}  # (prefix, rank below it)
    for done in range(0, 64, RADIX):
        shift = np.uint64(64 - done - RADIX)
        open_ = sorted({(i, prefix) for (i, _), (prefix, _) in known.items()})
        if not open_:
            break

        def run(batches: Iterator[pa.RecordBatch], open_: list = open_, shift: np.uint64 = shift, done: int = done) -> Iterator[pa.RecordBatch]:
            counts = {key: np.zeros(1 << RADIX, np.int64) for key in open_}
            for batch in batches:
                bits: dict[int, np.ndarray] = {}
                for i, prefix in open_:
                    if i not in bits:
                        bits[i] = _bits(batch.column(i).drop_null().to_numpy(zero_copy_only=False).astype(float))
                    here = bits[i] if not done else bits[i][bits[i] >> np.uint64(64 - done) == np.uint64(prefix)]
                    counts[i, prefix] += np.bincount((here >> shift & np.uint64((1 << RADIX) - 1)).astype(np.int64), minlength=1 << RADIX)
            for (i, prefix), n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i), pa.int32()), pa.array(np.full(len(at), str(prefix)), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], names=["i", "prefix", "bin", "n"])

        bins = picked.mapInArrow(run, "i int, prefix string, bin int, n long").groupBy("i", "prefix", "bin").agg(F.sum("n").alias("n"))
        lists = bins.groupBy("i", "prefix").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("b"))  # 2 ** RADIX at most
        wanted = df.sparkSession.createDataFrame([(i, str(prefix), r, below) for (i, r), (prefix, below) in known.items()], "i int, prefix string, rank long, below long")
        start = F.struct(F.lit(-1).alias("bin"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("sum"))
        found = F.aggregate("b", start, lambda a, x: F.when(a["sum"] > F.col("below"), a).otherwise(F.struct(x["bin"].alias("bin"), a["sum"].alias("before"), (a["sum"] + x["n"]).alias("sum"))))
        known = {(r["i"], r["rank"]): (int(r["prefix"]) << RADIX | r["f"]["bin"], r["below"] - r["f"]["before"]) for r in wanted.join(lists, ["i", "prefix"]).withColumn("f", found).select("i", "prefix", "rank", "below", "f").collect()}
    out: list[dict[int, float]] = [{} for _ in columns]
    for (i, r), (prefix, _) in known.items():
        out[i][r] = _double(prefix)
    return out


def quantiles(df: DataFrame, columns: list[str], shares: tuple[float, ...] = QUARTILES) -> list[list[float | None]]:
    """Exact quantiles of each column, between neighbours in proportion; None where no value is."""
    if not columns:
        return []
    sizes = df.agg(*[F.count(value(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    places = [[q * (n - 1) for q in shares] if n else [] for n in sizes]
    held = order_statistics(df, columns, [sorted({f(p) for p in ps for f in (math.floor, math.ceil)}) for ps in places])
    between = lambda h, p: h[int(p)] if p == int(p) else (math.ceil(p) - p) * h[math.floor(p)] + (p - math.floor(p)) * h[math.ceil(p)]
    return [[between(h, p) for p in ps] if ps else [None] * len(shares) for h, ps in zip(held, places, strict=True)]


def describe(df: DataFrame) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles and the sample deviation."""
    rows = []
    names = numeric_columns(df)
    for c, found in zip(names, quantiles(df, names), strict=True):
        v = value(df, c)
        quartiles = {f"q{int(q * 100)}": F.max(F.lit(x).cast("double")) for q, x in zip(QUARTILES, found, strict=True)}
        rows.append((c, {"count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), **quartiles, "max": F.max(v)}))
    columns = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")
    if not rows:
        return df.sparkSession.createDataFrame([], "column string, count long, " + ", ".join(f"{c} double" for c in columns[1:]))
    return _long(df, rows, columns)


def categorical(df: DataFrame, most: int = 5) -> DataFrame:
    """(column, unique, top, top_freq) of the first text columns; among equals the smallest value is on top."""
    parts = []
    for c in categorical_columns(df, most):
        counts = df.groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n")).filter("v IS NOT NULL")
        parts.append(counts.agg(F.count("*").alias("unique"), F.min_by("v", F.struct(-F.col("n"), "v")).alias("top"), F.coalesce(F.max("n"), F.lit(0)).alias("top_freq")).select(F.lit(c).alias("column"), "unique", "top", "top_freq"))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], "column string, unique long, top string, top_freq long")


def outliers(df: DataFrame, method: str = "iqr") -> DataFrame:
    """(column, outliers, pct, lower, upper) outside the quartiles by 1.5 of their range; the share is of all rows.

    Any other method gives no row.
    """
    schema = "column string, outliers long, pct double, lower double, upper double"
    names = numeric_columns(df)
    if method != "iqr" or not names:
        return df.sparkSession.createDataFrame([], schema)
    rows = []
    for c, (low, high) in zip(names, quantiles(df, names, (0.25, 0.75)), strict=True):
        v = value(df, c)
        lo, hi = (F.lit(None if low is None else x).cast("double") for x in ((None, None) if low is None else (low - 1.5 * (high - low), high + 1.5 * (high - low))))
        out = F.count_if((v < lo) | (v > hi))
        rows.append((c, {"outliers": out, "pct": F.round(F.try_divide(out * 100.0, F.count("*")), 2), "lower": F.max(lo), "upper": F.max(hi)}))
    return _long(df, rows, ("outliers", "pct", "lower", "upper"))


def _products(least: list[float]):
    """Sums over the rows that have both of each pair of columns, one row a pair and task."""
    pairs = list(combinations(range(len(least)), 2))
    a, b = (np.array(x) for x in zip(*pairs, strict=True))
    names = ["i", "j", "n", "x", "y", "xx", "yy", "xy", "low_x", "high_x", "low_y", "high_y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(least)
        sums = np.zeros((5, k, k))
        ends = np.full((2, k, k), np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            has = ~np.isnan(raw)
            x, m = np.where(has, raw - np.array(least), 0.0), has.astype(float)
            sums += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, np.zeros((k, k))])
            for j in range(k):
                held = np.where(has & has[:, j : j + 1], x, np.nan)
                if has[:, j].any():
                    ends[0, :, j] = np.fmin(ends[0, :, j], np.fmin.reduce(held, axis=0))
                    ends[1, :, j] = np.fmin(ends[1, :, j], np.fmin.reduce(-held, axis=0))
        n, one, two, both, _ = sums
        values = [n[a, b], one[a, b], one[b, a], two[a, b], two[b, a], both[a, b], ends[0, a, b], -ends[1, a, b], ends[0, b, a], -ends[1, b, a]]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), *[pa.array(v, pa.float64()) for v in values]], names=names)

    return run, "i int, j int, " + ", ".join(f"{c} double" for c in names[2:])


def correlations(df: DataFrame) -> DataFrame:
    """(col1, col2, r) of each pair of numeric columns over the rows that have both; null where either is constant."""
    names = numeric_columns(df)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "col1 string, col2 string, r double")
    ship(df.sparkSession)
    picked = df.select(*[value(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    least = [x if x is not None and math.isfinite(x) else 0.0 for x in picked.agg(*[F.min(c).alias(c) for c in picked.columns]).first()]
    run, schema = _products(least)
    every = [f"{f}({c}) AS {c}" for f, cs in (("sum", ("n", "x", "y", "xx", "yy", "xy")), ("min", ("low_x", "low_y")), ("max", ("high_x", "high_y"))) for c in cs]
    merged = picked.mapInArrow(run, schema).groupBy("i", "j").agg(*[F.expr(e) for e in every])
    spread = F.expr("(xx - x * x / n) * (yy - y * y / n)")
    r = F.when((F.col("n") > 0) & (F.col("low_x") < F.col("high_x")) & (F.col("low_y") < F.col("high_y")) & (spread > 0), F.expr("(xy - x * y / n)") / F.sqrt(spread))
    labels = df.sparkSession.createDataFrame([(i, j, names[i], names[j]) for i, j in combinations(range(len(names)), 2)], "i int, j int, col1 string, col2 string")
    return labels.join(merged.select("i", "j", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r")), ["i", "j"], "left").select("col1", "col2", F.when(~F.isnan("r"), F.col("r")).alias("r"))


def high_correlations(df: DataFrame, above: float = 0.7) -> DataFrame:
    return correlations(df).filter(F.abs("r") > above)


def target_correlations(df: DataFrame, target: str) -> DataFrame:
    """(column, r) with one column, the largest first."""
    pairs = correlations(df).filter((F.col("col1") == target) | (F.col("col2") == target))
    return pairs.select(F.when(F.col("col1") == target, F.col("col2")).otherwise(F.col("col1")).alias("column"), "r").orderBy(F.desc_nulls_last("r"))


def report(df: DataFrame, name: str) -> str:
    """The report as markdown, with at most 20 columns, 10 numeric ones, 10 outlier rows and 10 correlations."""
    gaps = missing(df).limit(20).collect()
    lines = [f"# Exploratory analysis: {name}", "", f"- Rows: {gaps[0]['rows'] if gaps else 0:,}", f"- Columns: {len(df.columns)}", "", "## Columns", "", "| column | type | missing | % |", "|---|---|---|---|"]
    lines += [f"| {r['column']} | {r['dtype']} | {r['missing']:,} | {r['missing_pct']} |" for r in gaps]
    lines += ["", "## Numeric columns", "", "| column | mean | std | min | median | max |", "|---|---|---|---|---|---|"]
    shown = lambda x: "" if x is None else f"{x:,.2f}"
    lines += [f"| {r['column']} | {shown(r['mean'])} | {shown(r['std'])} | {shown(r['min'])} | {shown(r['q50'])} | {shown(r['max'])} |" for r in describe(df).limit(10).collect()]
    lines += ["", "## Outliers", ""] + [f"- {r['column']}: {r['outliers']:,} ({r['pct']} %)" for r in outliers(df).filter("outliers > 0").limit(10).collect()]
    lines += ["", "## High correlations", ""] + [f"- {r['col1']} and {r['col2']}: {r['r']:.3f}" for r in high_correlations(df).limit(10).collect()]
    return "\n".join(lines) + "\n"


def insight_prompt(df: DataFrame, most: int = 2000) -> str:
    """The request for remarks on a table: its size, gaps and, cut at ``most`` characters, its numeric summary."""
    import json

    gaps = missing(df).collect()
    numbers = {r["column"]: {k: r[k] for k in ("mean", "std", "min", "max", "q50")} for r in describe(df).collect()}
    rows = gaps[0]["rows"] if gaps else 0
    return "\n".join([
        "What stands out in this table? Name issues of data quality, of distribution, and what to look at next.", "", f"{rows} rows, {len(df.columns)} columns",
        "Missing, in percent: " + json.dumps({r["column"]: r["missing_pct"] for r in gaps}), "Numeric columns: " + json.dumps(numbers)[:most],
    ])
