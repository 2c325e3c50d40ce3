"""Quality rules: robust multivariate outliers per language and source.

Base counts reject texts that are tiny or repeat themselves. The other texts become
vectors of transformed statistics. For each language and source, for each language as a
whole, and for all languages together, the minimum covariance determinant is sought by concentration steps: the
rows are ordered by Mahalanobis distance, and the mean and covariance of the nearest
HALF become the next estimate. A step is one aggregation over all rows: distances fall
into fine logarithmic bins that hold counts and moments, so the rows of a group never
meet in one task; the bin at the boundary counts in part. Steps go on until no start's
determinant falls any more (a start that has settled keeps its estimate; determinants
have a floor, so all settle). Two starts run side by side
(coordinate medians and quartile ranges; plain moments) and the one with the smaller
determinant wins, is made consistent, and reweighted once. A diagonal floor keeps the
covariance invertible where a statistic hardly varies.

Groups of fewer than LEAST rows are judged by their language's estimate, and where that
has fewer too, by the estimate over all languages, whatever its size. Nulls and empty texts fail the base rules. Null
languages and sources are groups of their own. Repeated rows are judged each; other
columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.llm import statistics
from blockspark.llm.common import map_batches, salted
from blockspark.session import shared_dir, ship

#: Names of the transformed statistics, and the standard deviation below which each is taken as noise;
#: the bounded ones (dup_lines below 1, repeats below 0.2) are small enough that each alone can pass the cut.
VECTOR = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "bars")
FLOOR = (0.5, 0.12, 0.15, 0.06, 0.02, 0.05, 0.05)
#: Share of a group that the estimate covers, rows a group needs, the fall of a log determinant below which a start has settled, and the tail of the chi-squared distribution beyond which a row is rejected.
HALF, LEAST, SETTLED, TAIL = 0.75, 100, 1e-3, 1e-12
#: Bins for the logarithm of a squared distance.
PER_E, LOW, HIGH = 8, -12.0, 18.0
P = len(VECTOR)


def vector(text: str, base: tuple[int, int, int, int, int]) -> list[float]:
    """The transformed statistics; small counts are drawn towards the usual value."""
    n, chars, symbols, dups, repeats = base
    lines = text.count("\n") + 1
    upper = sum(map(str.isupper, text)) if len(text) < 4096 else _upper(text)
    return [math.log(n + 1), math.log(chars / max(n, 1) + 1), math.log1p(symbols / (n + 20) * 10), dups / (lines + 10), repeats / (n + 50), upper / (chars + 50), text.count("|") / (n + 20)]


def _upper(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        x = np.frombuffer(raw, np.uint8)
        return int(((x >= 65) & (x <= 90)).sum())
    return sum(map(str.isupper, text))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, language, source, the counts of statistics.BASE, x): a row per row."""

    def run(batch: pa.RecordBatch) -> list:
        counts, xs = [], []
        for text in batch.column(1).to_pylist():
            counts.append(statistics.base(text))
            xs.append(vector(text or "", counts[-1]))
        return [batch.column(0), batch.column(2), batch.column(3), *zip(*counts, strict=True), xs] if counts else [[]] * 9

    group = lambda c: (F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) if c in docs.columns else F.lit("null")).alias(f"__{c}")
    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"), group("lang"), group("source"))
    return map_batches(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, g_lang string, g_source string, {', '.join(f'{c} long' for c in statistics.BASE)}, x array<double>", text=1)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def chi2_cdf(x: float, k: float) -> float:
    """Distribution function of chi-squared, by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    if z > a + 60:
        return 1.0 - math.exp(-z + (a - 1) * math.log(z) - math.lgamma(a))
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


@lru_cache(maxsize=64)
def chi2_quantile(q: float, k: float, tail: bool = False) -> float:
    """The x with ``q`` of the distribution below it, or above it if ``tail``; by bisection."""
    low, high = 0.0, 2000.0

    def above(x: float) -> bool:
        if not tail:
            return chi2_cdf(x, k) >= q
        a, z = k / 2, x / 2
        upper = 1 - chi2_cdf(x, k) if z < a + 10 else math.exp(-z + (a - 1) * math.log(z) - math.lgamma(a)) * sum(np.cumprod([1.0, *[(a - i) / z for i in range(1, max(1, int(a)) + 1)]]))
        return upper <= q

    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if above(middle) else (middle, high)
    return high


def consistency(share: float, p: int = P) -> float:
    """Factor that makes the covariance of the nearest ``share`` right for normal data."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def _distance(x: str = "x", m: str = "m", w: str = "w") -> Column:
    """(x-m)' W (x-m), W being the upper triangle with doubled off-diagonal terms."""
    terms, k = [], 0
    d = [F.col(x)[i] - F.col(m)[i] for i in range(P)]
    for i in range(P):
        inner: Column = F.lit(0.0)
        for j in range(i, P):
            inner = inner + F.col(w)[k] * d[j]
            k += 1
        terms.append(d[i] * inner)
    total: Column = F.lit(0.0)
    for t in terms:
        total = total + t
    return F.greatest(total, F.lit(1e-9))


def _moments(prefix: str = "") -> list[Column]:
    first = [F.sum(F.col("x")[i]).alias(f"{prefix}s{i}") for i in range(P)]
    return [F.count("*").alias(f"{prefix}n"), *first, *[F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"{prefix}q{i}_{j}") for i in range(P) for j in range(i, P)]]


SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"q{i}_{j}" for i in range(P) for j in range(i, P)]]
ESTIMATE = "g_lang string, g_source string, start int, n double, m array<double>, w array<double>, logdet double"


def estimate(sums: np.ndarray, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance, floored, from the sums in the order of SUMS."""
    n = sums[0]
    mean = sums[1 : P + 1] / n
    second = np.zeros((P, P))
    second[np.triu_indices(P)] = sums[P + 1 :] / n
    second = second + np.triu(second, 1).T
    cov = second - np.outer(mean, mean)
    return mean, factor * (cov + cov.T) / 2 + np.diag(np.square(FLOOR))


def packed(cov: np.ndarray) -> tuple[list[float], float]:
    """The inverse as ``_distance`` takes it, and the logarithm of the determinant."""
    values, vectors = np.linalg.eigh(cov)
    values = np.maximum(values, 1e-9)
    inverse = (vectors / values) @ vectors.T
    doubled = 2 * np.triu(inverse, 1) + np.diag(np.diag(inverse))
    return doubled[np.triu_indices(P)].tolist(), float(np.log(values).sum())


def nearest(bins: pd.DataFrame, share: float) -> np.ndarray:
    """Sums over the nearest ``share`` of the rows, the boundary's bin in part."""
    bins = bins.sort_values("bin")
    sums = bins[SUMS].to_numpy(dtype=float)
    want = share * sums[:, 0].sum()
    before = np.cumsum(sums[:, 0]) - sums[:, 0]
    part = np.clip((want - before) / sums[:, 0], 0, 1)
    return part @ sums


def _levels(rows: DataFrame) -> DataFrame:
    """Each row once for its language and source, once for its language, and once for all."""
    level = lambda lang, source: F.struct(lang.alias("g_lang"), source.alias("g_source"))
    own = F.array(level(F.col("g_lang"), F.col("g_source")), level(F.col("g_lang"), F.lit("*")), level(F.lit("*"), F.lit("*")))
    return rows.withColumn("g", F.explode(own)).select("g.*", "x")


def robust_estimates(rows: DataFrame, half: float = HALF, settled: float = SETTLED) -> DataFrame:
    """ESTIMATE with one row per group: the winning start, made consistent and reweighted; n counts all its rows.

    rows: (g_lang, g_source, x). The estimates are small: one row for each group.
    """
    ship(rows.sparkSession)
    rows = _levels(rows.select("g_lang", "g_source", "x"))
    keys = ["g_lang", "g_source"]

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                sums = np.array([r[c] for c in SUMS], dtype=float)
                quartiles = np.array([r[f"p{i}"] for i in range(P)], dtype=float)
                wide = np.diag(np.square((quartiles[:, 2] - quartiles[:, 0]) / 1.349) + np.square(FLOOR))
                for k, (mean, cov) in enumerate(((quartiles[:, 1], wide), estimate(sums))):
                    w, det = packed(cov)
                    out.append((r["g_lang"], r["g_source"], k, r["n"], mean.tolist(), w, det))
            yield pd.DataFrame(out, columns=["g_lang", "g_source", "start", "n", "m", "w", "logdet"])

    quartiles = [F.percentile_approx(F.col("x")[i], [0.25, 0.5, 0.75], 1000).alias(f"p{i}") for i in range(P)]
    held = rows.groupBy(keys).agg(*_moments(), *quartiles).mapInPandas(begin, ESTIMATE).checkpoint()

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        sums = nearest(frame, half)
        mean, cov = estimate(sums, consistency(half))
        w, det = packed(cov)
        return pd.DataFrame([(frame["g_lang"].iat[0], frame["g_source"].iat[0], int(frame["start"].iat[0]), float(frame["n"].sum()), mean.tolist(), w, det)], columns=["g_lang", "g_source", "start", "n", "m", "w", "logdet"])

    moving, first = held, True
    while True:
        # a row meets the starts of its group that still move: the estimates of a group are one array
        starts = moving.groupBy(keys).agg(F.collect_list(F.struct("start", "m", "w")).alias("e"))
        near = salted(rows, starts, keys, how="inner").withColumn("e", F.explode("e")).select(*keys, "x", F.col("e.start").alias("start"), F.col("e.m").alias("m"), F.col("e.w").alias("w"))
        fine = near.withColumn("bin", F.floor(F.least(F.greatest(F.log(_distance()), F.lit(LOW)), F.lit(HIGH)) * PER_E).cast("int"))
        now = fine.groupBy(*keys, "start", "bin").agg(*_moments()).groupBy(*keys, "start").applyInPandas(step, ESTIMATE)
        if first:  # a start's own determinant is of another kind
            moving = held = now.checkpoint()
            first = False
            continue
        fell = F.coalesce(F.col("o.logdet") - F.col("e.logdet") > settled, F.lit(False))
        both = held.drop("fell").alias("o").join(now.alias("e"), [*keys, "start"], "left")
        kept = F.when(fell, F.struct("e.n", "e.m", "e.w", "e.logdet")).otherwise(F.struct("o.n", "o.m", "o.w", "o.logdet"))
        held = both.select(*keys, "start", fell.alias("fell"), kept.alias("x")).select(*keys, "start", "fell", "x.*").checkpoint()
        moving = held.filter("fell")
        if moving.isEmpty():
            break
    best = held.groupBy(keys).agg(F.min_by(F.struct("start", F.col("n").alias("rows"), "m", "w"), F.struct("logdet", "start")).alias("e")).select(*keys, "e.*")

    def reweigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                sums = np.array([r[c] for c in SUMS], dtype=float)
                mean, cov = estimate(sums, consistency(0.975))
                w, det = packed(cov)
                out.append((r["g_lang"], r["g_source"], 0, r["rows"], mean.tolist(), w, det))
            yield pd.DataFrame(out, columns=["g_lang", "g_source", "start", "n", "m", "w", "logdet"])

    inner = salted(rows, best, keys, how="inner").filter(_distance() <= chi2_quantile(0.975, P))
    return inner.groupBy(keys).agg(F.first("rows").alias("rows"), *_moments()).mapInPandas(reweigh, ESTIMATE).checkpoint()


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float = TAIL, least: int = LEAST) -> DataFrame:
    """A row per row: id, the base counts, base_failed, distance2 (null only where no row of the table passes the base rules), kept."""
    shared_dir(docs.sparkSession)
    rows = measured(docs, id_col, text_col).withColumn("base_failed", base_failed()).checkpoint()
    found = robust_estimates(rows.filter(~F.col("base_failed"))).filter((F.col("n") >= least) | (F.col("g_lang") == "*")).select("g_lang", "g_source", "m", "w")
    last = found.filter("g_lang = '*'").select(F.col("m").alias("m3"), F.col("w").alias("w3"))
    found = found.filter("g_lang != '*'")
    own = salted(rows, found.select("g_lang", "g_source", F.col("m").alias("m1"), F.col("w").alias("w1")), ["g_lang", "g_source"])
    both = salted(own, found.filter("g_source = '*'").select("g_lang", F.col("m").alias("m2"), F.col("w").alias("w2")), ["g_lang"])
    both = both.join(F.broadcast(last), how="left")  # one row, or none
    both = both.withColumn("m", F.coalesce("m1", "m2", "m3")).withColumn("w", F.coalesce("w1", "w2", "w3"))
    far = both.withColumn("distance2", F.when(F.col("m").isNotNull(), _distance()))
    return far.select(id_col, *statistics.BASE, "base_failed", "distance2", (~F.col("base_failed") & F.coalesce(F.col("distance2") <= chi2_quantile(tail, P, True), F.lit(True))).alias("kept"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", *statistics.BASE, "base_failed", "kept", F.round("distance2", 6).alias("distance2"))
