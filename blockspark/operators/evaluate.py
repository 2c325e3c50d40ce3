"""Shares of right answers and of successful runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(answers: DataFrame, predicted: str = "predicted", truth: str = "answer") -> DataFrame:
    """(total, correct, accuracy): a missing prediction is wrong; without rows the share is 0."""
    right = F.count_if(F.col(predicted) == F.col(truth))
    return answers.agg(F.count("*").alias("total"), right.alias("correct"), F.coalesce(F.try_divide(right.cast("double"), F.count("*")), F.lit(0.0)).alias("accuracy"))


def run_summary(results: DataFrame) -> DataFrame:
    """(total, succeeded, failed, seconds) of rows with status and elapsed."""
    return results.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status") == "error").alias("failed"), F.coalesce(F.sum("elapsed"), F.lit(0.0)).alias("seconds"))


def remaining_seconds(left: int, average: float | None, slots: int, guess: float = 30.0) -> float:
    """Time that ``left`` pages still take, by the mean so far or a guess."""
    return left / max(1, slots) * (average or guess)
