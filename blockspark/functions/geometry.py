"""Boxes as arrays of numbers or of corner points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockspark.functions.text import col


def clamped(box: Column | str, width: Column | str, height: Column | str) -> Column:
    """[x1, y1, x2, y2] as whole numbers inside the page."""
    b = col(box)
    return F.array(F.greatest(F.lit(0), F.get(b, F.lit(0)).cast("int")), F.greatest(F.lit(0), F.get(b, F.lit(1)).cast("int")), F.least(col(width).cast("int"), F.get(b, F.lit(2)).cast("int")), F.least(col(height).cast("int"), F.get(b, F.lit(3)).cast("int")))


def has_area(box: Column | str) -> Column:
    b = col(box)
    return (F.get(b, F.lit(2)) > F.get(b, F.lit(0))) & (F.get(b, F.lit(3)) > F.get(b, F.lit(1)))


def corners(box: Column | str) -> Column:
    """The four corners of [x1, y1, x2, y2], clockwise from the first."""
    x1, y1, x2, y2 = [F.get(col(box), F.lit(i)).cast("double") for i in range(4)]
    return F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))


def centre(points: Column | str, axis: int) -> Column:
    """Mean of the points' coordinates along an axis."""
    p = col(points)
    return F.aggregate(p, F.lit(0.0), lambda a, x: a + F.get(x, F.lit(axis)), lambda a: a / F.size(p))


def shifted(points: Column | str, dx: Column | str, dy: Column | str) -> Column:
    """Points of a crop as points of its page; points of under two numbers stay."""
    return F.transform(col(points), lambda p: F.when(F.size(p) >= 2, F.array(F.get(p, F.lit(0)) + col(dx), F.get(p, F.lit(1)) + col(dy))).otherwise(p))
