"""Arithmetic on array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def normalize(x: Column) -> Column:
    """x by its Euclidean norm; the zero vector stays."""
    return F.when(norm(x) > 0, F.transform(x, lambda v: v.cast("double") / norm(x))).otherwise(F.transform(x, lambda v: v.cast("double")))


def squared_distance(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, v: s + v)


def distance(x: Column, y: Column) -> Column:
    return F.sqrt(squared_distance(x, y))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
