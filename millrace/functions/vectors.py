"""Vector expressions over array columns, native (no Python in the executors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null when either vector is null or all zeros, or the lengths differ."""
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), norm(a) * norm(b)))


def euclidean_distance(a: Column, b: Column) -> Column:
    """Null when either vector is null or the lengths differ."""

    def squared(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.when(F.size(a) == F.size(b), F.sqrt(_sum(F.zip_with(a, b, squared))))
