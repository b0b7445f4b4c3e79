"""Expressions over ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def vector_sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def vector_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is null or all zero."""
    dot = vector_sum(F.zip_with(a, b, lambda x, y: x * y))
    return F.try_divide(dot, l2_norm(a) * l2_norm(b))
