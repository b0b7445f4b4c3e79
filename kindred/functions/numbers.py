"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rating_bucket(value: Column, best: Column) -> Column:
    """Share of the best value on a 1..10 scale, rounded up."""
    return F.ceil(value / best * F.lit(10))


def page_count(total: Column, per_page: int = 100) -> Column:
    return F.ceil(total / F.lit(per_page))


def two_decimals(c: Column) -> Column:
    """``0.125`` as ``0.12``: halves go to the even digit, without grouping."""
    return F.call_function("format_number", c.cast("double"), F.lit("0.00"))
