"""One ratings table and one content table from the domains' tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kindred.functions.text import normalise_user
from kindred.operators.nodes import one_row_per_key
from kindred.schema import CONTENT, RATINGS, conform


def _union(dfs) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def merge_ratings(*dfs: DataFrame) -> DataFrame:
    """Union of ratings tables; every branch is brought to the unified types first."""
    return (
        _union(conform(df, RATINGS) for df in dfs)
        .withColumn("user_id", normalise_user("user_id"))
        .withColumn("type", F.lower("type"))
    )


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def merge_content(*dfs: DataFrame) -> DataFrame:
    """Union of content tables."""
    return _union(conform(df, CONTENT) for df in dfs)


def unique_content(content: DataFrame) -> DataFrame:
    """One row per (``content_id``, ``type``), the last by its other columns; rows without an id or
    a type are left out."""
    known = content.filter(F.col("content_id").isNotNull() & F.col("type").isNotNull())
    return one_row_per_key(known, ["content_id", "type"])
