"""Counts that describe the unified tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.functions.text import plain_user
from kindred.operators.merge import first_rows


def _counted(grouped, key: str) -> DataFrame:
    return grouped.agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), key)


def count_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of ``col``, largest first."""
    return _counted(df.groupBy(col), col)


def domains_per_user(ratings: DataFrame) -> DataFrame:
    """In how many domains a user name occurs, ignoring case and punctuation."""
    pairs = ratings.select(plain_user("user_id").alias("user_id"), "type").distinct()
    return count_by(pairs, "user_id")


def user_by_type(ratings: DataFrame, user: str) -> DataFrame:
    """One user's rows per domain."""
    return count_by(ratings.filter(F.col("user_id") == user), "type")


def titles_in_order(content: DataFrame, kind: str, n: int = 500) -> DataFrame:
    return first_rows(content.filter(F.col("type") == kind), ["title", "content_id"], n)


def distinct_raters(reviews: DataFrame, game: str = "game_id", user: str = "username") -> DataFrame:
    """Each (game, user) once."""
    return reviews.select(game, user).distinct()
