"""Anime: per-user lists and anime records, both JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.functions.dates import epoch_date
from kindred.schema import CONTENT, RATINGS, conform


def anime_ratings(lists: DataFrame) -> DataFrame:
    """``user_id``, ``anime_id``, ``score``, ``updated_at`` (epoch seconds) to ratings."""
    return conform(
        lists.select(
            "user_id",
            F.lit("anime").alias("type"),
            F.col("anime_id").alias("content_id"),
            F.col("score").alias("rating"),
            epoch_date(F.col("updated_at")).alias("rating_date"),
        ),
        RATINGS,
    )


def anime_content(info: DataFrame) -> DataFrame:
    """Anime records with a known first year of airing."""
    dated = info.dropna(subset=["data.aired.prop.from.year"])
    return conform(
        dated.select(
            F.col("data.mal_id").alias("content_id"),
            F.col("data.synopsis").alias("description"),
            F.col("data.aired.prop.from.year").alias("release_year"),
            F.lit("anime").alias("type"),
            F.col("data.title").alias("title"),
        ),
        CONTENT,
    )
