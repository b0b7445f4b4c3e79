"""Movies: review pages as JSON text in Parquet, and movie records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.functions.dates import first_year, iso_date
from kindred.schema import CONTENT, RATINGS, REVIEWS_JSON, conform


def movie_ratings(reviews: DataFrame) -> DataFrame:
    """``id``, ``results`` (a JSON array of reviews) to one rating per review."""
    parsed = reviews.filter(F.length("results") > 2).select(
        "id", F.explode(F.from_json("results", REVIEWS_JSON)).alias("r")
    )
    return conform(
        parsed.select(
            F.col("r.author").alias("user_id"),
            F.lit("movie").alias("type"),
            F.col("id").alias("content_id"),
            F.col("r.author_details.rating").alias("rating"),
            iso_date(F.col("r.created_at")).alias("rating_date"),
        ),
        RATINGS,
    )


def movie_content(info: DataFrame) -> DataFrame:
    return conform(
        info.select(
            F.col("id").alias("content_id"),
            F.col("overview").alias("description"),
            first_year(F.col("release_date")).alias("release_year"),
            F.lit("movie").alias("type"),
            F.col("original_title").alias("title"),
        ),
        CONTENT,
    )
