"""Video games: owned games and profiles keyed by account, and a catalogue keyed by game."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.functions.dates import last_year
from kindred.functions.text import json_default
from kindred.operators.playtime import normalise_playtime
from kindred.schema import CONTENT, RATINGS, conform


def player_names(profiles: DataFrame) -> DataFrame:
    """(``key``, ``user_id``): the display name in the first profile listed for each account.

    Accounts whose first profile is empty are left out. ``profiles`` comes from
    ``read_keyed_json_list``, whose ``position`` tells the order; equal positions go by the text.
    """
    position = F.col("position")
    first = profiles.groupBy("key").agg(
        F.min_by(F.struct(F.map_entries("value").alias("entries")), F.struct(position, F.to_json("value"))).alias("p")
    )
    fields = F.map_from_entries("p.entries")
    return first.filter(F.size("p.entries") > 0).select(
        "key", json_default(fields, "personaname", "Unknown").alias("user_id")
    )


def videogame_ratings(
    games: DataFrame,
    profiles: DataFrame,
    key: str = "user_id",
    type_label: str = "videogame",
) -> DataFrame:
    """Playing times to ratings 1..10 relative to each user's most played game.

    ``key`` is what counts as one user: the display name, or ``account``.
    """
    owned = games.select("key", F.explode("value").alias("g")).select(
        "key",
        F.col("g.appid").cast("string").alias("content_id"),
        F.col("g.playtime_forever").alias("playtime"),
    )
    played = owned.filter(F.col("playtime") > 0).join(player_names(profiles), "key")
    rated = normalise_playtime(played.withColumnRenamed("key", "account"), key=key)
    return conform(rated.withColumn("type", F.lit(type_label)), RATINGS)


def videogame_content(
    games: DataFrame, type_label: str = "videogame", title_column: str = "title"
) -> DataFrame:
    """(``key``, ``value``) catalogue entries to content."""
    released = json_default("value", "release_date", "")
    content = conform(
        games.select(
            F.col("key").alias("content_id"),
            json_default("value", "detailed_description", "").alias("description"),
            last_year(released).alias("release_year"),
            F.lit(type_label).alias("type"),
            json_default("value", "name", "").alias("title"),
        ),
        CONTENT,
    )
    return content.withColumnRenamed("title", title_column)
