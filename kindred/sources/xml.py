"""XML sources. The root element is the record, so a file that does not parse is left out whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred import schema as S
from kindred.functions.text import null_if, unescape_html
from kindred.schema import CONTENT, RATINGS, conform
from kindred.sources.files import with_file_key


def _read_roots(spark: SparkSession, path: str, schema: str, root_tag: str, glob: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", root_tag)
        .option("mode", "DROPMALFORMED")
        .option("pathGlobFilter", glob)
        .schema(schema)
        .load(path)
    )


def collection_ratings(items: DataFrame, user_id: str = "user_id", item: str = "item") -> DataFrame:
    """Ratings of parsed collection items; each item stands for itself, absent parts are null."""
    i = F.col(item)
    return conform(
        items.select(
            F.col(user_id).alias("user_id"),
            F.lit("boardgame").alias("type"),
            i["_objectid"].alias("content_id"),
            null_if(i["stats"]["rating"]["_value"], "N/A").alias("rating"),
            i["status"]["_lastmodified"].alias("rating_date"),
        ),
        RATINGS,
    )


def catalogue_content(items: DataFrame, content_id: str = "content_id", item: str = "item") -> DataFrame:
    """Content row of parsed catalogue items, titled by the primary name."""
    i = F.col(item)
    primary = F.filter(i["name"], lambda n: n["_type"] == F.lit("primary"))
    return conform(
        items.select(
            F.col(content_id).alias("content_id"),
            unescape_html(i["description"]).alias("description"),
            i["yearpublished"]["_value"].alias("release_year"),
            F.lit("boardgame").alias("type"),
            F.get(primary, F.lit(0))["_value"].alias("title"),
        ),
        CONTENT,
    )


def read_collections_xml(
    spark: SparkSession, path: str, root_tag: str = "items", glob: str = "*.xml", key: str = r"/([^/]+)\.xml$"
) -> DataFrame:
    """One file per user, one ``item`` per owned game, to ratings. Here and below ``glob`` chooses the
    files by name, and ``key`` finds the id in their path."""
    roots = _read_roots(spark, path, f"item array<{S.COLLECTION_ITEM}>", root_tag, glob)
    users = with_file_key(roots, key, "user_id")
    return collection_ratings(users.select("user_id", F.explode("item").alias("item")))


def read_catalogue_xml(
    spark: SparkSession, path: str, root_tag: str = "items", glob: str = "1.xml", key: str = r"/([^/]+)/1\.xml$"
) -> DataFrame:
    """One folder per game of which only ``1.xml`` is read, to content."""
    roots = _read_roots(
        spark, f"{path.rstrip('/')}/*", f"item array<{S.CATALOGUE_ITEM}>", root_tag, glob
    )
    games = with_file_key(roots, key, "content_id")
    return catalogue_content(games.select("content_id", F.explode("item").alias("item")))


def read_review_pages_xml(
    spark: SparkSession, path: str, root_tag: str = "items", glob: str = "*.xml", key: str = r"/([^/]+)/[^/]+\.xml$"
) -> DataFrame:
    """Review pages, one folder per game, to (``game_id``, ``username``, ``rating``)."""
    roots = _read_roots(spark, f"{path.rstrip('/')}/*", S.REVIEW_PAGE, root_tag, glob)
    games = with_file_key(roots, key, "game_id")
    return review_comments(games.select("game_id", F.explode("item").alias("item")))


def review_comments(items: DataFrame, game_id: str = "game_id", item: str = "item") -> DataFrame:
    """One row per comment of parsed review items."""
    comments = items.select(
        F.col(game_id).alias("game_id"), F.explode(F.col(item)["comments"]["comment"]).alias("c")
    )
    return comments.select(
        "game_id",
        F.col("c._username").alias("username"),
        null_if("c._rating", "N/A").try_cast("double").alias("rating"),
    )


def read_review_totals_xml(
    spark: SparkSession, path: str, root_tag: str = "items", glob: str = "1.xml", key: str = r"/([^/]+)/1\.xml$"
) -> DataFrame:
    """(``game_id``, ``total``) as announced by the first review page of each game."""
    roots = _read_roots(spark, f"{path.rstrip('/')}/*", S.REVIEW_PAGE, root_tag, glob)
    games = with_file_key(roots, key, "game_id")
    return games.select("game_id", F.explode("item").alias("i")).select(
        "game_id", F.col("i.comments._totalitems").try_cast("bigint").alias("total")
    )
