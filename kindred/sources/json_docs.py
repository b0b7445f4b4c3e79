"""JSON sources: multi-line documents, objects keyed by id, JSON Lines exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred import schema as S
from kindred.sources.files import with_file_key
from kindred.sources.json_entries import read_entries


def read_json_multiline(
    spark: SparkSession, path: str | list[str], schema, mode: str = "DROPMALFORMED", glob: str = "*.json"
) -> DataFrame:
    """Documents spread over several lines. A schema is required: inference would read all files."""
    return spark.read.schema(schema).json(path, multiLine=True, mode=mode, pathGlobFilter=glob)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line and its ``place``: the file, where the part that a task read of it begins, and the
    row's number, which grows within a part."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("ordinal"),
    )
    return spark.read.text(path).select("value", place.alias("place"))


def keyed_entries(docs: DataFrame, text: str, value_schema: str) -> DataFrame:
    """``{id: value, …}`` texts to one (key, value) row per entry."""
    parsed = F.from_json(F.col(text), f"map<string,{value_schema}>")
    return docs.select(F.explode(parsed).alias("key", "value"))


def keyed_list_entries(docs: DataFrame, text: str, value_schema: str) -> DataFrame:
    """``[{id: value}, …]`` texts to (key, value, position) rows; ``position`` is the list index."""
    parsed = F.from_json(F.col(text), f"array<map<string,{value_schema}>>")
    objects = docs.select(F.posexplode(parsed).alias("position", "entry"))
    return objects.select("position", F.explode("entry").alias("key", "value")).select(
        "key", "value", "position"
    )


def read_keyed_json(
    spark: SparkSession, path: str, value_schema: str, lines: bool = True
) -> DataFrame:
    """Objects keyed by id, one per line. With ``lines=False`` a file is one object, of any size: it is cut
    into its entries by as many tasks as it has splits (``json_entries``)."""
    if lines:
        return keyed_entries(_lines(spark, path), "value", value_schema)
    entries = read_entries(spark, path)
    return keyed_entries(entries.select(F.concat(F.lit("{"), "value", F.lit("}")).alias("value")), "value", value_schema)


def read_keyed_json_list(
    spark: SparkSession, path: str, value_schema: str, lines: bool = True
) -> DataFrame:
    """Single-key objects, one per line, or with ``lines=False`` files that hold a list of them, of any size.

    ``position`` orders the entries alike in both forms: by file name, and within a file as listed.
    """
    docs = _lines(spark, path) if lines else read_entries(spark, path)
    parsed = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), f"array<map<string,{value_schema}>>")
    objects = docs.select("place", F.posexplode(parsed).alias("index", "entry"))
    return objects.select("place", "index", F.explode("entry").alias("key", "value")).select(
        "key", "value", F.struct("place", "index").alias("position")
    )


def read_anime_lists(
    spark: SparkSession, path: str, glob: str = "*.json", key: str = r"/([^/]+)\.json$"
) -> DataFrame:
    """One JSON array per user; ``user_id`` is what ``key`` finds in the path, the file stem by default."""
    return with_file_key(read_json_multiline(spark, path, S.ANIME_LIST, glob=glob), key, "user_id")


def read_anime_info(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    return read_json_multiline(spark, path, S.ANIME_INFO, glob=glob)


def read_review_json(
    spark: SparkSession, path: str, glob: str = "*.json", key: str = r"/([^/]+)\.json$"
) -> DataFrame:
    """(``anime_id``, ``username``) of every review; one file per anime."""
    docs = with_file_key(read_json_multiline(spark, path, S.ANIME_REVIEWS, glob=glob), key, "anime_id")
    return reviewers(docs)


def reviewers(docs: DataFrame) -> DataFrame:
    """One row per review of parsed review documents."""
    return docs.select("anime_id", F.explode("data.user.username").alias("username"))


def read_id_export(spark: SparkSession, path: str) -> DataFrame:
    """Gzip JSON Lines export of movie ids."""
    return spark.read.schema("id bigint").json(path)
