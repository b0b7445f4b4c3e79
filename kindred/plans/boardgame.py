"""Board games: XML collections and catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.sources.xml import read_catalogue_xml, read_collections_xml


def boardgame_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_collections_xml(spark, path)


def boardgame_content(spark: SparkSession, path: str) -> DataFrame:
    return read_catalogue_xml(spark, path)
