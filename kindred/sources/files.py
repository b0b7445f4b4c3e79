"""Columnar and whole-file scans. Every path is a Hadoop path or glob (``s3a://``, ``hdfs://`` …)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parquet_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several directories in one scan."""
    return spark.read.parquet(*paths)


def decoded(path: Column) -> Column:
    """File paths arrive URI-encoded; a plus sign in them is a plus sign."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def with_file_key(df: DataFrame, pattern: str, alias: str) -> DataFrame:
    """Add the part of each row's file path that the first group of ``pattern`` matches.

    Must be the first step after a file scan, where ``_metadata`` is still visible.
    """
    return df.select("*", F.regexp_extract(decoded(F.col("_metadata.file_path")), pattern, 1).alias(alias))


def consolidate_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Many small documents to one table: ``id`` (file name) and ``json`` (file text)."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    return files.select(
        decoded(F.col("_metadata.file_name")).alias("id"), F.col("value").alias("json")
    )


def read_latest_snapshot(spark: SparkSession, path: str, prefix: str = "raw_movies_") -> DataFrame:
    """Rows of the newest of the dated Parquet tables ``<prefix>yyyy-MM-dd.parquet``.

    Only file names are looked at to find the date; older tables are not read.
    """
    root = path.rstrip("/")
    dated = rf"/{prefix}(\d{{4}}-\d{{2}}-\d{{2}})\.parquet(?:/|$)"
    files = spark.read.format("binaryFile").load(f"{root}/{prefix}*.parquet")
    names = files.select(F.regexp_extract(decoded(F.col("path")), dated, 1).alias("day"))
    newest = names.filter("day <> ''").agg(F.max("day").alias("day")).first()["day"]
    if newest is None:
        raise FileNotFoundError(f"no {prefix}<date>.parquet in {path}")
    return spark.read.parquet(f"{root}/{prefix}{newest}.parquet")


def local_table(spark: SparkSession, rows, schema) -> DataFrame:
    """Rows of the program itself as a table; meant for fixtures and parameters."""
    return spark.createDataFrame(rows, schema)
