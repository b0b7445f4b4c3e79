"""Parquet sinks. Paths are Hadoop paths, so a zone may lie in an object store."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_zone(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    files: int | None = None,
) -> None:
    """Write Parquet. ``mode='errorifexists'`` refuses to replace; ``files`` merges the output into
    that many files and should stay unset for anything large."""
    if files is not None:
        df = df.coalesce(files)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish(df: DataFrame, zone: str, prefix: str, partition_by: tuple[str, ...] = ("type",)) -> DataFrame:
    """Write under a prefix of a zone, by domain, and return the table as read back: with the types
    it was written with, in the order of its columns."""
    path = f"{zone.rstrip('/')}/{prefix}"
    write_zone(df, path, partition_by=list(partition_by))
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
