"""What is still to be collected, and where collection stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.session import shuffle_partitions


def frontier(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Keys of ``wanted`` that ``have`` lacks, each once. Both sides are reduced to their distinct
    keys first, so repeated keys cost nothing in the join."""
    return (
        wanted.select(key).filter(F.col(key).isNotNull()).distinct()
        .join(have.select(key).distinct(), key, "left_anti")
    )


def high_water_mark(df: DataFrame, col: str) -> DataFrame:
    """Largest id collected so far, one row."""
    return df.agg(F.max(col).alias(col))


def store_keys(df: DataFrame, key: str, table: str, buckets: int | None = None) -> None:
    """Add the distinct keys of ``df`` to a table of the catalogue, bucketed and sorted by key: what was fetched.

    ``buckets`` (by default the number of shuffle partitions) are fixed when the table is made; later calls must say
    the same or nothing. Adding appends files to the buckets; keys that are there already do no harm.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = _buckets(spark, table) or shuffle_partitions(spark)
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    # In as many tasks as buckets, so that each adds one file to its own.
    keys.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def _buckets(spark: SparkSession, table: str) -> int | None:
    if not spark.catalog.tableExists(table):
        return None
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(told["Num Buckets"]) if "Num Buckets" in told else None


def frontier_of_stored(wanted: DataFrame, table: str, key: str) -> DataFrame:
    """``frontier`` against a table of ``store_keys``: only the wanted keys are moved, to the buckets of the stored
    ones, which stay where they are however many there are. Stored keys are neither sorted nor made distinct.

    Bucketing saves the move where a table has as many buckets as there are shuffle partitions, or more.
    """
    have = wanted.sparkSession.table(table).select(key)
    asked = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    return asked.join(have.hint("merge"), key, "left_anti")
