"""A node zone in buckets by the hash of its key: merging rows into it rewrites the buckets they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kindred.operators.nodes import upsert_nodes
from kindred.session import checkpoint
from kindred.sinks.paths import mark, names_in

BUCKET = "bucket"
_MARK = "_buckets-"  # without a sign that would make it a partition


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str) -> None:
    rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def _buckets_of(spark: SparkSession, path: str) -> int | None:
    found = [int(name[len(_MARK):]) for name in names_in(spark, path) if name.startswith(_MARK)]
    return found[0] if found else None


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The zone without its bucket column; buckets written before a column was added have nulls in it."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(BUCKET)


def upsert_bucketed(
    new: DataFrame, path: str, keys: list[str], order: str | None = None, buckets: int = 256
) -> list[int]:
    """Merge ``new`` into the zone at ``path`` by key, as ``upsert_nodes`` does, and return the buckets
    rewritten. The files of all other buckets stay as they are and are not read.

    The first call makes the zone, with ``buckets`` buckets; later ones keep their number. Choose it so that
    a bucket is a few hundred megabytes. The merged rows are stored in the shared folder before they replace
    those they were made from, so a lost executor cannot lose rows. Buckets are replaced one after the
    other: after a failure in between, the same call again completes the merge, since it changes nothing
    where it was done. One writer at a time.
    """
    spark = new.sparkSession
    have = _buckets_of(spark, path)
    number = have or buckets
    mine = checkpoint(new.withColumn(BUCKET, _bucket(keys, number)))
    touched = sorted(r[BUCKET] for r in mine.select(BUCKET).distinct().collect())  # as many as there are buckets
    if not touched:
        return []
    if have is None:
        old = mine.limit(0).drop(BUCKET)
    else:
        whole = spark.read.option("mergeSchema", "true").parquet(path)
        old = whole.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = upsert_nodes(old, mine.drop(BUCKET), keys, order)
    _write(checkpoint(merged.withColumn(BUCKET, _bucket(keys, number))), path)
    if have is None:
        mark(spark, f"{path.rstrip('/')}/{_MARK}{number}")
    return touched
