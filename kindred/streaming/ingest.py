"""Incremental collection: read the files that are new since the last run and merge them by key.

A target holds a folder ``batch=<n>`` for every micro-batch and, hidden from plain reads, bases: the merged
table up to some batch. A base counts once its marker is there, an empty file made after its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.operators.nodes import one_row_per_key
from kindred.sinks.paths import exists, mark, names_in, remove
from kindred.sinks.zones import write_zone

_BASES, _READY, _BATCH = "_bases", ".ready", "batch="
_DIGITS = 20


def ingest_new_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    normalise: Callable[[DataFrame], DataFrame],
    target: str,
    schema,
    source_format: str = "parquet",
    **options: str,
) -> None:
    """Run once over all files not seen before and append them, normalised, to ``target``.

    Each micro-batch overwrites its own folder ``batch=<n>``, so one that is repeated after a
    failure leaves no second copy. ``checkpoint`` remembers the files read.
    """
    def store(batch: DataFrame, n: int) -> None:
        write_zone(normalise(batch), f"{target.rstrip('/')}/{_BATCH}{n}")

    files = spark.readStream.format(source_format).schema(schema).options(**options).load(path)
    query = (
        files.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _bases(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(last batch, folder) of the finished bases, oldest first."""
    names = [n.removesuffix(_READY) for n in names_in(spark, f"{target}/{_BASES}") if n.endswith(_READY)]
    return sorted((int(name.split("-")[0]), f"{target}/{_BASES}/{name}") for name in names)


def _batches(spark: SparkSession, target: str, after: int) -> list[int]:
    """The finished batches behind ``after``."""
    found = [int(n[len(_BATCH):]) for n in names_in(spark, target) if n.startswith(_BATCH)]
    return sorted(n for n in found if n > after and exists(spark, f"{target}/{_BATCH}{n}/_SUCCESS"))


def _versions(spark: SparkSession, target: str) -> tuple[DataFrame | None, list[int]]:
    """The newest base and the later batches as one table with a column ``batch``, and these batches. The base
    stands for its last batch."""
    bases = _bases(spark, target)
    last, base = bases[-1] if bases else (-1, None)
    newer = _batches(spark, target, last)
    parts = []
    if base is not None:
        parts.append(spark.read.parquet(base).withColumn("batch", F.lit(last)))
    if newer:
        paths = [f"{target}/{_BATCH}{n}" for n in newer]
        later = spark.read.option("basePath", target).option("mergeSchema", "true").parquet(*paths)
        parts.append(later.withColumn("batch", F.col("batch").cast("int")))
    if not parts:
        return None, []
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return whole, newer


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    single = one_row_per_key(rows, [*keys, "batch"])
    columns = [c for c in single.columns if c not in (*keys, "batch")]

    def last(c: str):
        return F.max(F.when(F.col(c).isNotNull(), F.struct("batch", c)))[c].alias(c)

    return single.groupBy(*keys).agg(*[last(c) for c in columns])


def read_ingested(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The ingested table: per key, the properties of the latest batch that set them. Of several rows
    for a key in one batch, one counts as a whole (``one_row_per_key``).

    Reads the newest base and the batches behind it; what is folded into the base is not looked at.
    """
    rows, _ = _versions(spark, target.rstrip("/"))
    if rows is None:
        raise FileNotFoundError(f"nothing ingested in {target}")
    return _latest(rows, keys)


def compact_ingested(spark: SparkSession, target: str, keys: list[str]) -> int | None:
    """Fold the newest base and all finished batches behind it into a new base; returns the last batch folded, or
    None if there was nothing to fold.

    Readers see the old base and its batches until the new base's marker is made, the last step, and the
    new base from then on; both give the same rows. A run that fails leaves a base without a marker, which
    counts for nothing, and can be repeated. Batches may go on arriving meanwhile.
    """
    target = target.rstrip("/")
    rows, newer = _versions(spark, target)
    if not newer:
        return None
    name = f"{target}/{_BASES}/{newer[-1]:0{_DIGITS}d}-{uuid.uuid4().hex}"
    write_zone(_latest(rows, keys), name, mode="errorifexists")
    mark(spark, name + _READY)
    return newer[-1]


def drop_folded(spark: SparkSession, target: str, bases: int = 2) -> list[str]:
    """Remove what no reader needs once the newest ``bases`` bases are kept: older bases, unfinished ones up to the
    oldest kept, and the batches folded into that. A reader that started before may still read the older
    ones: keep as many bases as were made while a read takes."""
    target = target.rstrip("/")
    kept = _bases(spark, target)[-bases:]
    if not kept:
        return []
    oldest, gone = kept[0][0], []
    for name in names_in(spark, f"{target}/{_BASES}"):
        folder = f"{target}/{_BASES}/{name.removesuffix(_READY)}"
        if int(name.split("-")[0]) <= oldest and folder not in {path for _, path in kept}:
            gone.append(f"{target}/{_BASES}/{name}")
    for name in names_in(spark, target):
        if name.startswith(_BATCH) and int(name[len(_BATCH):]) <= oldest:
            gone.append(f"{target}/{name}")
    for path in sorted(gone, key=lambda p: not p.endswith(_READY)):  # markers first
        remove(spark, path)
    return gone
