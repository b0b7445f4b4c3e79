"""Entries of large JSON files: one object or list per file, read by as many tasks as the file has splits.

The file is read as text that ends at commas, which Spark splits by byte ranges like any other. Whether a split
begins inside a string, and how deep, follows from all splits before it. So a first pass sums up every split
for both beginnings (quotes met, brackets opened less closed), the sums are added up per file, a row per split, and a
second pass cuts at the commas that part top-level entries. What lies across splits is put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kindred.session import scratch_path

_SUMS = "file string, start bigint, quotes int, outside bigint, inside bigint"
_PARTS = "file string, start bigint, ordinal bigint, piece string, text string"
_WHOLE, _HEAD, _TAIL = "whole", "head", "tail"
_QUOTE, _ESCAPE, _COMMA = b'"\\,'
_STEP = np.zeros(256, np.int64)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def _strings(data: np.ndarray) -> tuple[np.ndarray, int]:
    """For every byte whether an odd number of quotes lies before or at it, and how many there are."""
    quotes = np.flatnonzero(data == _QUOTE)
    if len(quotes):
        plain = np.where(data != _ESCAPE, np.arange(len(data)), -1)
        last = np.maximum.accumulate(plain)
        before = np.where(quotes > 0, last[quotes - 1], -1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]  # not escaped
    marks = np.zeros(len(data), np.int64)
    marks[quotes] = 1
    return np.cumsum(marks) % 2 == 1, len(quotes)


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, np.ndarray]]:
    """The bytes of successive rows with equal values of ``columns``, a comma behind each row."""
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in columns])
        texts = batch.column("value").to_pylist()
        for key, rows in groupby(zip(keys, texts), key=lambda row: row[0]):
            data = ("".join(f"{text}," for _, text in rows)).encode()
            yield key, np.frombuffer(data, np.uint8)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(key, quotes, deltas):
        values = [[key[0]], [key[1]], [quotes], [deltas[0]], [deltas[1]]]
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in _SUMS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    at, parity, deltas = None, 0, [0, 0]
    for key, data in _runs(batches, "file", "start"):
        if key != at:
            if at is not None:
                yield row(at, parity, deltas)
            at, parity, deltas = key, 0, [0, 0]
        odd, quotes = _strings(data)
        steps = _STEP[data]
        for begins in (0, 1):  # outside of a string, inside of one
            deltas[begins] += int(steps[odd == bool(begins ^ parity)].sum())
        parity ^= quotes % 2
    if at is not None:
        yield row(at, parity, deltas)


def _cut(pieces_only: bool):
    """Entries that lie whole in a split, or only what lies before its first cut and behind its last one."""
    def batch(key, rows):
        n = len(rows)
        columns = [
            pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PARTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, depth, ordinal, open_ = None, False, 0, 0, []

        def rest():
            return [(ordinal, _TAIL if ordinal else _HEAD, b"".join(open_).decode())] if pieces_only else []

        for key, data in _runs(batches, "file", "start", "within", "depth"):
            if key != at:
                if at is not None and (left := rest()):
                    yield batch(at, left)
                at, inside, depth, ordinal, open_ = key, bool(key[2]), key[3], 0, []
            odd, quotes = _strings(data)
            within = odd ^ inside
            deep = depth + np.cumsum(np.where(within, 0, _STEP[data]))
            cuts = np.flatnonzero((data == _COMMA) & ~within & (deep == 1))
            rows, low = [], 0
            for cut in cuts.tolist():
                text = b"".join([*open_, data[low:cut].tobytes()])
                if (ordinal == 0) == pieces_only:
                    rows.append((ordinal, _WHOLE if ordinal else _HEAD, text.decode()))
                ordinal, open_, low = ordinal + 1, [], cut + 1
            open_.append(data[low:].tobytes())
            inside, depth = inside ^ bool(quotes % 2), int(deep[-1])
            if rows:
                yield batch(at, rows)
        if at is not None and (left := rest()):
            yield batch(at, left)

    return run


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """(``value``, ``place``) of every top-level entry of files that hold one JSON object or list each.

    ``value`` is the text of the entry: ``"key": …`` of an object, an element of a list. ``place`` orders them by file
    name and as listed. A split is as large as ``spark.sql.files.maxPartitionBytes`` says; a task holds one batch of
    rows and one entry. Files that are not JSON give texts that do not parse; empty lists and objects give nothing.
    """
    text = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("row"),
    )
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = text.select("file", "start", "value").mapInArrow(_sum_up, _SUMS)
    begins = sums.withColumn("within", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    delta = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    begins = begins.withColumn("depth", F.coalesce(F.sum(delta).over(before), F.lit(0)).cast("bigint"))
    stored = scratch_path(spark, "splits")  # its size is known, so Spark chooses the join by it
    begins.select("file", "start", "within", "depth").write.parquet(stored)
    placed = text.join(spark.read.parquet(stored), ["file", "start"]).sortWithinPartitions("file", "start", "row").drop("row")

    whole = placed.mapInArrow(_cut(False), _PARTS).select(
        F.struct("file", "start", "ordinal").alias("place"), F.col("text").alias("value"), F.lit(False).alias("ends")
    )
    # A head goes on with what the last split before it that was cut left open: a row or two per split.
    pieces = placed.mapInArrow(_cut(True), _PARTS)
    by_place = Window.partitionBy("file").orderBy("start", "ordinal")
    opened = F.when(F.col("piece") == _TAIL, F.struct("start", "ordinal"))
    first = F.struct(F.lit(-1).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("ordinal"))
    owner = F.coalesce(F.last(opened, ignorenulls=True).over(by_place), first)
    owned = pieces.withColumn("owner", owner)
    parts = F.array_sort(F.collect_list(F.struct("start", "ordinal", "text")))
    joined = owned.groupBy("file", "owner").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("value"))
    latest = Window.partitionBy("file")
    across = joined.withColumn("ends", F.col("owner") == F.max("owner").over(latest)).select(
        F.struct("file", "owner.start", "owner.ordinal").alias("place"), "value", "ends"
    )
    # The file's own brackets are with its first and its last entry; behind it is the comma put there by the scan.
    begun = F.col("place.start") == -1
    opening = F.when(begun, F.regexp_replace("value", r"^[\s\x{FEFF}]*[\[{]", "")).otherwise(F.col("value"))
    closing = F.when(F.col("ends"), F.regexp_replace(opening, r"[\]}]\s*,?\s*$", "")).otherwise(opening)
    return whole.unionByName(across).select("place", closing.alias("value")).filter(~F.regexp_like("value", F.lit(r"^\s*$")))
