"""An inverted-list index for similar content: look at the nearest lists of vectors, not at all.

Coarse centroids are fitted on a bounded sample; every vector is kept in the list of its nearest
centroid. A search looks through the lists whose centroids are nearest to the origin and compares the
vectors themselves, so what it returns is exact but for what lies in lists it did not look at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.operators.nearest import HELD_ROWS, Held, meet_in_cells
from kindred.operators.recommend import best_matches, findable, vectors_of
from kindred.schema import KINDS
from kindred.session import shuffle_partitions
from kindred.sinks.zones import write_zone

SAMPLE_ROWS = 20_000
ROWS_PER_CENTROID = 16  # of the sample, at least
CALIBRATION_ORIGINS = 200
_ROUNDS = 10
# Cosines to centroids, and rows to be sent on, that a task has in memory at a time; rows that make a cell worth a task.
_NUMBERS_AT_ONCE = 1 << 20
_ROWS_AT_ONCE = 4096
_LEAST_CELL = 16_384


@dataclass(frozen=True)
class VectorIndex:
    """``path`` holds (list, content_id, type, title, embedding), ordered by list. ``sizes`` is the number of rows in
    each list, ``probes`` how many lists a search looks through by default, ``recall`` what that gave on the sample."""

    path: str
    centroids: np.ndarray
    sizes: tuple[int, ...]
    probes: int
    recall: float


def _units(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def fit_centroids(vectors: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """``n`` directions (fewer if there are fewer vectors) by k-means under the cosine."""
    draw = np.random.default_rng(seed)
    rows = _units(vectors)
    centroids = rows[draw.choice(len(rows), min(n, len(rows)), replace=False)].copy()
    for _ in range(_ROUNDS):
        sim = rows @ centroids.T
        own = sim.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centroids)) == 0)
        if len(empty):  # starts anew from the vectors that are worst served
            sums[empty] = rows[np.argsort(sim[np.arange(len(rows)), own], kind="stable")[: len(empty)]]
        centroids = _units(sums)
    return centroids


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, probes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows, a few at a time, with the numbers of the ``probes`` nearest centroids of each, nearest first."""
    step = max(1, _NUMBERS_AT_ONCE // len(centroids))
    for batch in batches:
        for at in range(0, len(batch), step):
            rows = batch.slice(at, step)
            sim = _vectors(rows.column("embedding")) @ centroids.T
            np.negative(sim, out=sim)
            near = sim.argmin(axis=1)[:, None] if probes == 1 else np.argsort(sim, axis=1, kind="stable")[:, :probes]
            yield rows, near.astype(np.int32)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _lists(df: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``df`` with ``lists``, the numbers of the ``probes`` nearest centroids of its embedding, nearest first."""
    shared = df.sparkSession.sparkContext.broadcast(centroids)  # SAMPLE_ROWS / ROWS_PER_CENTROID vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, near in _slices(batches, shared.value, probes):
            offsets = np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "lists"])

    return df.mapInArrow(run, f"{_columns(df)}, lists array<int>")


def _laid_out(sizes: tuple[int, ...], cell_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each list its first cell and its number of cells, and the number of all cells. Lists share a cell as long as
    it has at most ``cell_rows``; a larger list has cells of its own."""
    start, chunks, cell, filled = [], [], 0, 0
    for n in sizes:
        many = max(1, -(-n // cell_rows))
        if filled and filled + n > cell_rows:
            cell, filled = cell + 1, 0
        start.append(cell)
        chunks.append(many)
        if many > 1:
            cell, filled = cell + many, 0
        else:
            filled += n
    return np.array(start, np.int32), np.array(chunks, np.int32), int(max(a + b for a, b in zip(start, chunks)))


def _to_cells(df: DataFrame, centroids: np.ndarray, probes: int, start: np.ndarray, chunks: np.ndarray) -> DataFrame:
    """A row of ``df`` per ``cell`` that has one of its ``probes`` nearest lists, with its ``lists`` in that cell."""
    shared = df.sparkSession.sparkContext.broadcast((centroids, start, chunks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles, first, many = shared.value
        for rows, near in _slices(batches, middles, probes):
            lists, owner = near.ravel(), np.repeat(np.arange(len(near)), near.shape[1])
            times = many[lists]
            lists, owner = np.repeat(lists, times), np.repeat(owner, times)
            turn = np.arange(len(lists)) - np.repeat(np.cumsum(times) - times, times)
            cell = (first[lists] + turn).astype(np.int32)
            order = np.lexsort((lists, cell, owner))
            lists, owner, cell = lists[order], owner[order], cell[order]
            begins = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (cell[1:] != cell[:-1])])
            ends = pa.array(np.r_[begins, len(lists)].astype(np.int32))
            its = pa.ListArray.from_arrays(ends, pa.array(lists))
            for at in range(0, len(begins), _ROWS_AT_ONCE):
                some = slice(at, at + _ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [*rows.take(pa.array(owner[begins[some]])).columns, pa.array(cell[begins[some]]), its[some]],
                    names=[*rows.schema.names, "cell", "lists"],
                )

    return df.mapInArrow(run, f"{_columns(df)}, cell int, lists array<int>")


def _calibrate(sample: pd.DataFrame, centroids: np.ndarray, k: int, target: float) -> tuple[int, float]:
    """The fewest lists that give ``target`` of the ``k`` nearest of each kind, within the sample."""
    asked = sample.head(CALIBRATION_ORIGINS).rename(columns={"content_id": "origin_id", "type": "origin_type"})
    place = {key: i for i, key in enumerate(zip(sample["content_id"], sample["type"]))}
    tables = list(Held(pa.Table.from_pandas(sample, preserve_index=False)).best(pa.Table.from_pandas(asked, preserve_index=False), k))
    if not tables:
        return len(centroids), 1.0
    exact = pa.concat_tables(tables).to_pandas()
    vectors = np.stack(sample["embedding"].to_numpy()).astype(np.float64)
    own = (vectors @ centroids.T).argmax(axis=1)
    order = np.argsort(-(np.stack(asked["embedding"].to_numpy()).astype(np.float64) @ centroids.T), axis=1, kind="stable")
    turn = np.empty_like(order)  # at which turn an origin comes to a list
    np.put_along_axis(turn, order, np.arange(order.shape[1])[None, :], axis=1)
    origin = {key: i for i, key in enumerate(zip(asked["origin_id"], asked["origin_type"]))}
    turns = np.array([
        turn[origin[o, ot], own[place[c, ct]]]
        for o, ot, c, ct in zip(exact["origin_id"], exact["origin_type"], exact["content_id"], exact["type"])
    ], np.int64)
    if not len(turns):
        return len(centroids), 1.0
    reached = np.cumsum(np.bincount(turns, minlength=len(centroids))) / len(turns)
    probes = int(np.searchsorted(reached, target)) + 1
    return min(probes, len(centroids)), float(reached[min(probes, len(centroids)) - 1])


def build_index(
    nodes: DataFrame,
    path: str,
    kinds: tuple[str, ...] = KINDS,
    lists: int | None = None,
    recall: float = 0.97,
    k: int = 8,
    sample_rows: int = SAMPLE_ROWS,
) -> VectorIndex:
    """Write the index of all findable ``nodes`` (content_id, type, title, embedding; one row per id and type).

    At most ``sample_rows`` rows, those of the smallest hashes, are brought to the driver: centroids are fitted on
    them and the number of probes is set so that ``recall`` of their ``k`` nearest of each kind is reached among
    them. Every row is assigned. ``lists`` is the square root of the number of rows where it is not given, but
    at most a 16th of the sample. Rows are written in the order of their lists, so that a search of a few
    lists reads only their row groups; a large list lies in many files. Vectors of length 0 are left out.
    """
    pool = findable(nodes, kinds).withColumn("embedding", F.col("embedding").cast("array<double>")).filter(
        F.exists("embedding", lambda x: x != 0)
    )
    order = F.xxhash64("content_id", "type")
    sample = pool.withColumn("h", order).orderBy("h", "content_id", "type").limit(sample_rows).drop("h").toPandas()
    if not len(sample):
        write_zone(pool.select(F.lit(0).alias("list"), "*"), path)
        return VectorIndex(path, np.zeros((0, 0)), (), 0, 1.0)
    number = lists or int(pool.count() ** 0.5)
    number = max(1, min(number, len(sample) // ROWS_PER_CENTROID or 1))
    centroids = fit_centroids(np.stack(sample["embedding"].to_numpy()), number)
    probes, reached = _calibrate(sample, centroids, k, recall)
    kept = _lists(pool, centroids, 1).select(F.col("lists")[0].alias("list"), "content_id", "type", "title", "embedding")
    ordered = kept.withColumn("h", order).repartitionByRange("list", "h").sortWithinPartitions("list", "h").drop("h")
    write_zone(ordered, path)
    stored = nodes.sparkSession.read.parquet(path)
    counts = {r["list"]: r["count"] for r in stored.groupBy("list").count().collect()}  # a row per centroid
    return VectorIndex(path, centroids, tuple(counts.get(i, 0) for i in range(len(centroids))), probes, reached)


def search_index(
    index: VectorIndex,
    nodes: DataFrame,
    origins: DataFrame,
    kinds: tuple[str, ...] = KINDS,
    k: int = 8,
    probes: int | None = None,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """The rows of ``similar_content``, found in the ``probes`` nearest lists of each origin: exactly those with
    as many probes as there are lists, otherwise some neighbours may be missed and others stand for them.

    Lists are laid out in cells of at most about ``held_rows``, several lists in one, and a list that holds a third of
    all vectors in many. An origin goes once to each cell with a list that it looks through, so that what is moved
    grows with origins times cells, not lists. Only lists that are looked through are read.
    """
    spark: SparkSession = nodes.sparkSession
    asked = vectors_of(nodes, origins).withColumn("embedding", F.col("embedding").cast("array<double>"))
    asked = asked.filter(F.exists("embedding", lambda x: x != 0))
    stored = spark.read.parquet(index.path).filter(F.col("type").isin(*kinds))
    if not index.sizes:
        return best_matches(meet_in_cells(stored.withColumn("cell", F.lit(0)), asked.withColumn("cell", F.lit(0)), 1, k), k)
    probes = min(probes or index.probes, len(index.sizes))
    share = -(-sum(index.sizes) // shuffle_partitions(spark))
    start, chunks, cells = _laid_out(index.sizes, min(held_rows, max(_LEAST_CELL, share)))
    plan = spark.createDataFrame(
        [(i, int(start[i]), int(chunks[i])) for i in range(len(chunks))], "list int, start int, chunks int"
    )
    if probes < len(index.sizes):
        near = _lists(asked, index.centroids, probes).select(F.explode("lists").alias("list"))
        stored = stored.filter(F.col("list").isin(sorted(r["list"] for r in near.distinct().collect())))  # no more than there are lists
    chunk = F.pmod(F.xxhash64("content_id", "type", "title"), F.col("chunks")).cast("int")
    held = stored.join(F.broadcast(plan), "list").withColumn("cell", F.col("start") + chunk)
    return best_matches(meet_in_cells(held, _to_cells(asked, index.centroids, probes, start, chunks), cells, k), k)


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (``origins``, ``wanted``, ``recall``): the share of the rows of ``exact`` that are in ``found``."""
    key = ["origin_id", "origin_type", "type", "content_id"]
    both = exact.select(*key).join(found.select(*key, F.lit(1.0).alias("met")), key, "left")
    return both.agg(
        F.count_distinct("origin_id", "origin_type").alias("origins"), F.count(F.lit(1)).alias("wanted"),
        F.coalesce(F.avg(F.coalesce("met", F.lit(0.0))), F.lit(1.0)).alias("recall"),
    )
