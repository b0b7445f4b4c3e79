"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into ``BLOCKS`` blocks. Two that differ in at most ``distance`` bits agree in at
least ``BLOCKS - distance`` of them, whichever those are, so every such pair meets under one of the
choices of that many blocks. Fingerprints are joined on the blocks of each choice, and the Hamming
distance decides. Equal fingerprints are one from the start, so copies never make pairs.

Where many fingerprints share blocks, they are dealt into chunks, and each pair of chunks is a task's
work of its own. Of the links found there, only those that connect what is not yet connected are
kept: their number grows with the fingerprints, not with the pairs.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, MapType, StructField, VariantType

from kindred.llm.buffers import add_columns, fresh_name, utf8
from kindred.llm.components import connected_components
from kindred.session import checkpoint

BITS, BLOCKS = 64, 6
SEED = 42
CHUNK = 1024
VOTES = 1 << 16  # shingles whose bits are added up at a time


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """Bit b is set where over half of the shingles' hashes have it. Words are runs without ASCII
    white space, A-Z lower-cased; a text with fewer words than a shingle is one; none gives 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = min(words_per_shingle, len(words)) - 1
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - last
    for low in range(0, n, VOTES):
        high = min(n, low + VOTES)
        some = [digest(line[a : b - 1], SEED) for a, b in zip(starts[low:high], ends[low + last : high + last], strict=True)]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def add_fingerprint(
    docs: DataFrame, text: str = "text", words_per_shingle: int = 3, name: str = "fingerprint", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with the fingerprint of the text as a signed long; that of a null or empty text is 0."""
    def compute(column):
        data, offsets = utf8(column)
        raw = memoryview(np.ascontiguousarray(data))
        prints = [fingerprint(bytes(raw[a:b]), words_per_shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return [pa.array(np.array(prints, np.uint64).view(np.int64))]

    return add_columns(docs, text, [StructField(name, LongType())], compute, keep)


def _block_keys(value: Column, agreeing: int) -> Column:
    """One key per choice of ``agreeing`` blocks: a hash of the choice and the bits of its blocks."""
    edges = [round(BITS * i / BLOCKS) for i in range(BLOCKS + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    keys = []
    for number, chosen in enumerate(combinations(masks, agreeing)):
        mask = reduce(int.__or__, chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.xxhash64(F.lit(number), value.bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def _links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect the given fingerprints as all links between them would."""
    rest, found = prints, []
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = np.bitwise_count(rest ^ one) <= distance
            if near.any():
                found += [(one, other) for other in rest[near]]
                reached += list(rest[near])
                rest = rest[~near]
    return found


def near_links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (``a``, ``b``) between the distinct longs of ``print``, within ``distance`` bits; enough
    of them to connect all that any such links connect, each at most once."""
    if not 0 <= distance < BLOCKS:
        raise ValueError(f"the distance must be below the number of blocks, {BLOCKS}")
    keyed = prints.select("print", F.explode(_block_keys(F.col("print"), BLOCKS - distance)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64(F.lit("chunk"), "print"), chunks).cast("int")
    # A chunk meets itself and every other one: a cell per pair.
    cells = (
        keyed.join(shared, "key")
        .select("print", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .groupBy("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.collect_list("print").alias("prints"))
        .filter("size(prints) > 1")
        .select("prints")
    )

    def compare(batches):
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            found = {link for a, b in zip(at[:-1], at[1:], strict=True) for link in _links(np.sort(values[a:b]), distance)}
            pairs = np.array(sorted((min(x), max(x)) for x in found), np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return cells.mapInArrow(compare, "a long, b long").distinct()


def linked_classes(rows: DataFrame, distance: int) -> DataFrame:
    """(``print``, ``root``): the distinct fingerprints of ``rows``; linked ones have the same root."""
    prints = checkpoint(rows.select("print").distinct())
    roots = connected_components(near_links(prints, distance)).withColumnRenamed("node", "print")
    return prints.join(roots, "print", "left").select("print", F.coalesce("root", "print").alias("root"))


def near_duplicates(
    docs: DataFrame, distance: int = 3, words_per_shingle: int = 3, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(``id_col``, ``fingerprint``, ``component_id``) for every row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``distance`` bits; texts without words,
    null ones among them, all have fingerprint 0. ``component_id`` is the smallest id that links lead
    to, null only where all of those are null. Repeated rows come back as often as they are given; an
    empty table gives an empty one. Columns other than the two are not read.
    """
    source = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].alias("text"))
    rows = checkpoint(add_fingerprint(source, "text", words_per_shingle, "print", ["id"]))
    classes = linked_classes(rows, distance)
    first = rows.groupBy("print").agg(F.min("id").alias("id")).join(classes, "print")
    least = first.groupBy("root").agg(F.min("id").alias("component"))
    members = classes.join(least, "root").select("print", "component")
    return rows.join(members, "print").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_first(
    docs: DataFrame, distance: int = 3, words_per_shingle: int = 3, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` of each group of linked texts, with all its columns: that with the smallest
    id, null last.

    Of rows with that id the text with the smallest hash stays, and of rows alike in id and text the
    first by their other columns. Links are those of ``near_duplicates``; an empty table stays empty.
    """
    key = F.xxhash64(docs[f"`{id_col}`"], docs[f"`{text}`"])
    source = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].alias("text"), key.alias("key"))
    rows = checkpoint(add_fingerprint(source, "text", words_per_shingle, "print", ["id", "key"]))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = rows.groupBy("print").agg(F.min(order).alias("one")).join(linked_classes(rows, distance), "print")
    kept, number = fresh_name(docs.columns, "key"), fresh_name(docs.columns, "number")
    chosen = first.groupBy("root").agg(F.min("one").alias("one")).select(F.col("one")["key"].alias(kept))
    others = [f"`{f.name}`" for f in docs.schema if f.name != text and not isinstance(f.dataType, (MapType, VariantType))]
    alike = Window.partitionBy(kept).orderBy(*others)
    return (
        docs.withColumn(kept, key).join(chosen, kept, "left_semi")
        .withColumn(number, F.row_number().over(alike)).filter(F.col(number) == 1).drop(kept, number)
    )
