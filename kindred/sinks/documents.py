"""One text file per key, for readers of folders with very many small files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import DataFrame, Row, functions as F

# What Spark's own writer puts for a null or empty key, and what it encodes in the names of folders.
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_ENCODED = {c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}


def folder_name(key: str, value: str | None) -> str:
    """``key=value`` as ``partitionBy`` names the folder of a value."""
    return f"{key}={(value or _NO_KEY).translate(str.maketrans(_ENCODED))}"


def _writes(base: str, key: str):
    def run(rows: Iterable[Row]) -> None:
        for value, docs in groupby(rows, lambda r: r["folder"]):
            folder = f"{base}/{folder_name(key, value)}"
            os.makedirs(folder, exist_ok=True)
            # Readers pass over names that begin with a dot; a repeated task puts the same file in place.
            unfinished = f"{folder}/.{uuid.uuid4().hex}"
            with open(unfinished, "w", encoding="utf-8", newline="") as file:
                for r in docs:
                    file.write(f"{r['doc'] or ''}\n")
            os.replace(unfinished, f"{folder}/part-0.txt")
    return run


def write_documents(docs: DataFrame, path: str, key: str = "key", doc: str = "doc") -> None:
    """Write the texts ``doc`` into folders named by ``key`` below ``path``, as ``write.partitionBy(key).text(path)``
    does: a file per key, each text a line or several, null and empty keys together.

    Where ``path`` is in a file system that all executors mount, tasks write the files themselves. Spark's writer
    starts several processes per file there to set modes, and renames every file twice. Elsewhere it is Spark's
    writer that writes.
    """
    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    place = files.makeQualified(folder).toUri()
    if place.getScheme() != "file":
        docs.select(key, doc).repartition(key).write.partitionBy(key).text(path)
        return
    files.mkdirs(folder)
    named = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(_NO_KEY)).alias("folder")
    rows = docs.select(named, F.col(doc).alias("doc")).repartition("folder").sortWithinPartitions("folder")
    rows.foreachPartition(_writes(place.getPath(), key))
