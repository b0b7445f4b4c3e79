"""Readers that say what they could not read: good and bad documents from one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kindred import schema as S
from kindred.sources.files import decoded
from kindred.sources.xml import collection_ratings

_BAD, _FILE, _REASON = "_bad", "_file", "_reason"


@dataclass(frozen=True)
class Checked:
    """``good`` rows, ``bad`` documents (``file``, ``reason``, ``document``) and the numbers of rows of each."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def _split(parsed: DataFrame, store: str) -> Checked:
    """Write the parsed rows once, good and bad ones apart, below ``store``, and read both back. Rows are counted
    while they are written."""
    seen = Observation("documents")
    bad = F.col(_REASON).isNotNull()
    counted = parsed.observe(
        seen, F.count(F.when(~bad, 1)).alias("good"), F.count(F.when(bad, 1)).alias("bad")
    )
    counted.withColumn("rejected", bad).write.mode("overwrite").partitionBy("rejected").parquet(store)
    back = parsed.sparkSession.read.schema(f"{_ddl(parsed)}, rejected boolean").parquet(store)
    plain = [c for c in parsed.columns if c not in (_BAD, _FILE, _REASON)]
    return Checked(
        back.filter("NOT rejected").select(F.col(_FILE).alias("file"), *plain),
        back.filter("rejected").select(
            F.col(_FILE).alias("file"), F.col(_REASON).alias("reason"), F.col(_BAD).alias("document")
        ),
        seen.get["good"], seen.get["bad"],
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _reason(text: Column, opens: str, ends: str) -> Column:
    """Why a document that did not parse is no ``opens`` … ``ends``; patterns of its first and last characters."""
    return (
        F.when(F.regexp_like(F.coalesce(text, F.lit("")), F.lit(r"^\s*$")), F.lit("empty"))
        .when(~F.regexp_like(text, F.lit(rf"(?s)^\s*{opens}")), F.lit("does not begin as expected"))
        .when(~F.regexp_like(text, F.lit(rf"(?s){ends}\s*$")), F.lit("ends too early"))
        .otherwise(F.lit("not well formed"))
    )


def read_json_checked(
    spark: SparkSession, path: str | list[str], schema: str, store: str, glob: str = "*.json"
) -> Checked:
    """Multi-line JSON documents (an object, or a list whose elements are rows) as ``read_json_multiline`` reads
    them, and those it would drop. A document is good or bad as a whole; an empty list is neither."""
    raw = (
        spark.read.schema(f"{schema}, {_BAD} string")
        .json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, pathGlobFilter=glob)
        .withColumn(_FILE, decoded(F.col("_metadata.file_path")))
    )
    return _split(raw.withColumn(_REASON, F.when(F.col(_BAD).isNotNull(), _reason(F.col(_BAD), r"[\[{]", r"[\]}]"))), store)


def read_xml_checked(
    spark: SparkSession, path: str, schema: str, store: str, root_tag: str, glob: str = "*.xml"
) -> Checked:
    """One row per file whose root is ``root_tag``, as the XML readers parse it, and the files they would drop:
    the tag-wise reader passes over those without a trace, so here whole files are parsed."""
    opened = rf"(?s)^\s*(?:<\?.*?\?>\s*|<!.*?>\s*)*<{root_tag}[\s/>]"
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(
        F.col("value"), decoded(F.col("_metadata.file_path")).alias(_FILE)
    )
    parsed = F.from_xml(
        "value", f"{schema}, {_BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    )
    rooted = F.regexp_like("value", F.lit(opened))
    read = files.select(_FILE, "value", F.when(rooted, parsed).alias("doc"))
    failed = F.col("doc").isNull() | F.col("doc")[_BAD].isNotNull()
    why = _reason(F.col("value"), opened.removeprefix(r"(?s)^\s*"), rf"(?:</{root_tag}\s*>|/>|-->)")
    fields = [c for c in read.select("doc.*").columns if c != _BAD]
    return _split(read.select(
        *[F.col("doc")[c].alias(c) for c in fields],
        F.when(failed, F.col("value")).alias(_BAD), _FILE, F.when(failed, why).alias(_REASON),
    ), store)


def read_collections_checked(
    spark: SparkSession, path: str, store: str, root_tag: str = "items", glob: str = "*.xml", key: str = r"/([^/]+)\.xml$"
) -> Checked:
    """``read_collections_xml``: the ratings of all good files, and the bad files."""
    found = read_xml_checked(spark, path, f"item array<{S.COLLECTION_ITEM}>", store, root_tag, glob)
    items = found.good.select(F.regexp_extract("file", key, 1).alias("user_id"), F.explode("item").alias("item"))
    return Checked(collection_ratings(items), found.bad, found.n_good, found.n_bad)


def read_anime_lists_checked(
    spark: SparkSession, path: str, store: str, glob: str = "*.json", key: str = r"/([^/]+)\.json$"
) -> Checked:
    """``read_anime_lists``: the entries of all good lists with their ``user_id``, and the bad lists."""
    found = read_json_checked(spark, path, S.ANIME_LIST, store, glob)
    entries = found.good.withColumn("user_id", F.regexp_extract("file", key, 1)).drop("file")
    return Checked(entries, found.bad, found.n_good, found.n_bad)
