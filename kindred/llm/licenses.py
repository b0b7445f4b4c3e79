"""License scans by diagonal voting, with DataFrame operations only.

Every run of ``K`` words of every text is hashed and joined with the template positions that have
the same hash. A hit votes for the diagonal text position minus template position: a passage that
follows a template puts its hits on one diagonal, and a word put in or left out moves the rest to a
neighbouring one. Votes are summed per diagonal, neighbouring diagonals merged, and a span counts
when enough of the template's runs were met, word for word, within a span of about its length. Where
neighbours chain on beyond that length, since the text goes on with words of the template, every
diagonal of the chain is verified by itself and with those as near as the length allows, and the best of
a neighbourhood counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

K = 2
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_FINE = 1 << 30  # more than the square of any template's drift
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """``words``: lower-cased words, at least ``K``. An exact template counts only word for word."""

    label: str
    words: str
    exact: bool = False


# The base phrases and their labels.
BASE_PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
# Sentences by which texts name their licence.
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
)


def template_runs(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(``template``, ``label``, ``exact``, ``runs``, ``place``, ``run``, ``hash``): the runs of the templates."""
    rows = []
    for number, template in enumerate(templates):
        words = template.words.split()
        if len(words) < K:
            raise ValueError(f"a template needs {K} words at least: {template}")
        rows += [
            (number, template.label, template.exact, len(words) - K + 1, i, words[i : i + K])
            for i in range(len(words) - K + 1)
        ]
    table = spark.createDataFrame(
        rows, "template int, label string, exact boolean, runs int, place int, run array<string>"
    )
    return table.withColumn("hash", F.xxhash64(*[F.col("run")[i] for i in range(K)]))


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = BASE_PHRASES + NOTICES,
    id_col: str = "doc_id",
    text: str = "text",
    least_share: float = 0.75,
    reach: int = 2,
) -> DataFrame:
    """(``id_col``, ``n_words``, ``spans``) for every row of ``docs``; other columns are not read.

    ``spans`` holds (label, exact, start, end, share), ordered: where a template was met, as word
    numbers from 0, end exclusive, and the share of its runs found. An exact template needs all its
    runs on one diagonal. Others need ``least_share`` of them on diagonals that follow each other by
    at most ``reach``, within a span of at most one and a half times the template plus ``reach``. Of a
    longer chain, runs of diagonals that fit within that span count by themselves: the one that meets most
    of the template (a single diagonal before several, the first before later ones) of all that begin as near.
    A null or empty text has no words and no spans. Rows alike in id and text are judged once and
    come back as often as they are given; a null id is an id of its own; an empty table stays empty.
    The templates are broadcast; their size is that of the list given.
    """
    spark = docs.sparkSession
    content = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    words = docs.select(
        docs[f"`{id_col}`"].alias("id"),
        F.xxhash64(content).alias("version"),
        F.regexp_extract_all(F.translate(content, UPPER, LOWER), F.lit(WORD), F.lit(0)).alias("words"),
    ).select("id", "version", F.size("words").alias("n"), _runs("words").alias("runs"))
    # One row per word, whose run begins there; a text without words has one row without a run.
    placed = words.select("id", "version", "n", F.posexplode_outer("runs").alias("pos", "run"))
    placed = placed.select("id", "version", "n", "pos", *[F.col("run")[f"w{i}"].alias(f"w{i}") for i in range(K)])
    places = template_runs(spark, templates).withColumnRenamed("runs", "of")
    same = F.xxhash64(*[F.col(f"w{i}") for i in range(K)]) == F.col("hash")
    for i in range(K):
        same &= F.col(f"w{i}") == F.col("run")[i]
    last = F.coalesce(F.col("pos") == F.col("n") - 1, F.lit(True))  # never a hit: its run is too short
    hits = (
        placed.join(F.broadcast(places), same, "left")
        .filter(last | F.col("template").isNotNull())
        .select("id", "version", "n", "pos", "template", "label", "exact", "of", "place")
        .repartition("id", "version")
    )
    # From here on everything is keyed by the text, so nothing is moved again.
    text_key = ["id", "version"]
    diagonals = hits.groupBy(*text_key, "n", "template", "label", "exact", "of", (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("pos").alias("low"),
        F.max("pos").alias("high"),
        F.collect_set("place").alias("met"),
    )
    along = Window.partitionBy(*text_key, "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > reach) | (
        F.greatest(F.col("low"), F.lag("low").over(along)) - F.least(F.col("high"), F.lag("high").over(along))
        > F.col("of") + reach
    )
    grouped = diagonals.withColumn("apart", F.coalesce(apart | F.col("exact"), F.lit(True))).withColumn(
        "cluster", F.sum(F.col("apart").cast("int")).over(along)
    )
    # The diagonals from each one on that fit into the longest span, wherever their hits lie in it.
    length = F.col("of") + K - 1
    drift = F.floor(length * 0.5).cast("int") + reach
    scaled = F.col("diagonal").cast("long") * F.floor(F.lit(_FINE) / drift)  # so that one frame fits all templates
    chain = Window.partitionBy(*text_key, "template", "cluster").orderBy(scaled)
    onward = chain.rangeBetween(0, _FINE)
    met_from = F.size(F.array_distinct(F.flatten(F.collect_list("met").over(onward))))
    alone = F.size("met") >= met_from
    windowed = grouped.withColumn("best", F.struct(
        F.greatest(F.size("met"), met_from).alias("met"), alone.cast("int").alias("alone"), (-F.col("diagonal")).alias("first"),
        F.when(alone, F.col("low")).otherwise(F.min("low").over(onward)).alias("start"),
        (F.when(alone, F.col("high")).otherwise(F.max("high").over(onward)) + K).alias("end"),
    ))
    leads = F.col("best") == F.max("best").over(chain.rangeBetween(-_FINE, _FINE))
    enough = F.col("best.met") / F.col("of") >= least_share

    def span(met, start, end):
        return F.struct(
            "label", "exact", start.cast("long").alias("start"), end.cast("long").alias("end"), (met / F.col("of")).alias("share")
        )

    merged = windowed.withColumn("leads", leads).groupBy(*text_key, "n", "template", "label", "exact", "of", "cluster").agg(
        F.sum("rows").alias("rows"),
        F.min("low").alias("start"),
        (F.max("high") + K).alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("met")))).alias("met"),
        F.collect_list(F.when(F.col("leads") & enough, span(F.col("best.met"), F.col("best.start"), F.col("best.end")))).alias("parts"),
    )
    fits = F.col("end") - F.col("start") <= length * 1.5 + reach
    whole = F.array(span(F.col("met"), F.col("start"), F.col("end")))
    spans = F.when(F.col("exact"), F.when(F.col("met") == F.col("of"), whole)).otherwise(
        F.when(fits, F.when(F.col("met") / F.col("of") >= least_share, whole)).otherwise(F.col("parts"))
    )
    per_text = merged.groupBy(*text_key, "n").agg(
        F.sum(F.when(F.col("template").isNull(), F.col("rows"))).alias("copies"),
        F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"),
    )
    return per_text.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"), "spans",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def _runs(words: str):
    """The words, each with the ``K - 1`` that follow."""
    parts = [F.col(words).alias("w0")]
    for i in range(1, K):
        rest = F.slice(words, F.lit(i + 1), F.greatest(F.size(words) - i, F.lit(0)))
        parts.append(rest.alias(f"w{i}"))
    return F.arrays_zip(*parts)
