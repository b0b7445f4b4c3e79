"""Title lookup for a table of texts: posting lists of letter triples, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kindred.operators.topk import top_per_group

GRAM = 3


def _grams(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text that has as many."""
    places = F.sequence(F.lit(1), F.length(text) - n + 1)
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(n))))


def _postings(texts: DataFrame, column: str, n: int) -> DataFrame:
    """(``gram``, the columns of ``texts``) for the runs of ``n`` characters of a column."""
    long = texts.filter(F.length(column) >= n)
    return long.select(F.explode(_grams(F.col(column), n)).alias("gram"), "*")


def find_contents(content: DataFrame, texts: DataFrame, text: str = "text", kind: str | None = None) -> DataFrame:
    """``find_content`` for every row of a table: ``texts`` with the columns ``content_id``, ``type``, ``title`` of the
    content whose title contains the text, ignoring case (the shortest title, then by title, id and type). Texts
    that no title contains, and null ones, give no row. ``kind`` names a column of ``texts`` with the wanted
    type; where it is null, or without one, any type will do.

    Texts and titles meet by the text's rarest triple of letters: a title that contains the text has all of its
    triples, so the shortest posting list is enough, and the exact test follows. Texts of two letters or one meet
    titles by their pairs or letters; the empty text is in every title, so it takes the first title of all.
    Each distinct text is looked up once; titles are read once per length of gram, not once per text.
    """
    lowered = F.lower(F.col(text))
    wanted = F.col(kind) if kind is not None else F.lit(None).cast("string")
    asked = texts.filter(F.col(text).isNotNull()).select(lowered.alias("asked"), wanted.alias("kind")).distinct()
    titles = content.filter("content_id IS NOT NULL AND title IS NOT NULL").groupBy("title", "type").agg(
        F.min("content_id").alias("content_id")
    ).withColumn("name", F.lower("title"))

    met = None
    for n in range(GRAM, 0, -1):
        mine = asked.filter(F.length("asked") >= n if n == GRAM else F.length("asked") == n)
        grams = _postings(mine, "asked", n)
        listed = _postings(titles, "name", n).join(grams.select("gram").distinct(), "gram", "left_semi")
        sizes = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
        # A gram that no title has is the rarest there is; its text finds nothing.
        rarest = grams.join(sizes, "gram", "left").groupBy("asked", "kind").agg(
            F.min(F.struct(F.coalesce("size", F.lit(0)).alias("size"), "gram")).alias("least")
        ).select("asked", "kind", "least.gram")
        found = listed.join(rarest, "gram").filter(F.contains("name", "asked")).drop("gram")
        met = found if met is None else met.unionByName(found)
    columns = ["asked", "kind", "content_id", "type", "title"]
    met = met.filter(F.col("kind").isNull() | (F.col("kind") == F.col("type"))).select(*columns)
    order = [F.length("title"), "title", "content_id", "type"]
    # The first title of each type, and of these the first one, serve the empty text.
    per_type = top_per_group(titles, ["type"], order, 1)
    empty = asked.filter("asked = ''").join(per_type, F.col("kind").isNull() | F.col("kind").eqNullSafe(F.col("type")))
    best = top_per_group(met.unionByName(empty.select(*columns)), ["asked", "kind"], order, 1).drop("rank")
    found = best.select(*[F.col(c).alias(f"__{c}") for c in best.columns])
    kept = texts.select(*[c for c in texts.columns if c.lower() not in ("content_id", "type", "title")])
    same = (F.lower(F.col(text)) == F.col("__asked")) & wanted.eqNullSafe(F.col("__kind"))
    named = [F.col(f"__{c}").alias(c) for c in ("content_id", "type", "title")]
    return kept.join(found, same).select(*kept.columns, *named)
