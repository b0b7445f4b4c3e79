"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words the one that is not longer contributes two disjoint chunks, its halves; the other one its
positional grams of the same lengths. One edit falls into one half and leaves the other whole, at its
place or one further, so the words meet on that chunk. What lies beside the chunk is again two halves of
which one stays whole: it joins the key, so that frequent chunks (endings, first syllables) don't gather
large groups. What meets is verified. Nothing is left out, and no group's pairs are written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kindred.session import checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"
# A form is met at least ten times as often as its word, and counts are below 2**63: no chain is longer.
CHAIN_DOUBLINGS = 5


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    least_chars: int = 7,
    least_n: int = 2,
    misspell_every: int | None = None,
) -> DataFrame:
    """(``word``, ``n``): the runs of letters of all texts, A-Z lowered, and how often each occurs.

    With ``misspell_every`` a run whose crc32 of ``id:run`` it divides loses one code point first, a test
    of the grouping. Words shorter than ``least_chars`` or met fewer than ``least_n`` times are left out.
    Null texts have no words, a null id reads as empty; repeated rows count each time.
    """
    # A run can only get shorter, so shorter ones are not even cut out.
    runs = F.regexp_extract_all(docs[f"`{text}`"].cast("string"), F.lit(f"([{LETTERS}]{{{least_chars},}})"), F.lit(1))
    ident = F.coalesce(docs[f"`{id_col}`"].cast("string"), F.lit(""))
    met = docs.select(ident.alias("id"), F.explode(runs).alias("run")).withColumn(
        "run", F.translate("run", UPPER, LOWER)
    )
    word = F.col("run")
    if misspell_every:
        met = met.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
        word = F.when(F.col("h") % misspell_every == 0, shorter).otherwise(word)
    words = met.select(word.alias("word")).filter(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def _without(word: Column, length: Column, first: Column, after: Column) -> Column:
    """``word`` without its characters ``first`` to ``after``, as two pieces."""
    head = F.substring(word, F.lit(1), first)
    return F.concat(head, F.lit("|"), F.substring(word, after + 1, length))


def _quarters(length: Column) -> list[tuple[Column, Column]]:
    """The four pieces of a word of this length: its halves, halved."""
    whole = lambda c: F.floor(c).cast("int")
    half = whole(length / 2)
    edges = [F.lit(0), whole(half / 2), half, half + whole((length - half) / 2), length]
    return list(zip(edges, edges[1:]))


def near_pairs(words: DataFrame) -> DataFrame:
    """(``a``, ``b``): the pairs of distinct ``words`` that differ by one inserted, deleted or replaced code
    point, each once; ``b`` is longer, or as long and greater. ``words`` are distinct and not null.

    A word of length l gives four keys as chunks: l, and the word without one of its quarters (a half and
    a quarter beside it). As grams, it gives those that a word of its length or one shorter would
    give, read from the places where an edit leaves them: those behind the edit are moved by the
    difference in length, zero or one.
    """
    length = F.length("word")
    spaced = words.select("word", length.alias("l"))

    def keys(chunk_length: Column, moved: Column) -> Column:
        return F.array(*[
            F.xxhash64(chunk_length, F.lit(i), _without(F.col("word"), F.col("l"), first, after + moved))
            for i, (first, after) in enumerate(_quarters(chunk_length))
        ])

    chunks = spaced.select(F.col("word").alias("a"), F.explode(keys(F.col("l"), F.lit(0))).alias("key"))
    shorter = F.when(F.col("l") > 1, keys(F.col("l") - 1, F.lit(1))).otherwise(F.array().cast("array<bigint>"))
    grams = spaced.select(
        F.col("word").alias("b"), F.explode(F.concat(keys(F.col("l"), F.lit(0)), shorter)).alias("key")
    )
    met = chunks.join(grams, "key").filter((F.length("b") > F.length("a")) | (F.col("b") > F.col("a")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``) for every row of ``words`` (``word``, ``n``).

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order) if that is at least
    ``ratio`` times the word's own; else null, and ``form_n`` too. ``root`` is what following forms ends
    at, the word itself without one. ``ratio`` must be 10 or more: counts then bound the chains.

    Words are one row each, without nulls, as ``word_counts`` gives them; other columns are not read, and
    no words give no rows.
    """
    if ratio < 10:
        raise ValueError("a form must be at least ten times as frequent as its word")
    words = checkpoint(words.select("word", "n"))
    pairs = checkpoint(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    # The largest count first, then the smallest word.
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")))
    found = counted.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    near = words.join(found.withColumnRenamed("a", "word"), "word", "left")
    holds = -F.col("best.less") >= ratio * F.col("n")
    formed = checkpoint(near.select(
        "word", F.when(holds, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(holds, -F.col("best.less")).alias("form_n"),
    ))
    # Every round doubles the way that a word has followed; words without a form stay out of it.
    steps = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(CHAIN_DOUBLINGS):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = checkpoint(steps.join(onward, "root", "left"))
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter("further IS NOT NULL").isEmpty():
            break
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
