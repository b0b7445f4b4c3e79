"""Mixing sources to target weights.

Every document gets a random key from a hash of its id and text, so that rows without an id, or with the
same one, do not share it. The keys of a source are cut into equal ranges, which are summed first: a document's place in the random order of its source is then the sum over the
ranges before its own and over the documents before it in its range. No task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kindred.session import checkpoint

WORD = "[^\\x20\\x09-\\x0D]+"
KEY_DIGITS = 13  # hex digits of a key: 52 bits
RESULT = ("size", "source_size", "target", "taken")
_NONE = "1"  # a source's name is put behind a 0, so that this sorts after all of them


def text_size(text):
    """Number of runs of characters that are not ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(``source``, ``source_size``, ``target``) from (``source``, ``source_size``), sources not null.

    Sources take the weights in turn, in the order of their code points. All together
    are to have ``share`` times what there is. A source stops at ``most`` times its size, and what is
    then left goes to the others by their weights, until none is above its limit: all others get the
    same multiple of their weight. Only sums are collected, never the sources.
    """
    if share > most:
        raise ValueError("the sources cannot have more than their limits together")
    # Sources are numbered range by range, as documents are placed.
    ranged = checkpoint(sizes.repartitionByRange("source").withColumn("part", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("source"))
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    turn = (F.col("start") + F.col("inside") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    table = checkpoint(
        ranged.withColumn("inside", inside).join(starts, "part").select("source", "source_size", weight.alias("weight"))
    )
    limit = most * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    multiple, filled = 0.0, -1
    while True:  # each round fills at least one more source, or is the last
        full = limit <= F.lit(multiple) * F.col("weight")
        got = table.agg(
            F.sum(F.when(full, F.col("source_size"))).alias("size"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if got["n"] == filled or not got["weight"]:
            break
        filled = got["n"]
        multiple = (share * total - most * (got["size"] or 0)) / got["weight"]
    target = F.least(limit, F.lit(multiple) * F.col("weight")).cast("double")
    if not total:
        target = F.lit(0.0)
    elif not got["weight"]:
        target = limit.cast("double")
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "mix",
    keep: list[str] | None = None,
) -> DataFrame:
    """(``id_col``, ``source``, ``size``, ``source_size``, ``target``, ``taken``) for every row of ``docs``; with
    ``keep`` these columns of ``docs`` instead of the first two, but for those with the names of the others.

    ``size`` is the number of words; ``taken`` the number of words that the mix takes of the text.
    A source is read in random order, again from the start when it ends, and cut at the whole number
    nearest to its target, so its ``taken`` add up to that number; the text at the cut is taken in
    part. No text is taken more than ``most`` times, rounded up.

    Null texts have size 0 and nothing taken; null sources are one source, the last. Rows alike in id, source
    and text share a key and are interchangeable: reruns give the same rows. An empty table gives an empty
    one. Columns other than the three and the kept ones are not read. Kept columns are moved once, with
    their rows, to the ranges.
    """
    named = F.coalesce(F.concat(F.lit("0"), docs[f"`{source}`"].cast("string")), F.lit(_NONE))
    ids, texts = docs[f"`{id_col}`"], docs[f"`{text}`"].cast("string")
    own = F.concat(F.coalesce(ids.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(texts, F.lit(""))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), own))
    columns = [
        ids.alias("id"), named.alias("source"), text_size(texts).alias("size"),
        F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("long").alias("key"),
    ]
    base = checkpoint(docs.select(columns))
    per_source = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpoint(source_targets(per_source, weights, share, most))
    # As many ranges as each has documents when there is one source: both lists stay short.
    ranges = int(base.count() ** 0.5) + 1
    width = -(-(16**KEY_DIGITS) // ranges)
    place = F.floor(F.col("key") / width).cast("int")
    ranged = base.withColumn("range", place)
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    over = Window.partitionBy("source").orderBy("range")
    whole = F.round("target").cast("long")
    known = F.col("source_size") > 0
    starts = (
        sums.withColumn("start", F.sum("range_size").over(over) - F.col("range_size"))
        .join(targets, "source")
        .select(
            "source", "range", "start", "source_size", "target",
            F.when(known, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long").alias("times"),
            F.when(known, whole % F.col("source_size")).otherwise(0).cast("long").alias("rest"),
        )
    )
    within = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("start") + F.sum("size").over(within) - F.col("size")
    again = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("first")))
    out = [F.col("id").alias(id_col), F.when(F.col("source") != _NONE, F.substr("source", F.lit(2))).alias("source")]
    if keep is not None:
        kept = [c for c in keep if c.lower() not in RESULT]
        quoted = ["`" + c.replace("`", "``") + "`" for c in kept]
        whole_rows = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(quoted)]).alias("row")
        ranged = docs.select(*columns, whole_rows).withColumn("range", place)
        out = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)]
    return ranged.join(starts, ["source", "range"]).withColumn("first", first).select(
        *out, "size", "source_size", "target",
        (F.col("times") * F.col("size") + again).cast("long").alias("taken"),
    )
