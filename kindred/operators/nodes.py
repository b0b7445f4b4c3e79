"""Node tables: building, merging by key, and attaching computed properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.functions.text import plain_user
from kindred.operators.edges import node_id


def build_nodes(
    content: DataFrame,
    ratings: DataFrame,
    keywords: DataFrame,
    link_users: bool = False,
    keyword: str = "keyword",
) -> dict[str, DataFrame]:
    """The three node tables. ``ratings`` are those of known content (``user_content``).

    Content keeps its title whether or not it has keywords. With ``link_users`` one person's
    accounts in several domains are one node.
    """
    users = ratings.filter(F.col("user_id").isNotNull())
    if link_users:
        users = users.select(plain_user("user_id").alias("user_id"), F.lit(None).cast("string").alias("type"))
    return {
        "content": content.groupBy("content_id", "type")
        .agg(F.max(F.struct("title", "description")).alias("c"))
        .select("content_id", "type", "c.title", "c.description"),
        "users": users.select("user_id", "type").distinct(),
        "keyword": keywords.filter(F.col(keyword).isNotNull())
        .select(F.col(keyword).alias("keywords")).distinct(),
    }


def node_list(tables: dict[str, DataFrame]) -> DataFrame:
    """The ids (``node``) of all nodes of ``build_nodes``, linked or not."""
    content, users, words = tables["content"], tables["users"], tables["keyword"]
    ids = (
        content.select(node_id(F.lit("content"), F.col("content_id"), F.col("type")).alias("node")),
        users.select(node_id(F.lit("users"), F.col("user_id"), F.col("type")).alias("node")),
        words.select(node_id(F.lit("keyword"), F.col("keywords")).alias("node")),
    )
    return ids[0].unionByName(ids[1]).unionByName(ids[2]).filter("node IS NOT NULL").distinct()


def one_row_per_key(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """The last row of each key by ``order``; equals, or all without it, by their other columns."""
    rest = [c for c in df.columns if c not in keys and c != order]
    row = F.max(F.struct(*([order] if order else []), *rest)).alias("__row")
    chosen = df.groupBy(*keys).agg(row)
    return chosen.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def upsert_nodes(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Merge by key: a property of ``new`` replaces that of ``old`` unless it is null.

    Where a side has several rows for a key, one of them counts as a whole: the last by ``order``, as
    in ``one_row_per_key``. Grouped aggregates over the union stand for a full join, so rows combine
    before they are moved. Null keys are one key.
    """
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    sides = [df.withColumn("__new", F.lit(i)) for i, df in enumerate((old, new))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    single = one_row_per_key(both, [*keys, "__new"], order)

    def latest(c: str):
        return F.max(F.when(F.col(c).isNotNull(), F.struct("__new", c)))[c].alias(c)

    merged = single.groupBy(*keys).agg(*[latest(c) for c in columns if c not in keys])
    return merged.select(*columns)


def attach_node_property(
    nodes: DataFrame, values: DataFrame, on: list[str], labels: tuple[str, ...] | None = None
) -> DataFrame:
    """Left join computed properties to nodes; with ``labels``, only nodes so labelled get them."""
    if labels is not None:
        values = values.filter(F.col("label").isin(*labels)).drop("label")
    return nodes.join(values, on, "left")


def split_node_id(df: DataFrame, node: str = "node") -> DataFrame:
    """``node`` back to ``label``, ``type`` and ``key``; the key may itself contain the separator.
    All three are null for a null node."""
    parts = F.split(F.col(node), r"\|", 3)
    return df.select(
        F.get(parts, F.lit(0)).alias("label"),
        F.nullif(F.get(parts, F.lit(1)), F.lit("")).alias("type"),
        F.get(parts, F.lit(2)).alias("key"),
        *[c for c in df.columns if c != node],
    )


def content_property(scores: DataFrame, value: str) -> DataFrame:
    """Scores of content nodes as (``content_id``, ``type``, value)."""
    return (
        split_node_id(scores)
        .filter(F.col("label") == "content")
        .select(F.col("key").alias("content_id"), "type", value)
    )
