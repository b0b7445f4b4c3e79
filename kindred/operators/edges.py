"""Relationships between content, users and keywords as one edge table.

Columns: ``src_id, src_type, rel, dst_id, dst_type``; keyword nodes have no type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


EDGE_COLUMNS = ["src_id", "src_type", "rel", "dst_id", "dst_type"]
_KEY = ["type", "content_id"]


def user_content(ratings: DataFrame, content: DataFrame, how: str = "inner") -> DataFrame:
    """Ratings of known content. ``how='right'`` adds an all-null row per content row without
    ratings. Ratings are the left side of a plain join, where Spark splits the partition of a
    content with very many of them."""
    if how not in ("inner", "right"):
        raise ValueError(how)
    columns = ["user_id", "type", "content_id", "rating"]
    keys = content.select(*_KEY)
    rated = ratings.select(*columns).join(keys, _KEY).select(*columns)
    if how == "inner":
        return rated
    unrated = keys.join(ratings.select(*_KEY).distinct(), _KEY, "left_anti")
    blank = unrated.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in rated.schema.fields
    ])
    return rated.unionByName(blank)


def edges_by_rating(rated: DataFrame, like: float = 8.0, dislike: float = 1.0) -> DataFrame:
    """``like`` and ``dislike`` edges content → user, each once. Unrated (below ``dislike``), null
    and NaN ratings and null users give no edge."""
    r = F.col("rating")
    rel = F.when(r >= like, "like").when(r >= dislike, "dislike")
    return (
        rated.filter(~F.isnan(r) & (r >= dislike) & F.col("user_id").isNotNull())
        .select(
            F.col("content_id").alias("src_id"),
            F.col("type").alias("src_type"),
            rel.alias("rel"),
            F.col("user_id").alias("dst_id"),
            F.col("type").alias("dst_type"),
        )
        .dropDuplicates(EDGE_COLUMNS)
    )


def edges_has_keyword(keywords: DataFrame, keyword: str = "keyword") -> DataFrame:
    """``has_keyword`` edges content → keyword, each once. Rows without an id, type or keyword give
    no edge."""
    complete = F.col(keyword).isNotNull() & F.col("content_id").isNotNull() & F.col("type").isNotNull()
    return (
        keywords.filter(complete)
        .select(
            F.col("content_id").alias("src_id"),
            F.col("type").alias("src_type"),
            F.lit("has_keyword").alias("rel"),
            F.col(keyword).alias("dst_id"),
            F.lit(None).cast("string").alias("dst_type"),
        )
        .dropDuplicates(["src_id", "src_type", "dst_id"])
    )


def node_id(label, key, kind=None):
    """One text per node: label, domain (empty for keywords) and key; null without a key."""
    kind = F.lit("") if kind is None else F.coalesce(kind, F.lit(""))
    return F.concat(label, F.lit("|"), kind, F.lit("|"), key)


def project_undirected(edges: DataFrame, rels: tuple[str, ...] = ("like", "has_keyword")) -> DataFrame:
    """The graph that scores and embeddings run on: (``src``, ``dst``) in both directions. Edges
    without an id at either end are left out."""
    label = F.when(F.col("rel") == "has_keyword", "keyword").otherwise("users")
    content = node_id(F.lit("content"), F.col("src_id"), F.col("src_type"))
    other = node_id(label, F.col("dst_id"), F.col("dst_type"))
    # One scan for both directions.
    both = F.array(
        F.struct(content.alias("src"), other.alias("dst")),
        F.struct(other.alias("src"), content.alias("dst")),
    )
    whole = F.col("rel").isin(*rels) & F.col("src_id").isNotNull() & F.col("dst_id").isNotNull()
    return edges.filter(whole).select(F.inline(both))
