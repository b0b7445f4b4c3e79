"""Top lists per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.operators.topk import top_per_group


def likers(edges: DataFrame) -> DataFrame:
    """Distinct users who like each content, as (``content_id``, ``type``, ``total_users``)."""
    return (
        edges.filter(F.col("rel") == "like")
        .groupBy(F.col("src_id").alias("content_id"), F.col("src_type").alias("type"))
        .agg(F.count_distinct("dst_id").alias("total_users"))
    )


def liker_count(edges: DataFrame, content_id: str, kind: str) -> DataFrame:
    """One row: how many users like the given content, 0 if nobody does."""
    one = (F.col("rel") == "like") & (F.col("src_id") == content_id) & (F.col("src_type") == kind)
    return edges.filter(one).agg(F.count_distinct("dst_id").alias("total_users"))


def top_by_pagerank(nodes: DataFrame, k: int = 5, digits: int = 6) -> DataFrame:
    """The ``k`` content nodes of highest rank in each domain. Ranks equal at ``digits`` decimals
    are ordered by id."""
    ranked = nodes.filter(F.col("pagerank").isNotNull())
    ranked = ranked.withColumn("pagerank", F.round("pagerank", digits))
    return top_per_group(ranked, ["type"], [F.desc("pagerank"), "content_id"], k)


def top_by_popularity(edges: DataFrame, content: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most liked contents of each domain. Titles are looked up for the winners only;
    the few winners are broadcast if they turn out as small as they should."""
    top = top_per_group(likers(edges), ["type"], [F.desc("total_users"), "content_id"], k)
    return content.join(top, ["content_id", "type"])
