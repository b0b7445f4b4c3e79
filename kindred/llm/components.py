"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kindred.session import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the undirected edges (``a``, ``b``), both long.

    In a round every node joins the node with the smallest hash among itself and its neighbours;
    nodes that joined the same one are merged, and edges inside a merged node fall away. Hashes are
    drawn anew each round, so a constant share of the nodes is expected to vanish, whatever the shape.
    Nodes of one component share a root, which is one of them. Rounds are cut by checkpoints, whose
    files outlive a lost executor; only a count of edges reaches the driver.
    """
    edges = edges.select("a", "b").filter("a <> b").distinct()
    both = checkpoint(edges.union(edges.select("b", "a")).distinct())
    roots = None
    step = 0
    while not both.isEmpty():
        def order(name, step=step):
            return F.struct(F.xxhash64(F.lit(step), F.col(name)).alias("hash"), F.col(name).alias("is"))

        best = both.groupBy("a").agg(F.min(order("b")).alias("other"))
        joined = checkpoint(best.select(F.col("a").alias("node"), F.least(order("a"), "other")["is"].alias("to")))
        if roots is None:
            roots = joined.select("node", F.col("to").alias("root"))
        else:
            moved = joined.select(F.col("node").alias("root"), "to")
            roots = checkpoint(
                roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            )
        left = joined.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = joined.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        both = checkpoint(
            both.join(left, "a").join(right, "b").filter("a2 <> b2")
            .select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct()
        )
        step += 1
    if roots is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
