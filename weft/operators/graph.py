"""Connected components by repeated contraction of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import materialise


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 64) -> DataFrame:
    """``node, root`` for each node of an undirected edge table of BIGINT ids.

    ``root`` is the smallest id of the component. Nulls and loops are no edges;
    repeated edges count once; an empty table gives an empty result.

    Each round hooks every node to its smallest neighbour, follows one more
    hook, and rewrites the edges to the nodes hooked to, so that edges shrink
    from round to round. Neighbours are reduced by ``min`` with map-side
    combine; no adjacency list is built, so a hub is no burden. The maps of the
    rounds are written to the shared folder and applied in turn at the end.
    """
    e = edges.select(F.col(src).cast("bigint").alias("a"), F.col(dst).cast("bigint").alias("b")).where("a is not null and b is not null")
    nodes = e.select("a").union(e.select("b")).distinct().withColumnRenamed("a", "node")
    e = materialise(e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    nodes = materialise(nodes, "cc-nodes")
    labels = nodes.withColumn("root", F.col("node"))
    for _ in range(max_rounds):
        if e.isEmpty():
            return labels
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("p"))
        hook = materialise(hook, "cc-hook")
        up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jump = hook.join(up, "p").select("a", F.col("pp").alias("r"))
        jump = materialise(jump, "cc-map")
        e = (
            e.join(jump.withColumnRenamed("r", "ra"), "a")
            .join(jump.select(F.col("a").alias("b"), F.col("r").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        e = materialise(e, "cc-edges")
        step = jump.select(F.col("a").alias("root"), "r")
        labels = labels.join(step, "root", "left").select("node", F.coalesce("r", "root").alias("root"))
    raise RuntimeError("components did not settle")
