"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import forget, materialise


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node in ``(a, b)``; the root is the smallest node reachable.

    In each round every root hooks onto its smallest neighbour, the hooks are followed two steps, and links
    inside a component go. Only minima by node are taken, and a node with very many links takes part in
    joins that can be split, so no task gathers a component. Self links and repeated links do no harm.
    """
    links = materialise(links.select("a", "b").where("a <> b").distinct(), "links")
    roots = materialise(
        links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node")),
        "roots",
    )
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(
            both.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("root"), F.least("a", "b").alias("up")
            ),
            "hooks",
        )
        for _ in range(2):
            further = hooks.select(F.col("root").alias("up"), F.col("up").alias("further"))
            hooks = hooks.join(further, "up").select("root", F.col("further").alias("up"))
        hooks = materialise(hooks, "hooks")
        new_roots = materialise(
            roots.join(hooks, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots"
        )
        for end in ("a", "b"):
            links = (
                links.withColumnRenamed(end, "root")
                .join(hooks, "root")
                .drop("root")
                .withColumnRenamed("up", end)
            )
        links = materialise(links.select("a", "b").where("a <> b").distinct(), "links")
        forget(roots)
        roots = new_roots
    return roots
