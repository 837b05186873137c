"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import step


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Smallest reachable node of each linked node: rows of `node` and `component`.

    `links` has integer columns a and b, without NULL. Each round hangs every node under the smallest
    label among itself and its neighbours and then lets it take over its label's label, so a chain
    shortens by more than half a round; rounds are written to the shared folder. Nothing but the number
    of changed rows reaches the driver. A node with many links has many rows on the side that is
    summed before the shuffle.
    """
    edges = links.filter("a <> b").select("a", "b")
    both = step(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = step(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    for _ in range(most_rounds):
        # the smallest label next to each node, for the node and for the node it hangs under
        near = (
            both.join(labels.withColumnRenamed("a", "b"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        known = labels.join(near, "a").select("a", "label", F.least("label", "near").alias("best"))
        hung = known.select(F.col("label").alias("a"), F.col("best").alias("up")).union(
            known.select("a", F.col("best").alias("up"))
        )
        lowest = hung.groupBy("a").agg(F.min("up").alias("label"))
        jumped = lowest.join(lowest.select(F.col("a").alias("label"), F.col("label").alias("top")), "label", "left")
        new = step(jumped.select("a", F.coalesce("top", "label").alias("label")), "labels")
        changed = new.join(labels.withColumnRenamed("label", "was"), "a").filter("label <> was")
        done = changed.limit(1).count() == 0
        labels = new
        if done:
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
