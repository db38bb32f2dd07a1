"""Connected components of links between ids, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable

#: Rows that one task reads, if there are as many.
TASK_ROWS = 1 << 16


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and label, the smallest id that the node reaches, for every node of a link.

    Each round takes the least label among a node's neighbours and then the
    label of that label, so long chains shorten by halves; it ends when no
    label changes. Each round's labels are written to the checkpoint folder.
    Tasks that read links and labels follow their number, not the partitions'.
    """
    ends = links.select(F.col(a).alias("node"), F.col(b).alias("next"))
    ends = durable.checkpoint(ends.unionByName(ends.select(F.col("next").alias("node"), F.col("node").alias("next"))).distinct(), TASK_ROWS)
    labels = durable.checkpoint(ends.groupBy("node").agg(F.least(F.col("node"), F.min("next")).alias("label")), TASK_ROWS)
    while True:
        near = ends.join(labels.select(F.col("node").alias("next"), "label"), "next").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("label").alias("up"))
        step = durable.checkpoint(lower.join(up, "new", "left").select("node", F.coalesce(F.least("new", "up"), "new").alias("label"), (F.coalesce(F.least("new", "up"), F.col("new")) != F.col("label")).alias("moved")), TASK_ROWS)
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels
