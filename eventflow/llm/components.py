"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); a component is its least node.

    Each round takes the least label among a node's neighbours and then the label which that
    label had, so paths to a least node grow by more each round. Labels are written to the
    shared folder each round. Null ends and loops are ignored; no links give no rows. Hot
    nodes only meet plain joins, which adaptive execution splits, and partial aggregates.
    """
    links = links.select("a", "b").where("a != b")
    both = stored(links.union(links.select("b", "a")).distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        )
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "m").alias("c")
        )
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("further"))
        after = stored(
            step.join(jump, "c").select(
                "node", F.least("c", "further").alias("component"),
                (F.col("was") != F.least("c", "further")).alias("moved"),
            ),
            "labels",
        )
        labels = after.select("node", "component")
        if after.where("moved").isEmpty():
            return labels
