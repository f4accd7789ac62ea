"""Connected components over a table of links, by repeated joins."""

from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links`` (u, v): the least node reachable.

    Each round takes the least label among the neighbours and then the label of that
    label, so long chains halve. Each round is written and read again; only the number of
    changed labels reaches the driver.
    """
    pairs = links.where("u <> v").select("u", "v")
    both = stored(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
    labels = stored(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).select(
            "node", F.least("node", "least").alias("component")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels, both.v == labels.node)
            .groupBy("u")
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, labels.node == around.u).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        moved = stored(
            nearer.join(jump, nearer.component == jump._node).select(
                "node", "before", F.least("component", "_component").alias("component")
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component <> before").isEmpty():
            return labels
