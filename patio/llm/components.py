"""Connected components of a link table, by rounds of joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.session import durable


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Each round every node takes the smallest label among its neighbours' and its own, and then the
    label of that label, so chains shorten fast. Each round is written as a table, which ends its
    lineage; minima combine on the map side, so a node with very many links is no single task. The
    driver only reads how many labels changed.
    """
    both = durable(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a != b").distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("a"), F.min("b")).alias("component")))
    for _ in range(max_rounds):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        stepped = durable(lower.join(jump, F.col("low") == F.col("via"), "left").select(
            "node", F.col("component").alias("old"),
            F.least("low", F.coalesce("far", "low")).alias("component")))
        labels = stepped.select("node", "component")
        if stepped.filter("component != old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
