"""Connected components of a table of links, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: (node, component), for links (a, b) of numbers.

    In each round a node takes the smallest label among its own and its
    neighbours', then the label of its label.  Every round is a written table,
    so a lost executor costs at most one.  Nodes without links are not listed.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnsRenamed({"node": "b", "component": "near"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        nearer = staged(labels.join(seen, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")), "nearer")
        above = nearer.select(F.col("node").alias("component"), F.col("component").alias("above"))
        next_ = staged(nearer.join(above, "component").select("node", F.col("above").alias("component"), (F.col("above") < F.col("old")).alias("moved")), "labels")
        labels = next_.select("node", "component")
        if not next_.where("moved").limit(1).count():
            return labels
