"""Connected components of an edge table, as Spark jobs over narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.llm.common import save


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the component's least node.

    Each round takes the least label among a node's neighbours and then the label of that
    label, so the rounds grow with the logarithm of a component's width.  Every round is
    written to the shared folder; nothing is collected.
    """
    one = edges.where("a <> b").select("a", "b")
    both = save(one.union(one.select("b", "a")).distinct(), "cc_edges")
    labels = save(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "cc")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        hooked = save(labels.join(near, "node").select(
            "node", F.least("root", "near").alias("root"), (F.col("near") < F.col("root")).alias("moved")), "cc")
        if not hooked.where("moved").limit(1).count():
            return labels
        parents = hooked.select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = save(hooked.join(parents, "root").select("node", F.col("up").alias("root")), "cc")
