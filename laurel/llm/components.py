"""Connected components of links, by minimum labels and pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of the links (a, b) and the smallest node it is connected with.

    In each round a node takes the smallest label among itself and its neighbours, then the label of its label.  Rounds are staged in the
    shared folder; one number comes to the driver: how many labels changed.
    """
    edges = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "component-edges")
    labels = staged(edges.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("node"), F.least("a", "_m").alias("root")), "component-labels")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("_near")))
        step = labels.join(near, "node").select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_new"))
        # the label is a node too: take its label if that is smaller
        jump = labels.select(F.col("node").alias("_new"), F.col("root").alias("_far"))
        step = staged(step.join(jump, "_new").select("node", F.least("_new", "_far").alias("root"), (F.least("_new", "_far") != F.col("_old")).alias("moved")),
                      "component-labels")
        labels = step.select("node", "root")
        if step.where("moved").isEmpty():
            return labels
