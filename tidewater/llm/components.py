"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import split_join, written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours' and then that label's
    own label, until nothing changes.  Nodes with a large share of the edges, and labels that a large
    share of the nodes have, are met by broadcast (at most a thousand each), so a star's centre is no
    task's own.  Rounds are cut by files in the shared folder; the driver sees counts only.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-edges")
    # n: the rows of ``both`` that a node's label goes to
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
                         .select(F.col("a").alias("node"), F.least("a", "m").alias("comp"), "n"), "cc-labels")
    total = both.count()
    while True:
        near = (split_join(both, labels.select(F.col("node").alias("b"), "comp", "n"), ["b"], total)
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        met = written(labels.join(near, "node").select("node", "n", F.col("comp").alias("old"), F.least("comp", "near").alias("new")), "cc-met")
        held = met.groupBy("new").agg(F.count("*").alias("n"))
        up = written(held.join(labels.select(F.col("node").alias("new"), F.col("comp").alias("up")), "new"), "cc-up")
        jumped = split_join(met.withColumnRenamed("n", "edges"), up, ["new"])
        step = written(jumped.select("node", "old", F.least("new", "up").alias("comp"), F.col("edges").alias("n")), "cc-labels")
        labels = step.select("node", "comp", "n")
        if step.filter("old <> comp").limit(1).count() == 0:
            return labels.select("node", "comp")
