"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.session import Scratch


def components(links: DataFrame) -> DataFrame:
    """(v, c) for every end of ``links`` (a, b): c is the smallest vertex of v's component.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    a path shrinks by more than half. A round's labels are written to the shared folder, those before deleted; nothing
    but the number of changed labels reaches the driver."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    scratch = Scratch(links.sparkSession, "components")
    edges = scratch.keep(both, "edges")
    labels, rounds = scratch.keep(edges.select(F.col("a").alias("v"), F.col("a").alias("c")).distinct(), "0"), 0
    while True:
        rounds += 1
        near = edges.join(labels, edges["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("m"))
        step = labels.join(near, labels["v"] == near["a"]).select("v", F.least("c", "m").alias("c"), F.col("c").alias("old"))
        target = step.select(F.col("v").alias("t"), F.col("c").alias("tc"))
        new = scratch.keep(step.join(target, step["c"] == target["t"]).select("v", F.least("c", "tc").alias("c"), "old"), str(rounds))
        scratch.drop(str(rounds - 1))
        if new.filter(F.col("c") != F.col("old")).isEmpty():
            scratch.drop("edges")
            return new.select("v", "c")
        labels = new.select("v", "c")
