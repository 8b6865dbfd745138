"""Connected components of a graph of links, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every node of ``links`` (a, b): the least id it is linked to.

    Each round
    takes the least label of the neighbours, then the label of that label; rounds
    grow with the logarithm of a component's breadth. A node with very many
    links has one label row; its links are spread by Spark's skew join."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.where("a <> b").distinct(), "component-links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("label"))
    labels = staged(labels, "component-labels")

    while True:
        near = both.join(labels.withColumnsRenamed({"id": "n", "label": "near"}), F.col("b") == F.col("n")).groupBy(F.col("a").alias("m")).agg(F.min("near").alias("near"))
        taken = labels.join(near, F.col("id") == F.col("m")).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("j"), F.col("label").alias("further"))
        after = taken.join(jump, F.col("label") == F.col("j"), "left").select("id", "old", F.least("label", "further").alias("label"))
        after = staged(after, "component-labels")
        if not after.where("label < old").limit(1).count():
            return after.select("id", "label")
        labels = after.select("id", "label")
