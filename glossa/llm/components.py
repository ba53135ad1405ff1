"""Connected components of a table of links, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.operators.lookup import skew_join


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``links`` (a long, b long): the smallest node that each can reach.

    Each round takes the smallest label among the neighbours and then the label's label, so the number of rounds
    grows with the logarithm of the longest chain.  Labels are combined map-side; nothing is gathered per component: the label that a
    giant component shares and a node with very many neighbours are split by their weight (``skew_join``).
    Empty links give no rows; loops and repeated links do no harm.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a != b").distinct().checkpoint()
    labels = (both.groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("degree"))
              .select(F.col("a").alias("node"), F.least("a", "b").alias("label"), "degree").checkpoint())
    while True:
        seen = skew_join(both, labels.withColumnRenamed("node", "b"), ["b"], "degree", ["a"], "inner")
        near = seen.groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        lower = labels.join(near, "node").select("node", "degree", F.col("label").alias("was"), F.least("label", "near").alias("label")).checkpoint()
        held = lower.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up")).join(held, "label").checkpoint()
        after = skew_join(lower, up, ["label"], "n", ["node"])
        after = after.select("node", "degree", "was", F.coalesce("up", "label").alias("label")).checkpoint()
        changed = after.where("was != label").limit(1).count()
        labels = after.select("node", "label", "degree")
        if not changed:
            return labels.select("node", "label")
