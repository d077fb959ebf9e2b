"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links`` (a, b): the smallest id reachable.

    Each round takes the smallest label among the neighbours, then the label of
    that label, so the number of rounds grows with the logarithm of the
    distances. Labels are aggregated before they are shuffled: a node with very
    many links costs one row per task. Only one sum goes to the driver.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    label = cut(both.groupBy("a").agg(F.min("b").alias("m"))
                .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    moved = True
    while moved:
        near = (both.join(label.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m")))
        least = (label.join(near, "id").select("id", "component", F.least("component", "m").alias("m")))
        of = label.select(F.col("id").alias("m"), F.col("component").alias("far"))
        new = cut(least.join(of, "m").select("id", F.least("m", "far").alias("component"),
                                             (F.col("component") != F.least("m", "far")).alias("moved")), "labels")
        moved = new.filter("moved").limit(1).count() > 0
        label = new.select("id", "component")
    return label
