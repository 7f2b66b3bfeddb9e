"""Connected components by spreading the least label, with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut


def components(links: DataFrame) -> DataFrame:
    """id, component (the least id reached) for all ids in links (a, b)."""
    one = links.select("a", "b")
    both = cut(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("component")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        far = step.select(F.col("id").alias("component"), F.col("component").alias("far"))
        new = cut(step.join(far, "component", "left").select("id", "old", F.least("component", F.coalesce("far", "component")).alias("component")))
        done = new.filter("component <> old").isEmpty()
        labels = new.select("id", "component")
        if done:
            return labels
