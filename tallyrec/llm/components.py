"""Connected components of a link table by falling labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): component is the smallest id reachable.

    A round takes the smallest label next to each id and then the label of that label, so long chains
    halve with every round.  Labels stay in tables; only the number of changes goes to the driver.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).where("a <> b")
    both = stored(both.union(both.select("other", "id")).distinct(), "component-links")
    labels = stored(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("component")), "component-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "other"), "other")
                .groupBy("id").agg(F.min("component").alias("near")))
        lower = labels.join(near, "id").select("id", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("root"))
        lower = lower.join(jump, "component").select("id", "before", F.least("component", "root").alias("component"))
        lower = stored(lower, "component-labels")  # a table has its true size; a checkpoint would carry the joins' estimate along
        changed = lower.where("before <> component").take(1)
        labels = lower.select("id", "component")
        if not changed:
            return labels
