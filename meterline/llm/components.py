"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """(id, label) for each id in links (a, b): the smallest id that links reach from it.

    Each round takes the least label of the neighbours, then the label of that label, until nothing changes.
    Rounds are written to the shared folder. Links of an id to itself and repeated links change nothing.
    """
    edges = written(links.select("a", "b").union(links.select("b", "a")).toDF("id", "other").distinct(), "edges")
    labels = written(edges.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("label")), "labels")
    while True:
        near = edges.join(labels.toDF("other", "_label"), "other").groupBy("id").agg(F.min("_label").alias("_least"))
        lower = labels.join(near, "id").select("id", "label", F.least("label", "_least").alias("_next"))
        # an id's next label is itself an id, whose own label may be smaller still
        far = labels.toDF("_next", "_far")
        step = lower.join(far, "_next", "left").select("id", F.col("label").alias("_was"), F.least("_next", F.coalesce("_far", "_next")).alias("label"))
        step = written(step, "labels")
        labels = step.select("id", "label")
        if step.where(F.col("_was") != F.col("label")).isEmpty():
            return labels
