"""Connected components of an edge list, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.session import pin, release


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every id with an edge; ``label`` is the smallest id it can reach.

    Each round gives every vertex the smallest label among itself and its neighbours, then the label of that
    label, so the reach doubles from round to round.  Rounds end when nothing changes.  Only a count comes to the
    driver.  A vertex with many neighbours is one group of a partial aggregation, never one task's rows."""
    both = edges.select(F.col(a).alias("id"), F.col(b).alias("to")).unionByName(edges.select(F.col(b).alias("id"), F.col(a).alias("to")))
    both = pin(both.filter("id <> to").distinct(), "edges")
    labels = pin(both.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("to"), "label"), "to").groupBy("id").agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        moved = pin(lower.join(jump, "next").select("id", "label", F.least("next", "far").alias("next")), "labels")
        changed = not moved.filter("next <> label").isEmpty()
        release(labels)
        labels = moved.select("id", F.col("next").alias("label"))
        labels._pinned_at = moved._pinned_at
        if not changed:
            release(both)
            return labels
