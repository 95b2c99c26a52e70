"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_stored, stored


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in the links (a, b): the smallest id that links reach.

    Each round gives every id the least label around it, then the label of its label, until nothing changes. A round is
    two joins and one aggregate that combines before its shuffle; an id with very many links only splits a join. The
    driver sees one count per round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    edges = stored(both, "links")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        around = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("m"))
        least = labels.join(around, "id").select("id", F.least("label", "m").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        moved = stored(least.join(jump, "label").select("id", F.least("label", "next").alias("label"), "was"), "labels")
        changed = moved.where("label <> was").limit(1).count()
        drop_stored(labels)
        labels = moved.select("id", "label")
        if not changed:
            drop_stored(edges)
            return labels
