"""Reachability along directed UMI links, in rounds that are written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import dropped, written


def minimum_labels(nodes: DataFrame, links: DataFrame, place: list[str]) -> DataFrame:
    """Adds cluster to nodes (place, umi, reads): the UMI of most reads (then the first by name) that reaches it.

    Labels are pairs of reads and name, so a place with very many UMIs is never ranked as a whole. They spread along links
    (umi -> umi2) until none changes, and only those that the round before has changed are sent again; chains are as short
    as counts halve along them. Finished rounds are deleted.
    """
    label = F.struct((-F.col("reads")).alias("order"), F.col("umi").alias("name"))
    labels, links = written(nodes.select("*", label.alias("label"), F.lit(True).alias("changed"))), written(links)
    while True:
        sent = links.join(labels.where("changed").select(*place, "umi", F.col("label").alias("__sent")), [*place, "umi"])
        least = sent.groupBy(*place, F.col("umi2").alias("umi")).agg(F.min("__sent").alias("__sent"))
        after = labels.join(least, [*place, "umi"], "left").withColumn("__new", F.least("label", F.coalesce("__sent", "label")))
        after = written(after.select(*nodes.columns, F.col("__new").alias("label"), (F.col("__new") < F.col("label")).alias("changed")))
        done = after.where("changed").isEmpty()
        dropped(labels)
        labels = after
        if done:
            break
    dropped(links)
    return labels.select(*nodes.columns, F.col("label.name").alias("cluster"))
