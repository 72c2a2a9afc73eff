"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize


def components(links: DataFrame, parts: int = 2000, least: int = 64) -> DataFrame:
    """node, component (its smallest node) for every end of links (a, b: long). Labels are tables of the shared folder;
    each round takes the smallest label among neighbours, then the label of that label, so chains halve. Rounds go on
    until no label falls any more.

    A node of more than 1/parts of all links (a hub), and a label that so many nodes have, is dealt to pieces: its links
    meet copies of its label in as many tasks."""
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    degrees = materialize(both.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("low")), "degrees")
    piece = F.lit(max(least, -(-(degrees.agg(F.sum("n")).first()[0] or 0) // parts)))
    hubs = materialize(degrees.where(F.col("n") > piece).select("node", F.ceil(F.col("n") / piece).cast("int").alias("pieces")), "hubs")  # at most `parts` rows
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = both.join(F.broadcast(hubs.withColumnRenamed("node", "b")), "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), pieces).cast("int").alias("piece"))
    dealt = materialize(dealt, "dealt-edges")
    labels = degrees.select("node", F.least("node", "low").alias("component"))
    while True:
        copies = labels.join(F.broadcast(hubs), "node", "left").select(F.col("node").alias("b"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), F.col("component").alias("offer"))
        offered = dealt.join(copies, ["b", "piece"]).groupBy(F.col("a").alias("node")).agg(F.min("offer").alias("offer"))
        lower = materialize(labels.join(offered, "node").select("node", "component", F.least("component", "offer").alias("next")), "lower")
        shared = lower.groupBy("next").agg(F.count(F.lit(1)).alias("n"))
        above = materialize(shared.join(lower.select(F.col("node").alias("next"), F.col("next").alias("jump")), "next"), "above")
        moved = join_groups(lower, above, ["next"], "n", parts, least)
        moved = materialize(moved.select("node", "component", F.least("next", "jump").alias("next")), "moved")
        labels = moved.select("node", F.col("next").alias("component"))
        if moved.where("next < component").isEmpty():
            return labels
