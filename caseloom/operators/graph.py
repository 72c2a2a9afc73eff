"""Relationship graphs as tables of edges (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import checkpointed
from .joins import met, small


def edges(parts: list[tuple[DataFrame, str, str, str, str, str, float]]) -> DataFrame:
    """src, dst, relation, strength from (table, key, kind, key, kind, relation, strength); nodes are "kind:key". Edges are told
    apart by their keys as the tables hold them, after keys of one hash have met: names are made once an edge, and no task
    gathers groups of what it reads before the shuffle, where nearly all rows differ."""
    out = None
    for df, a, a_kind, b, b_kind, relation, strength in parts:
        keys = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
        one = keys.repartition("a").distinct().select(F.concat(F.lit(f"{a_kind}:"), F.col("a").cast("string")).alias("src"), F.concat(F.lit(f"{b_kind}:"), F.col("b").cast("string")).alias("dst"), F.lit(relation).alias("relation"), F.lit(float(strength)).alias("strength"))
        out = one if out is None else out.unionByName(one)
    return out


def out_degree(e: DataFrame) -> DataFrame:
    """node, degree: outgoing edges only; 0 for nodes that only have incoming ones. One pass over the edges, one grouping."""
    ends = e.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("n")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("n")))).alias("x"))
    return ends.select("x.*").groupBy("node").agg(F.sum(F.when(F.col("node").isNotNull(), F.col("n")).otherwise(0)).alias("degree"))


def components(e: DataFrame, piece: int = 20_000) -> DataFrame:
    """node, component (its smallest node), edges taken in both directions. Rounds go on until no label falls; each is cut by
    a checkpoint, and hubs and labels of more than `piece` nodes are dealt to several tasks."""
    both = checkpointed(e.select("src", "dst").union(e.select("dst", "src")).distinct())
    labels = checkpointed(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("component")))
    while True:
        offers = met(both, labels.select(F.col("node").alias("dst"), F.col("component").alias("offer")), ["dst"], piece).groupBy(F.col("src").alias("node")).agg(F.min("offer").alias("offer"))
        lower = labels.join(offers, "node").select("node", F.col("component").alias("old"), F.least("component", "offer").alias("component"))
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = checkpointed(met(lower, jump, ["component"], piece).select("node", "old", F.least("component", "next").alias("component")))
        labels = moved.select("node", "component")
        if moved.where("component < old").isEmpty():
            return labels


def clusters(e: DataFrame) -> DataFrame:
    """component, size of components of more than one node."""
    return components(e).groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1")


def simple_paths(e: DataFrame, starts: DataFrame, ends: DataFrame, most_nodes: int = 3) -> DataFrame:
    """path: all paths from a start to an end (tables of one column) without a repeated node, of at least two and at most
    most_nodes nodes. Paths grow from both sides and meet in the middle, so a hub there is reached from each side but never
    left: a path of n nodes is one of n / 2 nodes (rounded up) that grew from a start, and one that grew from an end. Edges may
    repeat: the paths are told apart, not all edges of the table."""
    step = e.select("src", "dst")
    one = lambda df: small(df.select(F.array(F.col(df.columns[0])).alias("path")).distinct())
    ahead, behind = [one(starts)], [one(ends)]
    for _ in range(2, (most_nodes + 1) // 2 + 1):
        ahead.append(ahead[-1].join(step, F.element_at("path", -1) == F.col("src")).where(~F.array_contains("path", F.col("dst"))).select(F.concat("path", F.array("dst")).alias("path")).distinct())
    for _ in range(2, most_nodes // 2 + 2):
        behind.append(behind[-1].join(step, F.element_at("path", 1) == F.col("dst")).where(~F.array_contains("path", F.col("src"))).select(F.concat(F.array("src"), "path").alias("path")).distinct())
    found = None
    for n in range(2, most_nodes + 1):
        left, right = ahead[(n + 1) // 2 - 1], behind[n // 2]
        left, right = left.select(F.col("path").alias("a"), F.element_at("path", -1).alias("middle")), right.select(F.col("path").alias("b"), F.element_at("path", 1).alias("middle"))
        own = F.slice("a", 1, F.size("a") - 1)
        joined = left.join(right, "middle").where(~F.arrays_overlap(own, F.col("b"))).select(F.concat(own, "b").alias("path"))
        found = joined if found is None else found.unionByName(joined)
    return found


def key_connections(e: DataFrame, n: int, boosts: dict[str, float]) -> DataFrame:
    """The n strongest edges, strength times the boost of their relation."""
    weight = F.lit(1.0)
    for relation, boost in boosts.items():
        weight = F.when(F.col("relation") == relation, boost).otherwise(weight)
    return e.withColumn("weight", F.col("strength") * weight).orderBy(F.desc("weight"), "src", "dst").limit(n)


def patterns(e: DataFrame, hub_degree: int = 3, place: str = "place", place_count: int = 2, person: str = "person", repeats: int = 1, roles: tuple[str, ...] = ()) -> DataFrame:
    """pattern, node, n: the three hubs of highest degree, if it is over hub_degree (ties to the smaller node); the number of
    clusters, if there are several (node null); the place of most incoming edges, if more than place_count; and people who
    take part (in one of `roles`, relations; any without) more than `repeats` times."""
    hubs = out_degree(e).where(F.col("degree") > hub_degree).orderBy(F.desc("degree"), "node").limit(3).select(F.lit("hub").alias("pattern"), "node", F.col("degree").alias("n"))
    groups = clusters(e).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("clusters").alias("pattern"), F.lit(None).cast("string").alias("node"), "n")
    places = e.where(F.col("dst").startswith(f"{place}:")).groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > place_count).orderBy(F.desc("n"), "node").limit(1)
    taking = e.where(F.col("src").startswith(f"{person}:") & (F.col("relation").isin(*roles) if roles else F.lit(True)))
    often = taking.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > repeats)
    return hubs.unionByName(groups).unionByName(places.select(F.lit("hotspot").alias("pattern"), "node", "n")).unionByName(often.select(F.lit("repeat").alias("pattern"), "node", "n"))
