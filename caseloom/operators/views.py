"""Nested views: children gathered before they are joined, and stored views that follow changes."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested
from ..shared import checkpointed, remove, replace


@dataclass(frozen=True)
class Children:
    """What a parent has of one kind: a list of `value` in `order`, and maps of counts by `counted`."""

    rows: DataFrame
    key: str
    value: Column
    order: tuple[Column, ...]
    counted: Column | None = None


def with_children(parents: DataFrame, key: str, children: dict[str, Children]) -> DataFrame:
    """parents with a list column per kind of children (empty where there are none), and for kinds that are counted a map
    column `<kind>_counts`. Each kind is one grouping by the parent's key and one join of grouped rows, so kinds do not
    multiply each other, and all of them share one partitioning."""
    out = parents
    for name, c in children.items():
        lists = c.rows.where(F.col(c.key).isNotNull()).groupBy(F.col(c.key).alias("_key")).agg(nested.ordered_list(c.value, *c.order).alias(name))
        out = out.join(lists, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))
        if c.counted is not None:
            counts = c.rows.where(F.col(c.key).isNotNull()).groupBy(F.col(c.key).alias("_key"), c.counted.cast("string").alias("_kind")).agg(F.count(F.lit(1)).alias("_n"))
            maps = counts.groupBy("_key").agg(nested.to_map(F.coalesce("_kind", F.lit("unknown")), F.col("_n")).alias("_counts"))
            out = out.join(maps, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(f"{name}_counts", F.coalesce("_counts", F.create_map().cast(maps.schema["_counts"].dataType))).drop("_counts")
    return out


def _bucketed(view: DataFrame, key: str, buckets: int) -> DataFrame:
    return view.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def store(view: DataFrame, key: str, path: str, buckets: int = 64) -> None:
    """Write a view in folders by a hash of its key."""
    _bucketed(view, key, buckets).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)


def changed_parents(changes: list[tuple[DataFrame, str]]) -> DataFrame:
    """key: the parents of all changed children (a table of changed rows and its parent column, for each kind)."""
    out = None
    for rows, column in changes:
        one = rows.select(F.col(column).alias("key")).where("key IS NOT NULL")
        out = one if out is None else out.union(one)
    return out.distinct()


def refresh_changed(path: str, key: str, changed: DataFrame, build: Callable[[DataFrame], DataFrame], buckets: int = 64) -> int:
    """Bring a stored view up to date after changes of some keys (a table of one column): the view of these keys is built anew,
    joins what their folders hold of other keys, and only these folders are overwritten. Keys that no longer have a row go.
    Gives the number of folders that were written."""
    spark = changed.sparkSession
    keys = checkpointed(changed.select(F.col(changed.columns[0]).alias(key)).distinct())
    touched = [r["_bucket"] for r in _bucketed(keys, key, buckets).select("_bucket").distinct().collect()]  # at most `buckets`
    if not touched:
        return 0
    kept = spark.read.parquet(path).where(F.col("_bucket").isin(touched)).join(keys, key, "left_anti")
    fresh = _bucketed(build(keys), key, buckets)
    # written beside the view in full, before its folders take the place of the old ones
    beside = f"{path.rstrip('/')}-new-{uuid.uuid4().hex}"
    kept.select(fresh.columns).unionByName(fresh).repartition("_bucket").write.partitionBy("_bucket").parquet(beside)
    for bucket in sorted(touched):  # a folder of which no row is left is not written, so it is only removed
        replace(spark, f"{beside}/_bucket={bucket}", f"{path}/_bucket={bucket}")
    remove(spark, beside)
    return len(touched)
