"""Aggregates over groups that need more than one function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def mode(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value of each group; ties go to the longest, then to the last in order."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", F.length(value), value)).alias(name))


def non_null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, filled: how many rows have a value that is not blank, in one pass."""
    one = df.agg(*(F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in columns))
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return one.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, filled)")


def coverage(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """table_name, parents, row_count for each child table."""
    out = None
    for label, (df, key) in parts.items():
        one = df.agg(F.lit(label).alias("table_name"), F.countDistinct(key).alias("parents"), F.count(F.lit(1)).alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


def flag_groups(df: DataFrame, keys: list[str], flagged: Column, amount: Column, threshold: Column) -> DataFrame:
    """is_large on every row of a group that has a flagged row, or whose amounts reach the threshold."""
    totals = df.groupBy(*keys).agg(F.max(F.coalesce(flagged, F.lit(False))).alias("_any"), F.sum(F.coalesce(amount, F.lit(0))).alias("_total"), F.max(threshold).alias("_least"))
    return df.join(totals, keys).withColumn("is_large", F.col("_any") | F.coalesce(F.col("_total") >= F.col("_least"), F.lit(False))).drop("_any", "_total", "_least")


def allocate(df: DataFrame, keys: list[str], quantity: str, total: str, name: str) -> DataFrame:
    """The group's largest total dealt out by quantity (equally where there is none), rounded to 2 digits."""
    g = df.groupBy(*keys).agg(F.sum(F.coalesce(F.col(quantity), F.lit(0))).alias("_q"), F.max(total).alias("_t"), F.count(F.lit(1)).alias("_n"))
    share = F.when(F.col("_q") > 0, F.coalesce(F.col(quantity), F.lit(0)) / F.col("_q") * F.col("_t")).otherwise(F.col("_t") / F.col("_n"))
    return df.join(g, keys).withColumn(name, F.round(share.cast("decimal(38,10)"), 2).cast("double")).drop("_q", "_t", "_n")


def consolidate(df: DataFrame, keys: list[str], confidence: str, fill: list[str], source: str, order: Column) -> DataFrame:
    """One row per key: the fields of the most confident row, gaps filled by the others in order (rows that tie in it: the
    smallest value); all sources."""
    by = F.struct(-F.coalesce(F.col(confidence), F.lit(-1.0)), order)
    first = lambda c: F.min_by(c, F.struct(F.col(c).isNull(), by, F.col(c))).alias(c)
    return df.groupBy(*keys).agg(F.max(confidence).alias(confidence), *(first(c) for c in fill), F.array_sort(F.collect_set(source)).alias("sources"), F.count(F.lit(1)).alias("merged"))


def sum_merge(df: DataFrame, keys: list[str], amount: str, keep: list[str], order: Column) -> DataFrame:
    """One row per key: amounts added up, of other measures the first that is not null (rows that tie: the smallest)."""
    first = lambda c: F.min_by(c, F.struct(F.col(c).isNull(), order, F.col(c))).alias(c)
    return df.groupBy(*keys).agg(F.sum(amount).alias(amount), *(first(c) for c in keep))


def drop_redundant_totals(df: DataFrame, keys: list[str], amount: str, is_total: str, tolerance: float = 0.01) -> DataFrame:
    """Rows marked as totals go where the other rows of their group add up to them."""
    parts = df.where(~F.col(is_total)).groupBy(*keys).agg(F.sum(amount).alias("_parts"))
    joined = df.join(parts, keys, "left")
    redundant = F.col(is_total) & F.coalesce(F.abs(F.col(amount) - F.col("_parts")) <= tolerance * F.greatest(F.abs(F.col(amount)), F.lit(1.0)), F.lit(False))
    return joined.where(~redundant).drop("_parts")


def token_shares(df: DataFrame, text: Column, label: str, least_count: int = 3, least_share: float = 0.9) -> DataFrame:
    """token, label, n, share: tokens that nearly always come with one label."""
    tokens = df.select(F.explode(F.array_distinct(F.split(text, " "))).alias("token"), F.col(label).alias("label")).where("token <> ''")
    counts = tokens.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("token").agg(F.sum("n").alias("total"))
    return counts.join(totals, "token").withColumn("share", F.col("n") / F.col("total")).where((F.col("n") >= least_count) & (F.col("share") >= least_share)).drop("total")


def dominant(df: DataFrame, column: str, least: float) -> DataFrame:
    """Values that make up at least so much of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total")).where(F.col("share") >= least).drop("total")


def batch_metrics(runs: DataFrame, started: str, ended: str, ok: str, items: str) -> DataFrame:
    """runs, succeeded, success_pct, items, items_per_hour."""
    seconds = F.sum(F.unix_timestamp(ended) - F.unix_timestamp(started))
    return runs.agg(F.count(F.lit(1)).alias("runs"), F.count_if(ok).alias("succeeded"), F.round(100.0 * F.count_if(ok) / F.count(F.lit(1)), 2).alias("success_pct"), F.sum(items).alias("items"), F.round(F.sum(items) * 3600.0 / seconds, 2).alias("items_per_hour"))


def numbered_from_zero(df: DataFrame, keys: list[str], *order: Column, name: str = "idx") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1)
