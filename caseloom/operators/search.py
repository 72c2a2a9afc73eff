"""Substring search over many texts: a stored table says which rows hold which three letters, so few texts are read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def _threes(c: Column) -> Column:
    """Distinct runs of three letters of a text, lower-case; none for a shorter one."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("(?s)(?=(...))"), 1))  # in one pass, also over long texts


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def write_postings(rows: DataFrame, id_: str, columns: list[str], path: str) -> None:
    """Store (bucket, gram, id): which rows hold a run of three letters in any of some columns. A look-up reads the
    buckets of its runs only, and within them, as they are sorted, the row groups of its runs."""
    grams = F.explode(reduce(lambda a, b: F.array_union(a, _threes(F.coalesce(F.col(b).cast("string"), F.lit("")))), columns[1:], _threes(F.coalesce(F.col(columns[0]).cast("string"), F.lit("")))))
    held = rows.select(F.col(id_).alias("id"), grams.alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    # a run that most rows hold is dealt to several files of its bucket
    held.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "gram", "id").write.mode("overwrite").partitionBy("bucket").parquet(path)


def candidates(spark: SparkSession, path: str, part: str) -> DataFrame | None:
    """id of the rows that hold all runs of three letters of a part; None for a part too short to look up."""
    low = part.lower()
    grams = sorted({low[i : i + 3] for i in range(len(low) - 2)})
    if not grams:
        return None
    wanted = spark.createDataFrame([(g,) for g in grams], "gram string").withColumn("bucket", _bucket(F.col("gram")))
    buckets = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]  # at most one per letter of the part
    found = spark.read.parquet(path).where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    return found.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(grams)).select("id")


def search(rows: DataFrame, id_: str, path: str, parts: dict[str, str]) -> DataFrame:
    """The rows that hold any of some parts, each in its column (in any case), by the stored runs of these columns: for each
    part the candidates are found without reading texts; then only their texts are read and compared. A part of fewer
    than three letters reads all rows."""
    hit = reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.lower(F.col(c)), F.lit(p.lower())), F.lit(False)) for c, p in parts.items()))
    ids = [candidates(rows.sparkSession, path, p) for p in parts.values()]
    if any(i is None for i in ids):
        return rows.where(hit)
    return rows.join(reduce(DataFrame.union, ids).distinct().withColumnRenamed("id", "_found"), F.col(id_) == F.col("_found"), "left_semi").where(hit)
