"""Readers of the inputs that case systems deliver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null


def api_records(spark: SparkSession, path: str, record: str, multi_line: bool = True) -> DataFrame:
    """Rows of landed responses {status, data: [record]}; record is a DDL of its fields. Failed responses give none.
    multi_line: a response is a file of its own, not a line of one."""
    answers = spark.read.schema(f"status boolean, data array<struct<{record}>>").option("multiLine", multi_line).json(path)
    return answers.where("status").select(F.explode("data").alias("r")).select("r.*")


def keyed(df: DataFrame, key: str, values: list) -> DataFrame:
    """Point lookup of a few keys; the filter reaches the scan."""
    return df.where(F.col(key).isin(values))


def keyset_page(df: DataFrame, key: str, after, n: int, condition: Column | None = None) -> DataFrame:
    """The next n rows after a key."""
    rows = df if condition is None else df.where(condition)
    return (rows if after is None else rows.where(F.col(key) > F.lit(after))).orderBy(key).limit(n)


def lookup_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table: trimmed, distinct, without rows that have a blank in the first column."""
    raw = spark.read.schema(schema).option("header", True).csv(path)
    first = raw.columns[0]
    return raw.select(*(blank_to_null(F.col(c)).alias(c) if isinstance(raw.schema[c].dataType, T.StringType) else F.col(c) for c in raw.columns)).where(F.col(first).isNotNull()).distinct()


def hierarchy(df: DataFrame, levels: list[str]) -> DataFrame:
    """Distinct trimmed names of nested levels (state, district, ...)."""
    return df.select(*(F.lower(blank_to_null(F.col(c))).alias(c) for c in levels)).where(F.col(levels[0]).isNotNull()).distinct()


def split_document(docs: DataFrame, key: str, targets: dict[str, dict[str, str]]) -> dict[str, DataFrame]:
    """Flat legacy documents as tables: per target its columns (name: source field). What no target uses is kept as a map
    in `leftover`."""
    used = {f for columns in targets.values() for f in columns.values()} | {key}
    out = {name: docs.select(F.col(key), *(F.col(src).alias(dst) for dst, src in columns.items())) for name, columns in targets.items()}
    rest = [c for c in docs.columns if c not in used]
    if rest:
        pairs = F.create_map(*(x for c in rest for x in (F.lit(c), F.col(c).cast("string"))))
        out["leftover"] = docs.select(key, F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("fields"))
    return out


def fields_from_json(df: DataFrame, column: str, schema: str, names: dict[str, str]) -> DataFrame:
    """JSON text as columns (name: FIELD), blank text as null."""
    parsed = df.withColumn("_j", F.from_json(column, schema))
    return parsed.select(*(c for c in df.columns if c != column), *(F.col(f"_j.{src}").alias(dst) for dst, src in names.items()))


def file_references(df: DataFrame, source_type: str, source_field: str, parent: str, ids: str) -> DataFrame:
    """A row per file id of an array column, with its place; a row without id where the field is missing or empty."""
    exploded = df.select(F.lit(source_type).alias("source_type"), F.lit(source_field).alias("source_field"), F.col(parent).alias("parent_id"), F.col(ids).isNotNull().alias("has_field"), (F.coalesce(F.size(ids), F.lit(0)) <= 0).alias("is_empty"), F.posexplode_outer(ids).alias("file_index", "file_id"))
    return exploded.withColumn("file_index", F.coalesce("file_index", F.lit(0)))


def new_file_rows(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows not stored yet, each once: a row without file id is known by its first three columns."""
    three = ["source_type", "source_field", "parent_id"]
    key = F.when(F.col("file_id").isNull(), F.concat_ws("|", *three)).otherwise(F.concat_ws("|", *three, "file_id", F.col("file_index").cast("string")))
    fresh = found.withColumn("_key", key).dropDuplicates(["_key"])
    return fresh.join(stored.withColumn("_key", key).select("_key"), "_key", "left_anti").drop("_key")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def refresh(spark: SparkSession, builders: dict, folder: str) -> dict[str, str]:
    """Rebuild views (name: function giving a DataFrame); a failure is reported and does not stop the others."""
    out = {}
    for name, build in builders.items():
        try:
            write_table(build(spark), f"{folder}/{name}")
            out[name] = "ok"
        except Exception as e:  # noqa: BLE001  reported per view
            out[name] = f"failed: {type(e).__name__}"
    return out
