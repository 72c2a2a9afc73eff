"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import remove, shared_dir

#: A word, as all contracts of this subpackage define it (same in Java, RE2 and Python).
WORD = r"[^\x20\x09-\x0D]+"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Whole texts go to Python in batches of so few rows, for what is computed inside: a batch of long texts stays
    within a few MB on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Where tables are written while some caller wants to know, to remove them later.
_noted: list[list[str]] = []


@contextmanager
def noted_tables() -> Iterator[list[str]]:
    """The paths of all tables that are materialized inside."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted[:] = [x for x in _noted if x is not paths]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/caseloom-{name}-{uuid.uuid4().hex}"
    for paths in _noted:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_stage(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What make() gives, as a table of the shared folder; all other tables that were written for it are removed."""
    with noted_tables() as paths:
        out = materialize(make(), name)
    for path in paths[:-1]:
        remove(spark, path)
    return out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of a key's decimal text, modulo modulus: the split into learning and held-out rows."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(modulus)


def numbered(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """A unique long per row: partitions are sorted first, so a recomputed partition gives the same numbers."""
    return df.sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, parts: int = 2000, least: int = 64) -> DataFrame:
    """rows joined with groups (a row per key, with the number of rows that have it in `size`) on keys without nulls. A key
    of more than 1/parts of all rows is dealt to pieces of that size, so that no task gets a large group; the keys that
    are dealt, at most `parts`, are broadcast."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    piece = max(least, -(-total // parts))
    dealt = groups.withColumn("_pieces", F.ceil(F.col(size) / F.lit(piece)).cast("int"))
    hot = materialize(dealt.where("_pieces > 1").select(*keys, "_pieces"), "hot-keys")  # at most `parts` rows
    own = rows.join(F.broadcast(hot), keys, "left").withColumn("_piece", F.pmod(F.xxhash64(*rows.columns), F.coalesce("_pieces", F.lit(1))).cast("int")).drop("_pieces")
    every = dealt.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_pieces"), F.lit(1)) - 1))).drop("_pieces")
    return own.join(every, [*keys, "_piece"]).drop("_piece")


def possibly_in(rows: DataFrame, key: str, keys: DataFrame, most_bits: int = 1 << 27) -> DataFrame:
    """rows (key: a long column) without most of those whose key is not among `keys` (its one long column), as a step
    before a join that decides: it keeps wide rows out of that join's shuffle. The keys become a bitmap of 16 bits a key,
    at most most_bits (16 MB), in rows of 4 KB that are broadcast; beyond that more rows pass, and none is lost."""
    name = keys.columns[0]
    keys = keys.where(F.col(name).isNotNull())
    bits = 1 << 15
    while bits < min(16 * keys.count(), most_bits):
        bits *= 2
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    placed = keys.select(place(name).alias("_place")).select(F.bitmap_bucket_number("_place").alias("_bucket"), F.bitmap_bit_position("_place").alias("_at"))
    maps = placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_map"))
    word = lambda i: F.conv(F.hex(F.substring("_map", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = materialize(maps.select("_bucket", F.transform(F.sequence(F.lit(0), F.lit(511)), word).alias("_words")), "bitmap")
    own = place(F.col(f"r.`{key}`"))
    at = F.bitmap_bit_position(own)
    bit = F.getbit(F.element_at(F.col("m._words"), (F.floor(at / 64) + 1).cast("int")), ((F.lit(7) - F.floor(at / 8) % 8) * 8 + at % 8).cast("int"))
    return rows.alias("r").join(F.broadcast(words.alias("m")), F.bitmap_bucket_number(own) == F.col("m._bucket")).where((bit == 1) & F.col(f"r.`{key}`").isNotNull()).select("r.*")
