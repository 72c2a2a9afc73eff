"""Exact de-duplication by deterministic block naming.

Every normalised text is cut into fixed-size byte blocks. Distinct blocks are sorted and get integer names; then
adjacent names are paired and each distinct pair gets a name of its own, again and again, until one name is left per
document. Two documents have the same number of blocks and the same last name if and only if their bytes are equal, so
the identity has no collisions: hashes only place blocks in partitions, and where two blocks share a hash the names are
joined on the bytes themselves.

Defined results: null texts count as empty; empty texts are equal to each other; rows may repeat (each is a row of the
result, and of rows that also share the largest doc_id exactly one stays); a null doc_id loses against any other;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize, numbered, read, small_batches

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _blocks(text: str | None, size: int) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


def _key(block: bytes, bits: int) -> int:
    return int.from_bytes(hashlib.blake2b(block, digest_size=8).digest(), "big", signed=True) >> (64 - bits)


def _described(batches: Iterator[pa.RecordBatch], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row per document: doc_id, SHA-256 of the normalised bytes, and the partition keys of its blocks."""
    for batch in batches:
        sha, keys = [], []
        for text in batch["text"].to_pylist():
            blocks = _blocks(text, size)
            sha.append(hashlib.sha256(b"".join(blocks)).hexdigest())
            keys.append([_key(b, bits) for b in blocks])
        yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(sha, pa.string()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_sha256", "keys"])


def _exploded(batches: Iterator[pa.RecordBatch], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row per distinct block of a batch (copies within a batch are left out before the shuffle)."""
    for batch in batches:
        seen = dict.fromkeys(b for text in batch["text"].to_pylist() for b in _blocks(text, size))
        yield pa.RecordBatch.from_arrays([pa.array([_key(b, bits) for b in seen], pa.int64()), pa.array(list(seen), pa.binary())], names=["key", "block"])


def _positions(batches: Iterator[pa.RecordBatch], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row per block with its bytes; only for blocks whose key is shared by other bytes."""
    for batch in batches:
        rows = [(sha, i, _key(b, bits), b) for text in batch["text"].to_pylist() for blocks in [_blocks(text, size)] for sha in [hashlib.sha256(b"".join(blocks)).hexdigest()] for i, b in enumerate(blocks)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["text_sha256", "pos", "key", "block"])


def _named(pairs: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Sort the distinct rows of pairs into integer names; n: how many rows have each."""
    return numbered(pairs.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), name, columns)


def _level(level: DataFrame, names: DataFrame) -> DataFrame:
    """level (row, n_blocks, pos, key) joined with its names (key, name), also where one block is in very many texts."""
    sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    return join_groups(level, materialize(names.join(sizes, "key"), "sized-names"), ["key"], "_n").drop("_n")


def identities(docs: DataFrame, block_bytes: int = 4096, key_bits: int = 64) -> DataFrame:
    """A row per document: row, doc_id, text_sha256, n_blocks and name; (n_blocks, name) is the identity of its text.

    key_bits is for tests: with few bits many blocks share a partition key, which must not change any result."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    meta = docs.mapInArrow(lambda it: _described(it, block_bytes, key_bits), "doc_id long, text_sha256 string, keys array<long>")
    meta = materialize(meta.select(F.monotonically_increasing_id().alias("row"), "*"), "meta")
    distinct = docs.mapInArrow(lambda it: _exploded(it, block_bytes, key_bits), "key long, block binary")
    names = _named(distinct, ["key", "block"], "name")
    level = meta.select("row", F.size("keys").alias("n_blocks"), F.posexplode("keys").alias("pos", "key"))
    light = materialize(names.select("key", "name"), "names")
    shared = light.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    if not shared.isEmpty():  # two different blocks with one 64-bit key: name these by their bytes
        names = materialize(names, "full-names")
        light = names.select("key", "name")  # one numbering for all
        at = docs.mapInArrow(lambda it: _positions(it, block_bytes, key_bits), "text_sha256 string, pos int, key long, block binary")
        exact = at.join(shared, "key", "left_semi").join(names, ["key", "block"]).groupBy("text_sha256", "pos").agg(F.first("name").alias("exact"))
        level = level.join(meta.select("row", "text_sha256"), "row").join(exact, ["text_sha256", "pos"], "left").drop("text_sha256")
        light = light.groupBy("key").agg(F.min("name").alias("name"))
        level = _level(materialize(level, "keyed-level"), light).select("row", "n_blocks", "pos", F.coalesce("exact", "name").alias("name"))
    else:
        level = _level(level, light).select("row", "n_blocks", "pos", "name")
    level = materialize(level, "level")
    done = level.where("n_blocks = 1").select("row", "name")
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    level = level.where("n_blocks > 1").select("row", "pos", "name")
    while longest > 1:
        half = (F.col("pos") / 2).cast("int")
        pairs = level.groupBy("row", half.alias("pos")).agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = materialize(pairs, "pairs")
        level = materialize(join_groups(pairs, materialize(_named(pairs, ["a", "b"], "name"), "pair-names"), ["a", "b"], "n").select("row", "pos", "name"), "level")
        longest = (longest + 1) // 2
    return meta.withColumn("n_blocks", F.size("keys")).drop("keys").join(done.unionByName(level.select("row", "name")), "row")


def exact_dedup(docs: DataFrame, block_bytes: int = 4096, key_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: of equal texts the row with the largest doc_id stays."""
    with small_batches(docs.sparkSession):
        rows = materialize(identities(docs, block_bytes, key_bits), "identities")
    groups = materialize(rows.groupBy("n_blocks", "name").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")), "groups")
    return join_groups(rows, groups, ["n_blocks", "name"], "group_size").select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(read(spark, sf_dir, "documents"))


QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLE_SQL = {
    "op5_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256 FROM t JOIN g ON t.body = g.body"""
}
