"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within three bits meet at a variant in their middle: one that differs from the one in one bit at most and
from the other in two. Every distinct fingerprint emits its variants within half the radius (1.5: one bit, or two where
that is needed), and variants are shuffled to meet. What has to be emitted follows from parity:

- fingerprints three bits apart differ in the parity of their bits. The odd one emits its 64 neighbours, the even one its
  variants of two bits. Of three differing bits two lie in the same half of the fingerprint, so the even one only needs
  the 992 pairs of bits within a half;
- one bit apart: the even one itself is a neighbour of the odd one;
- two bits apart: two odd ones share a neighbour, and so do two even ones, which emit their 64 neighbours too.

At a variant, those within one bit of it are centres: each is within three bits of all that meet there, so every
other member is linked to the smallest centre, one link a member, and members without a centre need no link there. Links are
de-duplicated, verified by the number of differing bits, and their components are reported. A variant is met by
at most 2081 distinct fingerprints, so no list grows with the data; texts that share a fingerprint are one class from the start.

Fingerprints are computed where texts are read: a bit is 1 if it is set in over half of the hashes (XXH64, seed 42) of
the word 3-grams, repeats included. Nothing but fingerprints is shuffled.

Defined results: null, empty and blank texts have no word and the fingerprint zero, which links like any other; texts of
fewer words than n count as one n-gram; rows that repeat a doc_id are documents each; a null doc_id never names a component
that has another one (component_id is null if it has none); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize, read, small_batches
from .components import components

BITS, RADIUS = 64, 3
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


#: What differs from a fingerprint in one bit, and in two bits of one half.
SINGLES = [_signed(1 << i) for i in range(BITS)]
PAIRS = [_signed(1 << i | 1 << j) for j in range(BITS) for i in range(j) if i // 32 == j // 32]


def fingerprint(text: str | None, n: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line, hashed = memoryview(b" ".join(words)), xxhash.xxh64_intdigest
    if len(words) <= n:
        return hashed(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1)
    starts = np.r_[0, ends[:-n]].tolist()
    hashes = np.fromiter((hashed(line[a:z], seed) for a, z in zip(starts, (ends[n - 1 :] - 1).tolist(), strict=True)), "<u8", len(starts))
    votes = np.zeros(BITS, "i8")
    for a in range(0, len(hashes), 1 << 16):  # a byte per bit, of so many hashes at a time
        votes += np.unpackbits(hashes[a : a + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py(), n) for t in batch["text"]], "u8").view("i8")
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints)], names=["doc_id", "print"])


def _variants(prints: DataFrame, masks: list[int]) -> DataFrame:
    """print, mask, variant: what differs from a fingerprint by a mask."""
    return prints.select("print", F.explode(F.array(*map(F.lit, masks))).alias("mask")).withColumn("variant", F.col("print").bitwiseXOR(F.col("mask")))


def links(prints: DataFrame) -> DataFrame:
    """a, b: links that connect all distinct fingerprints (print: long) of at most three differing bits."""
    even = prints.where(F.bit_count("print") % 2 == 0)
    near = _variants(prints, SINGLES).unionByName(_variants(even, [0]))
    # the smallest centre of a variant; the masks tell which fingerprints are centres
    centres = near.groupBy("variant").agg(F.min("print").alias("centre"), F.bit_or("mask").alias("masks"), F.max(F.col("mask") == 0).alias("itself"))
    several = centres.where(F.bit_count("masks") + F.col("itself").cast("int") > 1)
    members = F.concat(F.filter(F.array(*map(F.lit, SINGLES)), lambda m: m.bitwiseAND(F.col("masks")) != 0), F.when(F.col("itself"), F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>")))
    among = several.select("centre", F.explode(members).alias("mask"), "variant").select("centre", F.col("variant").bitwiseXOR(F.col("mask")).alias("print"))
    # variants of two bits only meet centres, so these are the hashed side
    beyond = _variants(even, PAIRS).join(centres.select("variant", "centre").hint("shuffle_hash"), "variant").select("centre", "print")
    found = among.unionByName(beyond).where("centre <> print").select(F.least("centre", "print").alias("a"), F.greatest("centre", "print").alias("b")).distinct()
    return found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def simhash_components(docs: DataFrame, n: int = 3) -> DataFrame:
    """doc_id, print, component_id: a row per row of docs; component_id is the smallest doc_id that links reach."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        described = materialize(docs.mapInArrow(lambda it: _fingerprints(it, n), "doc_id long, print long"), "prints")
    classes = materialize(described.groupBy("print").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("n")), "classes")
    # few files of classes make very many variants, so they are spread over all tasks first
    spread = classes.select("print").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "print")
    linked = components(materialize(links(spread), "links"))
    named = classes.join(linked.select(F.col("node").alias("print"), "component"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    named = materialize(named, "named")
    smallest = named.groupBy("component").agg(F.min("own").alias("component_id"), F.count(F.lit(1)).alias("m"))
    names = join_groups(named, smallest, ["component"], "m").select("print", "n", "component_id")
    return join_groups(described, materialize(names, "names"), ["print"], "n").select("doc_id", "print", "component_id")


def op13_simhash(spark, sf_dir):
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op13_simhash": op13_simhash}
ORACLE_SQL: dict[str, str] = {}  # XXH64 of every n-gram is beyond SQL: tests/llm/test_simhash.py compares with brute force
