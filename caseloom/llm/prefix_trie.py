"""Prefix trie of conversations, with subtree totals by leaf-peeling message passing.

A node of depth d is a distinct sequence of d turns; a 128-bit BLAKE2b digest, chained turn by turn, names it. Texts are
digested where they are numbered and never move again.

The smallest member of a node is also the smallest one of some child until it ends, so nodes of one smallest member are a
path that runs from some depth to that conversation's last turn. Paths are what messages pass between: each holds a
counter of the children that hang off its nodes (the tops of other paths) and are not done; a path whose counter is 0 is
complete, sends its totals of leaves and tokens to the node that its top hangs off, and that node's path counts one child less, until
only the root's path finishes. A caterpillar of any length is one round, and every round is a join of a few numbers per
path that is left. Within a path, totals of its nodes are sums from the end upwards, over their own values and what was
sent to them.

Defined results: turns are in the order of turn (nulls first), then role, then text, so repeated turns stay side by side in one order;
a null role or text counts as empty; rows of a null conv_id take no part (a conversation without a number has no
rebuilt form); a conversation whose rebuilt form has no turn is a member of the root; the turns of one conversation pass
one task as a stream and are never held together, and so do the ids of one node's ends (a digest of one sequence), in
pieces prepared elsewhere; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import join_groups, materialize, read

MODULUS, HEADS = 5, 9
ROOT = bytes(16)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv, i (from 1), digest, bytes: turns in order; digest tells role and text, bytes is the text's length in UTF-8."""
    own = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    i = F.row_number().over(W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    named = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    return own.withColumn("i", i).select("conv", "i", named.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


def rebuilt(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """conv, i, digest, bytes of rebuilt conversations: the first `heads` turns (at most `most`) of conversation `base`, then
    the own ones after so many; both are columns of conv. Each conversation has a row of i = 0 too, without a digest."""
    convs = materialize(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select("conv", base.alias("base"), heads.alias("heads")), "conversations")
    first = turns.where(F.col("i") <= most).select(F.col("conv").alias("base"), "i", "digest", "bytes")
    other = convs.where("base <> conv AND heads > 0")  # a conversation that starts like itself stays as it is
    lent = first.join(other, "base").where("i <= heads").select("conv", "i", "digest", "bytes")
    own = turns.withColumn("base", base).withColumn("heads", heads).where("base = conv OR i > heads").select("conv", "i", "digest", "bytes")
    start = convs.select("conv", F.lit(0).alias("i"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return start.unionByName(lent).unionByName(own)


_PREFIXES = "conv long, depth long, node binary, parent binary, bytes long, last boolean"


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conv and i. A row per prefix; the last one of a conversation waits for the next."""
    waiting = None
    names = [x.split()[0] for x in _PREFIXES.split(", ")]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        rows = []
        for conv, digest, size in zip(batch["conv"].to_pylist(), batch["digest"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
            if waiting:
                rows.append((*waiting, digest is None))
            if digest is None:
                waiting = (conv, 0, ROOT, None, 0)
            else:
                waiting = (conv, waiting[1] + 1, hashlib.blake2b(waiting[2] + digest, digest_size=16).digest(), waiting[2], size)
        if rows:
            yield table(rows)
    if waiting:
        yield table([(*waiting, True)])


def _pieces(batches: Iterator[pa.RecordBatch], ids: int) -> Iterator[pa.RecordBatch]:
    """node, first, piece: consecutive ids of a node, comma-joined, at most so many. Rows come sorted by node and conv."""
    for batch in batches:
        rows: list[list] = []
        for node, conv in zip(batch["node"].to_pylist(), batch["conv"].to_pylist(), strict=True):
            if not rows or rows[-1][0] != node or len(rows[-1][2]) == ids:
                rows.append([node, conv, []])
            rows[-1][2].append(str(conv))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([",".join(r[2]) for r in rows], pa.string())], names=["node", "first", "piece"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, ends_sha256. Rows come sorted by node and first."""
    node, digest = None, None

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"])

    for batch in batches:
        rows = []
        for own, piece in zip(batch["node"].to_pylist(), batch["piece"].to_pylist(), strict=True):
            if own != node:
                if digest:
                    rows.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield table(rows)
    if digest:
        yield table([(node, digest.hexdigest())])


def end_digests(prefixes: DataFrame, ids: int = 4096) -> DataFrame:
    """node, ends_sha256 for the nodes where conversations end. Ids are sorted over ranges, so those of one node become
    pieces in many tasks; one task then runs over a node's pieces."""
    ends = prefixes.where("last").select("node", "conv")
    pieces = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(lambda it: _pieces(it, ids), "node binary, first long, piece string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, ends_sha256 string")


def peel(paths: DataFrame) -> DataFrame:
    """path, leaves, saved: totals below and at the top of each path. paths: path, up (the path that its top hangs off; null
    for the root's), children (how many tops hang off it), leaves and saved of its own nodes."""
    left, done = materialize(paths.select("path", "up", "children", "leaves", "saved"), "paths"), None
    while True:
        complete = left.where("children = 0")
        done = complete.select("path", "leaves", "saved") if done is None else done.unionByName(complete.select("path", "leaves", "saved"))
        rest = left.where("children > 0")
        if rest.isEmpty():
            return done
        sent = complete.groupBy(F.col("up").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        more = lambda c, by: F.col(c) + F.coalesce(F.col(by), F.lit(0))
        rest = rest.join(sent, "path", "left").select("path", "up", (F.col("children") - F.coalesce("n", F.lit(0))).alias("children"), more("leaves", "more_leaves").alias("leaves"), more("saved", "more_saved").alias("saved"))
        left = materialize(rest, "paths")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of all prefixes of rebuilt conversations (conv, i, digest, bytes; see `rebuilt`)."""
    prefixes = rows.repartition("conv").sortWithinPartitions("conv", "i").mapInArrow(_prefixes, _PREFIXES)
    prefixes = materialize(prefixes, "prefixes")
    nodes = prefixes.groupBy("node").agg(F.min("conv").alias("path"), F.count(F.lit(1)).alias("n_convs"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes"))
    nodes = materialize(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")), "nodes")
    tops = nodes.groupBy("path").agg(F.min_by("parent", "depth").alias("parent"), F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("own").alias("saved"))
    tops = materialize(tops, "tops")
    # which path each top hangs off; one node may have very many children
    counts = tops.where("top > 0").groupBy("parent").agg(F.count(F.lit(1)).alias("n"))
    parents = materialize(counts.join(nodes.select(F.col("node").alias("parent"), F.col("path").alias("up")), "parent"), "parents")
    hung = join_groups(tops.where("top > 0"), parents, ["parent"], "n").select("path", "top", "bottom", "saved", "up")
    hung = materialize(hung.unionByName(tops.where("top = 0").select("path", "top", "bottom", "saved", F.lit(None).cast("long").alias("up"))), "hung")
    held = hung.where("up IS NOT NULL").groupBy(F.col("up").alias("path"), (F.col("top") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n"))
    held = held.groupBy("path").agg(F.sum("n").alias("children"), F.max("depth").alias("lowest"))
    paths = hung.join(held, "path", "left").select(
        "path", "up", F.coalesce("children", F.lit(0)).cast("long").alias("children"), F.when(F.col("lowest") == F.col("bottom"), 0).otherwise(1).cast("long").alias("leaves"), "saved"
    )
    totals = materialize(peel(paths), "totals")
    # every node: its own values and what was sent to it, summed from the end of its path upwards
    sent = hung.where("up IS NOT NULL").join(totals.withColumnRenamed("saved", "total"), "path")
    sent = sent.groupBy(F.col("up").alias("path"), (F.col("top") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("hanging"), F.sum("leaves").alias("sent_leaves"), F.sum("total").alias("sent_saved"))
    hanging = F.coalesce("hanging", F.lit(0))
    along = W.partitionBy("path").orderBy(F.desc("depth"))
    shown = nodes.join(sent, ["path", "depth"], "left").join(hung.select("path", "top", "up"), "path")
    last = F.lag("depth").over(along).isNull()
    shown = shown.withColumn("n_children", hanging + F.when(last, 0).otherwise(1))
    below = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    total = lambda own, by: F.sum(own + F.coalesce(by, F.lit(0))).over(below).cast("long")
    shown = shown.withColumn("n_leaves", total(F.when(F.col("n_children") == 0, 1).otherwise(0), "sent_leaves")).withColumn("saved_tokens", total(F.col("own"), "sent_saved"))
    parent = F.when(F.col("depth") == F.col("top"), F.col("up")).otherwise(F.col("path"))
    return shown.join(end_digests(prefixes), "node", "left").select(
        F.col("path").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, sf_dir):
    turns = materialize(numbered_turns(read(spark, sf_dir, "conversations")), "turns")
    conv = F.col("conv")
    return trie(rebuilt(turns, conv - conv % MODULUS, (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int"), HEADS - 1))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
#: CRC-32 of the text x, bit by bit (a fixed polynomial).
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({x}, ''), lambda c: CAST(ord(c) AS BIGINT))), lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda s, i: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295)"
ORACLE_SQL = {
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, sha256(concat(length(coalesce(role, '')), ':', role, text)) AS k, strlen(coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 5 AS base, {_CRC.format(x="CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, t.i, t.k, t.b FROM h JOIN t ON t.c = h.base AND t.i <= h.h UNION ALL SELECT t.c, t.i, t.k, t.b FROM t JOIN h ON t.c = h.c AND t.i > h.h),
p AS MATERIALIZED (SELECT c, row_number() OVER w AS d, sha256(string_agg(k, '') OVER w) AS node, b FROM r WINDOW w AS (PARTITION BY c ORDER BY i)
  UNION ALL SELECT c, 0, '', 0 FROM h),
e AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS last FROM p),
n AS MATERIALIZED (SELECT node, min(c) AS conv_id, any_value(d) AS depth, any_value(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * any_value(b) AS own,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256 FROM e GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
s AS (SELECT u.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum(v.own) AS saved_tokens
  FROM (SELECT DISTINCT a.node, b.node AS under FROM p a JOIN p b ON a.c = b.c AND b.d >= a.d) u JOIN n v ON v.node = u.under LEFT JOIN k ON k.node = u.under GROUP BY u.node)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n q ON q.node = n.parent"""
}
