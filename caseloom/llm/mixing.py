"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Sources share a word budget by weight, no source above `most_epochs` times its size; what is above is shared again by
weight. In the order of cap / weight the sources that end at their cap come first; the level of the others is that of the
first source whose cap it does not exceed (levels fall from there on). Of a source's target the complete epochs come
first: every document once per epoch. The rest is drawn without replacement: each document gets the exponential key
-ln(u) / quality weight, u from a digest of its doc_id, and documents are taken in key order while the running sum of
their sizes stays nearest to what is left of the target.

No running sum gathers its rows in one task. Sources are numbered and added up over ranges, whose totals give offsets.
The keys of a source fall into ordered buckets of about `bucket_rows` documents (by the distribution that the weights of
its documents give the keys), bucket totals give each bucket its offset, and only a bucket is sorted as one group.

Defined results: null texts have size 0; a null source is a source of its own, after all others; sources of size 0 have
target 0; repeated rows are separate documents with one key, their ties are interchangeable; rows of a null doc_id get
their key from the text; an empty table gives an empty result; other columns are ignored by `mix` and kept by
`mixed_documents`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, join_groups, materialize, read

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET_SHARE = 1.5
MOST_EPOCHS = 2
#: Quality weight of a document by its label; unlabelled ones weigh 1.
GOOD, BAD = 2.0, 0.5


def quality_weight(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with `_weight`, from labels.quality (the best of several labels)."""
    best = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_labelled")).agg(F.max("quality").alias("_quality"))
    joined = docs.join(best, docs["doc_id"] == best["_labelled"], "left")
    return joined.withColumn("_weight", F.when(F.col("_quality") == 1, F.lit(GOOD)).when(F.col("_quality") == 0, F.lit(BAD)).otherwise(F.lit(1.0))).drop("_labelled", "_quality")


def _in_ranges(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """rows with running sums (the row itself left out) in an order without ties: ranges of the order are sorted one by
    one, and the totals of the ranges, a row per partition, give their offsets."""
    ranges = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_range").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col("_range").alias("_at"), *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    within = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    near = ranges.select("*", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(n) for n, c in sums.items()))
    joined = near.join(F.broadcast(offsets), F.col("_range") == F.col("_at"))
    return joined.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).select(*rows.columns, *sums)


def targets(sizes: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """sizes with target: a row per source, which has source and source_size."""
    name = [F.col("source").isNull(), F.col("source")]
    numbered = _in_ranges(sizes, name, {"nth": F.lit(1)})
    weight = reduce(lambda c, k: F.when(F.col("nth") % len(weights) == k, F.lit(weights[k])).otherwise(c), range(len(weights)), F.lit(0.0))
    caps = numbered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most_epochs))).withColumn("fill", F.col("cap") / F.col("weight"))
    filled = _in_ranges(caps, [F.col("fill"), *name], {"cap_before": F.col("cap"), "weight_before": F.col("weight")})
    total = filled.agg((F.sum("source_size") * F.lit(float(budget_share))).alias("budget"), F.sum("weight").alias("all_weights"))  # one row
    levels = filled.join(F.broadcast(total)).withColumn("level", (F.col("budget") - F.col("cap_before")) / (F.col("all_weights") - F.col("weight_before")))
    water = levels.agg(F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).alias("water"))  # one row
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("water")))
    return filled.join(F.broadcast(water)).select(*sizes.columns, target.alias("target"))


def uniform(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """In (0, 1], from 48 bits of MD5 of the doc_id (of the text where that is null): the same on every run and engine."""
    own = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, 12), 16, 10).cast("double") + 1) / F.lit(float(2**48))


def mix(docs: DataFrame, labels: DataFrame | None = None, bucket_rows: int = 4096, **shares) -> DataFrame:
    """doc_id, text_key, size, source_size, target, times, taken: a row per row of docs, which has doc_id, text, source.
    times: how often the whole document is in the mix; taken = times * size."""
    text = F.col("text").cast("string")
    measured = docs.select("doc_id", "source", F.xxhash64(text).alias("text_key"), uniform(F.col("doc_id"), text).alias("u"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    weighed = quality_weight(measured, labels) if labels is not None else measured.withColumn("_weight", F.lit(1.0))  # texts stay behind
    sized = materialize(weighed.select("doc_id", "source", "text_key", "size", (-F.log("u") / F.col("_weight")).alias("key"), "_weight"), "sized")
    of_weight = lambda w: F.count_if(F.col("_weight") == w)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"), of_weight(GOOD).alias("n_good"), of_weight(BAD).alias("n_bad"))
    plan = materialize(targets(sizes, **shares), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(bucket_rows)))
    plain = F.col("n_docs") - F.col("n_good") - F.col("n_bad")
    above = F.col("n_good") * F.exp(-GOOD * F.col("key")) + F.col("n_bad") * F.exp(-BAD * F.col("key")) + plain * F.exp(-F.col("key"))
    bucket = F.least(n_buckets - 1, F.floor((1 - above / F.col("n_docs")) * n_buckets))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    of = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("of")  # a key without nulls
    known = plan.withColumn("epochs", epochs).select(of, *(c for c in plan.columns if c != "source"), "epochs")
    # however many sources there are, one that has a large share of all rows is dealt to many tasks
    rows = join_groups(sized.select("*", of), known, ["of"], "n_docs").withColumn("rest", rest).withColumn("bucket", bucket)
    totals = rows.groupBy("of", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = totals.withColumn("before", F.coalesce(F.sum("in_bucket").over(W.partitionBy("of").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    within = W.partitionBy("of", "bucket").orderBy("key", "doc_id", "size", "text_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = rows.withColumn("run", F.sum("size").over(within)).join(before.select("of", "bucket", "before"), ["of", "bucket"])
    middle = F.col("before") + F.col("run") - F.col("size") / 2
    times = F.col("epochs") + F.when((F.col("size") > 0) & (middle <= F.col("rest")), F.lit(1)).otherwise(F.lit(0))
    return run.select("doc_id", "text_key", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The columns of docs, each row as many times as the mix takes its document (rows that repeat a document alike)."""
    taken = mix(docs, labels, **options)
    taken = taken.groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).agg(F.max("times").cast("int").alias("_times")).where("_times > 0")
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_doc"]) & (F.xxhash64(docs["text"].cast("string")) == taken["_key"]))
    return joined.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*(docs[c] for c in docs.columns))


def op10_mixing(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op10_mixing": op10_mixing}
#: Targets by sharing again: round by round, what sources above their cap leave is shared among the others by weight.
ORACLE_SQL = {
    "op10_mixing": rf"""
WITH RECURSIVE q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '{WORD}')), 0) AS size,
  -ln((CAST(concat('0x', substr(md5(concat('mix:', coalesce(CAST(d.doc_id AS VARCHAR), md5(coalesce(d.text, ''))))), 1, 12)) AS BIGINT) + 1) / 281474976710656.0) / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS MATERIALIZED (SELECT source, source_size, CASE nth % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap, (SELECT sum(source_size) FROM s) * 1.5::DOUBLE AS budget FROM s),
share AS (SELECT 0::DOUBLE AS per_weight
  UNION SELECT (max(w.budget) - coalesce(sum(w.cap) FILTER (WHERE w.weight * share.per_weight > w.cap), 0)) / sum(w.weight) FILTER (WHERE w.weight * share.per_weight <= w.cap) FROM share, w GROUP BY share.per_weight),
t AS (SELECT source, source_size, least(cap, weight * (SELECT max(per_weight) FROM share)) AS target FROM w),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2.0 AS middle FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN size > 0 AND middle <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""
}
