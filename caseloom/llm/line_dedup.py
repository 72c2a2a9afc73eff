"""Line de-duplication over overlapping three-line windows, with DataFrame functions only.

Each run of three consecutive lines is one window, named by the 128-bit MD5 of its text. Windows that occur more than
once in the whole collection keep their first occurrence (smallest doc_id, among texts of one doc_id by a digest of the
text, then smallest line number); the lines of all later occurrences are covered, overlapping and touching covers are
merged into spans, and the spans are removed.

Only digests are shuffled for the search; counts are combined before the shuffle, so one very common window costs one
row per task, and its occurrences meet its first one in pieces. Texts move once, to meet the few spans of their document.

Defined results: lines are what "\\n" separates, kept byte for byte; a null text has no lines and stays null; documents
of fewer than three lines have no window and stay as they are; rows that repeat both doc_id and text count as one
document and get the same result each; a null doc_id sorts before all others; an empty table gives an empty result.
All columns of the input are kept by `deduplicate_lines`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import join_groups, materialize, read

WINDOW = 3


def windows(docs: DataFrame) -> DataFrame:
    """doc, text_key, pos, window: a row per run of three lines (pos from 0)."""
    lines = F.split("text", "\n", -1)
    digests = F.transform(F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1)), lambda i: F.unhex(F.md5(F.concat_ws("\n", *(F.element_at("lines", i + k) for k in range(WINDOW))))))
    return (
        docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("text_key"), lines.alias("lines"))
        .where(F.size("lines") >= WINDOW)
        .select("doc", "text_key", F.posexplode(digests).alias("pos", "window"))
    )


def removed_spans(docs: DataFrame) -> DataFrame:
    """doc, text_key, spans: array<struct<lo, hi>> of merged line numbers that later occurrences cover."""
    found = materialize(windows(docs), "windows")
    place = F.struct("doc", "text_key", "pos")
    repeated = materialize(found.groupBy("window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    later = join_groups(found, repeated, ["window"], "n").where(~place.eqNullSafe(F.col("first"))).select("doc", "text_key", "pos").distinct()
    own = W.partitionBy("doc", "text_key").orderBy("pos")
    gap = F.coalesce((F.col("pos") - F.lag("pos").over(own) > WINDOW).cast("int"), F.lit(1))
    merged = later.withColumn("gap", gap).withColumn("run", F.sum("gap").over(own)).groupBy("doc", "text_key", "run").agg(F.min("pos").alias("lo"), (F.max("pos") + (WINDOW - 1)).alias("hi"))
    return merged.groupBy("doc", "text_key").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def deduplicate_lines(docs: DataFrame, result: str = "line_dedup") -> DataFrame:
    """docs with a struct column `result`: text (what is left), n_lines, n_removed, spans."""
    spans = removed_spans(docs)
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    joined = docs.alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc")) & (F.xxhash64("d.text") == F.col("s.text_key")), "left")
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    lines, cover = F.split("d.text", "\n", -1), F.coalesce("s.spans", none)
    kept = F.filter(lines, lambda _, i: ~F.exists(cover, lambda s: (i >= s.lo) & (i <= s.hi)))
    removed = F.aggregate(cover, F.lit(0), lambda a, s: a + s.hi - s.lo + 1)
    digest = F.struct(
        F.when(F.col("s.doc").isNull() & F.col("s.text_key").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        cover.alias("spans"),
    )
    return joined.select(*own, digest.alias(result))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The columns of docs; text without the lines of repeated windows, n_chars (if there is one) of the new text."""
    out = deduplicate_lines(docs, "_dedup")
    new = {"text": F.col("_dedup.text")} | ({"n_chars": F.coalesce(F.length("_dedup.text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return out.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def op8_line_dedup(spark, sf_dir):
    out = deduplicate_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), "r")
    return out.select("doc_id", "r.n_lines", "r.n_removed", F.size("r.spans").cast("long").alias("n_spans"), F.sha2(F.coalesce("r.text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op8_line_dedup": op8_line_dedup}
#: Rows (doc_id, i, line, gone): every line and whether a later occurrence of a repeated window covers it.
COVERED_SQL = """
l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs} WHERE text IS NOT NULL),
p AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l),
w AS (SELECT doc_id, i, md5(concat_ws(chr(10), ls[i], ls[i + 1], ls[i + 2])) AS k FROM p WHERE i <= len(ls) - 2),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM w),
c AS (SELECT DISTINCT doc_id, i + d AS i FROM r, (VALUES (0), (1), (2)) AS v(d) WHERE nth > 1),
covered AS (SELECT p.doc_id, p.i, p.ls[p.i] AS line, c.i IS NOT NULL AS gone FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.i = c.i)"""
ORACLE_SQL = {
    "op8_line_dedup": "WITH" + COVERED_SQL.format(docs="documents") + """,
f AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM covered),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id"""
}
