import glob
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from caseloom.llm import line_dedup, mixing, packing, registry, toxicity
from caseloom.llm.common import materialize, noted_tables

from .helpers import awkward, jaccard_components

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_references(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stage = dict(corpus_pipeline.STAGES)

    clean = materialize(stage["toxicity"](spark, docs, SF), "t")
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns
    assert sum(d in kept for d, y in labels.items() if not y) >= 0.98 * sum(not y for y in labels.values())
    assert kept == {r.doc_id for r in docs.collect()} - {r.doc_id for r in toxicity.op1_toxicity(spark, SF).where("predicted = 1").collect()}

    out = materialize(stage["line_dedup"](spark, clean, SF), "l")
    assert out.columns == columns and out.count() == clean.count()
    con = duckdb.connect()
    con.register("clean", clean.toPandas())
    sql = "WITH" + line_dedup.COVERED_SQL.format(docs="clean") + " SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') FROM covered GROUP BY doc_id"
    assert dict(con.execute(sql).fetchall()) == {r.doc_id: r.text for r in out.collect()}

    one = materialize(stage["ngram_join"](spark, out, SF), "n")
    rows = [(r.doc_id, r.text) for r in out.collect()]
    expected = jaccard_components(rows, 5, 8, 10)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {d for d, t in rows if expected[d, t][1] == d or not expected[d, t][0]}

    mixed = materialize(stage["mixing"](spark, one, SF), "m")
    assert mixed.columns == columns and mixed.count() > one.count() > 0
    times = Counter(r.doc_id for r in mixed.collect())
    con.register("documents", one.toPandas())
    con.execute(f"CREATE VIEW labels AS SELECT * FROM '{SF}/labels.parquet'")
    taken = con.execute(f"SELECT doc_id, taken // size FROM ({mixing.ORACLE_SQL['op10_mixing']}) WHERE size > 0").fetchall()
    assert all(times[d] == n for d, n in taken) and len(taken) > 100
    packed = stage["packing"](spark, mixed, SF).collect()
    assert len(packed) >= mixed.count()
    encoder = packing.encoder(packing.default_tokenizer())
    assert sum(p.length for p in packed) == sum(len(encoder.ids(r.text or "")) + 1 for r in mixed.collect())


def test_toxic_documents_leave_and_clean_ones_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, folder).select("doc_id").collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    toxic, clean = [d for d, y in labels if y], [d for d, y in labels if not y]
    assert sum(d not in kept for d in toxic) >= 0.95 * len(toxic) and sum(d in kept for d in clean) >= 0.995 * len(clean)


@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_pipeline_of_awkward_and_of_no_documents(spark, tmp_path, rows):
    """Nulls in every column, blank and repeated texts, and an empty table go through all stages."""
    docs = [(d, t, None if i % 3 else "en", s, None if i % 2 else 1) for i, (d, t, s) in enumerate(awkward())] if rows == "awkward" else []
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1), (10, None, None)][: len(docs)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    with noted_tables() as tables:
        packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (len(packed) > 10) == bool(docs) and all(p.length > 0 for p in packed)
    left = [t for t in tables if glob.glob(f"{t.removeprefix('file:')}*")]
    assert len(left) < len(tables) and sum("-stage-" in t for t in left) == len(corpus_pipeline.STAGES) - 1


def test_every_query_is_registered():
    assert {name.split("_")[0] for name in registry.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
