import itertools
import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from caseloom.llm import quality, toxicity
from caseloom.llm.common import fold

from .helpers import awkward, frame

SF = "/root/testdata/sf0.01"


def held_out_accuracy(spark, out, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.where("held_out").join(labels, "doc_id").select(F.col(label).alias("y"), "predicted", "score").collect()
    return rows, sum(r.y == r.predicted for r in rows) / len(rows)


def average_precision(rows, of):
    """rows: (label, predicted, score)."""
    order = sorted(rows, key=lambda r: -r[2])
    hits, total = 0, 0.0
    for i, row in enumerate(order, 1):
        if row[0] == of:
            hits += 1
            total += hits / i
    return total / hits


def test_toxicity_on_held_out_documents(spark):
    out = toxicity.op1_toxicity(spark, SF)
    rows, accuracy = held_out_accuracy(spark, out, "toxic")
    assert len(rows) > 50 and accuracy > 0.95
    assert average_precision(rows, 1) > 0.9
    learned = out.where("NOT held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("toxic = 1").select("predicted").collect()
    assert sum(r.predicted for r in learned) >= 0.9 * len(learned)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.collect())


def test_toxic_recall_and_precision_on_held_out_documents(spark):
    """On the larger tables, whose labels are enough to tell words of all languages."""
    folder = "/root/testdata/sf0.1"
    out = toxicity.op1_toxicity(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    found, toxic, called = sum(r.toxic and r.predicted for r in out), sum(r.toxic for r in out), sum(r.predicted for r in out)
    assert toxic > 80 and found >= 0.9 * toxic and found >= 0.9 * called


def test_toxic_scores_against_brute_force(spark):
    """Cosines of all pairs of whole texts and examples, votes and curve, without the index's lists and bounds."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), "toxic", fold(F.col("doc_id"), 5) != 0)
    index, texts = model.index.value, {r.doc_id: r.text for r in docs.collect()}
    number = {int(t): i for i, t in enumerate(index.vocabulary)}
    some = sorted(texts)[::7]

    def vectors(ids):
        owner, term, n = toxicity.Terms().of([texts[i] for i in ids])
        m = np.zeros((len(ids), len(number)))
        for o, t, c in zip(owner.tolist(), term.tolist(), n.tolist(), strict=True):
            if t in number:
                m[o, number[t]] = np.sqrt(c) * index.weight[number[t]]
        size = np.sqrt((m * m).sum(1, keepdims=True))
        return m / np.where(size > 0, size, 1)

    cosines = vectors(some) @ vectors(index.doc_ids.tolist()).T
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for doc, row in zip(some, cosines, strict=True):
        best = np.lexsort((np.arange(len(row)), -np.round(row, 12)))[: index.k]
        best = best[row[best] > 0]
        near = 1 / (toxicity.NEAR + np.maximum(0, 1 - row[best]))
        expected = 1 / (1 + np.exp(-(model.curve[0] + model.curve[1] * (near @ (2.0 * index.labels[best] - 1)) / near.sum()))) if len(best) else model.prior
        assert got[doc] == pytest.approx(expected, abs=1e-6)


def test_quality_on_held_out_documents(spark):
    out = quality.op3_quality(spark, SF)
    rows, accuracy = held_out_accuracy(spark, out, "quality")
    assert len(rows) > 50 and accuracy > 0.95
    assert average_precision([(1 - r.y, r.predicted, 1 - r.score) for r in rows], 1) > 0.8  # of the bad ones
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.collect())


def test_terms_are_words_and_stems():
    texts = ["Running, runners! über_x 12345 the the THE", None, "", "don\u2019t 日本 runner\x00running"]
    owner, term, n = toxicity.Terms().of(texts)
    got = [sorted(n[owner == i].tolist()) for i in range(len(texts))]

    def expected(text):
        found = Counter()
        for w in re.findall(r"\w+", (text or "").lower()):
            found[w] += 1
            if len(w) > toxicity.STEM:
                found[w[: toxicity.STEM] + "*"] += 1
        return found

    assert got == [sorted(expected(t).values()) for t in texts]
    names = {}  # equal terms of different texts have one digest, different terms have different ones
    for text in texts:
        for w in expected(text):
            o, t, _ = toxicity.Terms().of([w.rstrip("*")]) if not w.endswith("*") else toxicity.Terms().of([w.rstrip("*") + "zzzz"])
            names[w] = set(t.tolist())
    assert set(term.tolist()) <= set().union(*names.values())


def test_nearest_is_exact():
    r = np.random.default_rng(1)
    n, terms = 500, 90
    tf = r.integers(0, 4, (n, terms)) * (r.random((n, terms)) < np.linspace(0.005, 0.5, terms))
    tf[7] = 0  # an example without terms
    doc, term = np.nonzero(tf)
    index = toxicity.Index.build(np.arange(terms).astype("u8"), r.random(terms) * 3 + 0.1, np.arange(n), r.integers(0, 2, n), doc, term, tf[doc, term].astype("f8"), 7, 0.5)
    assert (index.dense >= 0).any() and (index.dense < 0).any()
    w = np.sqrt(tf) * index.weight
    w /= np.maximum(np.sqrt((w * w).sum(1, keepdims=True)), 1e-300)
    for _ in range(60):
        t = np.unique(r.integers(0, terms, 9))
        q = index.query(t, r.integers(1, 5, len(t)))
        plain = np.zeros(terms)
        plain[t] = q
        cosines = w @ plain
        at, s = index.nearest(t, q, index.dense_parts([(t, q)])[0], 7)
        assert np.allclose(s, np.sort(cosines[cosines > 0])[::-1][:7])
        assert np.allclose(cosines[index.doc_ids[at]], s)


def test_a_copy_of_an_example_is_its_nearest(spark):
    """Also where the words of the example are nowhere else."""
    r = random.Random(5)
    texts = [(i, " ".join(f"w{r.randrange(80)}" for _ in range(30)) + (f" rare{i} strange{i} foul" if i % 4 == 0 else "")) for i in range(60)]
    docs = spark.createDataFrame([*texts, (1000, texts[8][1]), (1001, "nothing known here"), (1002, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int")
    rows = {x.doc_id: x for x in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert rows[1000].evidence[0].doc_id == 8 and abs(rows[1000].evidence[0].similarity - 1) < 1e-9 and rows[1000].predicted == 1
    assert rows[1001].evidence == [] and rows[1001].score == rows[1002].score == 0.25


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 0, 0), (2, None, None), (10, 1, 1), (3, 1, 1), (4, 0, 0)]])
def test_awkward_inputs(spark, labels):
    docs = frame(spark, awkward())
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, table, "toxic")
    field = quality.fit(docs, table, "quality")
    for out in (toxicity.score(docs, index), quality.score(docs, field)):
        rows = out.collect()
        assert len(rows) == docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    assert toxicity.score(frame(spark, []), index).count() == 0 and quality.score(frame(spark, []), field).count() == 0
    assert toxicity.without_toxic(docs, index).columns == docs.columns


def test_field_marginals_match_enumeration():
    r = np.random.default_rng(3)
    model = quality.Field(frozenset(), transition=r.normal(size=(2, 2)))
    chains = [r.normal(size=n) for n in (1, 2, 5, 3)]
    marginals, pairs, log_z = model.chains(chains)
    total, counts = 0.0, np.zeros((2, 2))
    for e, m in zip(chains, marginals, strict=True):
        weights = {s: np.exp(sum(e[i] for i, x in enumerate(s) if x) + sum(model.transition[a, b] for a, b in zip(s, s[1:], strict=False))) for s in itertools.product((0, 1), repeat=len(e))}
        z = sum(weights.values())
        total += np.log(z)
        assert np.allclose(m, [sum(w for s, w in weights.items() if s[i]) / z for i in range(len(e))])
        for s, w in weights.items():
            for a, b in zip(s, s[1:], strict=False):
                counts[a, b] += w / z
    assert np.isclose(total, log_z) and np.allclose(pairs, counts)


def test_long_chains_match_short_ones():
    r = np.random.default_rng(4)
    model = quality.Field(frozenset(), transition=r.normal(size=(2, 2)) * 2)
    for n in (1, 2, 3, 10, 101, 500):
        e = r.normal(size=n) * 3
        (a,), pairs, z = model.chains([e])
        b, long_pairs, long_z = model.long_chain(e)
        assert np.allclose(a, b) and np.allclose(pairs, long_pairs) and np.isclose(z, long_z)


def test_a_very_long_text(spark):
    """A million lines, in bounded memory and time."""
    values, weights = quality.line_features("\n".join(["some words, here."] * 999_999 + ["%%%"]), frozenset(["some"]))
    r = np.random.default_rng(4)
    model = quality.Field(frozenset(["some"]), r.normal(size=(quality.COLUMNS, quality.WIDTH)) * 0.1, r.normal(size=(2, 2)))
    (m,), _, _ = model.chains([model.scores(values)])
    assert len(m) == 1_000_000 and ((m >= 0) & (m <= 1)).all() and np.isfinite(model.aggregate(m, weights))


def test_scores_do_not_use_other_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    index = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), "toxic", fold(F.col("doc_id"), 5) != 0)
    a = {r.doc_id: r.score for r in toxicity.score(docs, index).collect()}
    b = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), index).collect()}
    assert a == b


def test_memory_of_a_batch_of_short_texts():
    """Thousands of short texts come in one batch; cosines with all examples are held for a few of them at a time."""
    n = 4000
    index = toxicity.Index.build(np.sort(toxicity.Terms().of(["foul fair"])[1]), np.ones(2), np.arange(n), np.arange(n) % 2, np.arange(n), np.arange(n) % 2, np.ones(n), 5, 0.5)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": ["foul", None, "x"] * 1000})
    tracemalloc.start()
    (out,) = toxicity._scored(iter([batch]), toxicity.Model(SimpleNamespace(value=index), (0.0, 1.0), 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 3000 and len(set(out["score"].to_pylist()[::3])) == 1 and set(out["score"].to_pylist()[1::3]) == {0.5}
    assert peak < 40e6


def test_one_index_is_broadcast_at_a_time(spark, monkeypatch):
    held, most = [], []
    send, destroy = spark.sparkContext.broadcast, Broadcast.destroy

    def sent(value):
        held.append(send(value))
        most.append(sum(len(x.value) if isinstance(x.value, list) else isinstance(x.value, toxicity.Index) for x in held))
        return held[-1]

    def destroyed(one, *args):
        held[:] = [x for x in held if x is not one]
        destroy(one, *args)

    monkeypatch.setattr(spark.sparkContext, "broadcast", sent)
    monkeypatch.setattr(Broadcast, "destroy", destroyed)
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert max(most) == 1 and held == [model.index]
