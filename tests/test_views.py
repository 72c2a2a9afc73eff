"""Stored views after changes, children side by side, substring search, and paths, against plain definitions."""

import random

import pytest
from pyspark.sql import functions as F

from caseloom.operators import graph, search, views


def test_refresh_after_random_changes(spark, tmp_path):
    r, path = random.Random(6), str(tmp_path / "view")
    rows = [(f"k{r.randrange(40)}", i, r.random()) for i in range(150)]

    def built(part, keys=None):
        df = spark.createDataFrame(part, "k string, i long, x double")
        df = df if keys is None else df.join(keys, "k", "left_semi")
        return df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("i").alias("total"))

    views.store(built(rows), "k", path, 8)
    for _ in range(3):
        gone = {x[1] for x in r.sample(rows, 20)}
        new = [(f"k{r.randrange(60)}", 1000 + r.randrange(10_000), r.random()) for _ in range(15)]
        changed = [x for x in rows if x[1] in gone] + new
        rows = [x for x in rows if x[1] not in gone] + new
        keys = views.changed_parents([(spark.createDataFrame(changed, "k string, i long, x double"), "k"), (spark.createDataFrame([(None,)], "p string"), "p")])
        assert 0 < views.refresh_changed(path, "k", keys, lambda k, rows=rows: built(rows, k), 8) <= 8
        assert {tuple(x) for x in spark.read.parquet(path).select("k", "n", "total").collect()} == {tuple(x) for x in built(rows).collect()}
    assert views.refresh_changed(path, "k", keys.limit(0), lambda k: built(rows, k), 8) == 0
    everything = spark.read.parquet(path).select("k")
    views.refresh_changed(path, "k", everything, lambda k: built(rows, k).limit(0), 8)  # all keys go
    assert not [p for p in (tmp_path / "view").glob("_bucket=*")]


def test_a_refresh_writes_what_it_keeps_once(spark, tmp_path, monkeypatch):
    kept, checkpointed, path = [], views.checkpointed, str(tmp_path / "view")
    monkeypatch.setattr(views, "checkpointed", lambda df: kept.append(df.columns) or checkpointed(df))
    view = spark.range(20).withColumn("n", F.lit(1))
    views.store(view, "id", path, 2)
    views.refresh_changed(path, "id", view.select("id").where("id < 10"), lambda keys: keys.withColumn("n", F.lit(2)), 2)
    assert kept == [["id"]] and [p.name for p in tmp_path.iterdir()] == ["view"]
    assert {tuple(r) for r in spark.read.parquet(path).select("id", "n").collect()} == {(i, 2 if i < 10 else 1) for i in range(20)}


def test_with_children(spark):
    parents = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    one = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("a", 1, None), (None, 3, "x"), ("z", 1, "x")], "p string, n int, kind string")
    out = views.with_children(parents, "id", {"ones": views.Children(one, "p", F.col("n"), (F.col("n"),), F.col("kind")), "none": views.Children(one.limit(0), "p", F.col("kind"), (F.col("n"),))}).collect()
    assert {r.id: (r.ones, r.ones_counts, r.none) for r in out} == {"a": ([1, 1, 2], {"x": 1, "unknown": 2}, []), "b": ([], {}, []), None: ([], {}, [])}


@pytest.mark.parametrize("part", ["ana", "Banana", "a.n", "an", "", "zzzz", "ä ß", "a\nb"])
def test_search_finds_all(spark, tmp_path, part):
    texts = ["banana", "BANANA bread", "ban ana", "a.n", "axn", None, "", "Ä SS and ä ß", "a\nb", "nan" * 500]
    rows = spark.createDataFrame([(i, t, "source", 1) for i, t in enumerate(texts)], "id long, t string, s string, gram int")
    search.write_postings(rows, "id", ["t", "s"], str(tmp_path / "p"))
    got = {r.id for r in search.search(rows, "id", str(tmp_path / "p"), {"t": part}).collect()}
    assert got == {i for i, t in enumerate(texts) if t is not None and part.lower() in t.lower()}
    assert {r.id for r in search.search(rows, "id", str(tmp_path / "p"), {"t": "bread", "s": "OURC"}).collect()} == set(range(len(texts)))


@pytest.mark.parametrize("most", [2, 3, 4, 5, 6])
def test_simple_paths(spark, most):
    r = random.Random(most)
    e = {(f"n{r.randrange(9)}", f"n{r.randrange(9)}") for _ in range(30)}
    df = spark.createDataFrame([(*x, "r", 1.0) for x in e], "src string, dst string, relation string, strength double")

    def grown(path):
        if len(path) > 1 and path[-1] == "n1":
            yield tuple(path)
        elif len(path) < most:
            for a, b in e:
                if a == path[-1] and b not in path:
                    yield from grown([*path, b])

    node = lambda n: spark.createDataFrame([(n,)], "node string")
    got = [tuple(x.path) for x in graph.simple_paths(df, node("n0"), node("n1"), most).collect()]
    assert sorted(got) == sorted(grown(["n0"]))
