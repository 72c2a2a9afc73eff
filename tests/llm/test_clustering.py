import hashlib
import random

import numpy as np
import pytest

from caseloom.llm import clustering
from caseloom.llm.clustering import Centroids, clusters
from caseloom.llm.vector_search import whole_vectors

SCHEMA = "vec_id long, embedding array<double>, cluster string, vector int"


def plain(rows, dim, k, rounds):
    """k-means by definition, with Python's integers."""
    kept = [(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        at = [c for _, c in assign()]
        for c in range(len(centres)):
            own = [v for (_, v), x in zip(kept, at, strict=True) if x == c]
            if own:
                centres[c] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    at = assign()
    total, sha = min(clustering.LONG, sum(d for d, _ in at)), [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, sum(x for x, y in at if y == c), total, sha[c]) for (i, _), (d, c) in zip(kept, at, strict=True)), key=str)


def result(spark, rows, dim, k, rounds):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(map(tuple, clusters(whole_vectors(df, with_null_ids=True), dim, k, rounds).collect()), key=str)


@pytest.mark.parametrize("rounds", [0, 3])
def test_clusters_against_the_definition(spark, rounds):
    r = random.Random(2)
    rows = [(i, [r.choice([-1, 0, 0.5, 1]) + r.randrange(3) / 64 for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.25] * 6) for i in range(300, 400)]  # copies, so ties
    rows += [(3, rows[3][1]), (4, [9.0] * 6), (None, [0.5] * 6), (None, None), (500, None), (501, [1.0] * 5), (502, [1.0] * 5 + [None]), (503, [1.0] * 5 + [float("nan")]), (504, [float("inf")] * 6), (505, [])]
    assert result(spark, rows, 6, 16, rounds) == plain(rows, 6, 16, rounds)


def test_large_components_stay_exact(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-1, 1]) * 2.0 ** r.randrange(20, 24) + r.randrange(5) for _ in range(3)]) for i in range(120)]
    assert result(spark, rows, 3, 5, 2) == plain(rows, 3, 5, 2)


def test_few_or_no_vectors(spark):
    rows = [(2, [0.1, 0.2]), (None, [0.3, 0.2]), (1, [5.0, 5.0])]
    assert result(spark, rows, 2, 16, 3) == plain(rows, 2, 16, 3)
    assert result(spark, [], 2, 16, 3) == [] and result(spark, [(1, [0.0])], 2, 16, 3) == []


def test_beyond_a_long(spark):
    got = result(spark, [(1, [1e300]), (2, [-1e300])], 1, 1, 0)
    assert [x[2] for x in got] in ([0, clustering.LONG], [clustering.LONG, 0])


def test_annulus_keeps_ties_on_its_border():
    centres = Centroids([(5, 0), (-5, 0), (0, 5), (15, 0), (0, 0)])
    cluster, d = centres.nearest(np.array([[10, 0], [0, 0], [-3, 0], [3, 3], [0, 100]]))
    assert cluster.tolist() == [0, 4, 1, 0, 2] and d.tolist() == [25, 0, 4, 13, 9025]
