"""Nearest vectors against all pairs."""

import numpy as np
import pytest

from caseloom.operators import vectors


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_top_k_against_all_pairs(spark, metric, scale):
    r = np.random.default_rng(4)
    middle = r.standard_normal((12, 6))
    rows = np.concatenate([middle[r.integers(0, 12, 500)] + 0.02 * r.standard_normal((500, 6)), np.repeat(middle[:1], 60, 0), np.zeros((2, 6))]) * scale
    table = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(rows)] + [(None, [0.0] * 6, "x"), (9999, None, "x")], "id long, v array<double>, cell string").repartition(5)
    got = {}
    for x in vectors.top_k(table, table.where("id % 7 = 0"), "id", "v", 8, metric).collect():
        got.setdefault(x.query_id, []).append((-x.score, x.id))
    scores = vectors._scores(rows, rows, metric)
    assert set(got) == set(range(0, len(rows), 7))
    for q, found in got.items():
        expected = sorted((-scores[q, i], i) for i in range(len(rows)) if i != q)[:8]
        assert sorted(found) == expected
    assert vectors.top_k(table.limit(0), table, "id", "v", 3).count() == 0 and vectors.top_k(table, table.limit(0), "id", "v", 3).count() == 0
