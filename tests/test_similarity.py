"""Ratios and the index for edit distance against their definitions."""

import random
from functools import cache

import pytest
from pyspark.sql import functions as F

from caseloom.functions import similarity
from caseloom.operators import joins


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def common(a, b):
    @cache
    def of(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + of(i + 1, j + 1) if a[i] == b[j] else max(of(i + 1, j), of(i, j + 1))

    return of(0, 0)


def test_common_letters():
    r = random.Random(1)
    texts = ["".join(r.choice("abcé ") for _ in range(r.choice([0, 1, 5, 20, 63, 64, 65, 90]))) for _ in range(80)]
    pairs = list(zip(texts, reversed(texts), strict=True))
    assert similarity._common_letters([a for a, _ in pairs], [b for _, b in pairs]) == [common(a, b) for a, b in pairs]
    assert similarity._common_letters([], []) == []


def test_token_sort_ratio(spark):
    rows = [("ram kumar", "kumar  ram", 1.0), ("", "", 1.0), (None, "", 1.0), ("a", "", 0.0), ("ram", "raj", 2 * 2 / 6), ("b a", "a c", 2 * 2 / 6)]
    got = spark.createDataFrame(rows, "a string, b string, e double").select(similarity.token_sort_ratio(F.coalesce("a", F.lit("")), F.col("b")), "e").collect()
    assert all(x == pytest.approx(e) for x, e in got)


@pytest.mark.parametrize("least", [0.55, 0.7, 0.8, 0.9])
def test_similar_pairs_lose_nothing(spark, least):
    r = random.Random(int(least * 100))
    names = set()
    for _ in range(40):
        base = "".join(r.choice("abc") for _ in range(r.randrange(1, 16)))
        names.add(base)
        for _ in range(3):
            x = list(base)
            for _ in range(r.randrange(1, 4)):
                at = r.randrange(len(x) + 1)
                x[at : at + r.randrange(2)] = r.choice(["", "a", "b", "d"])
            names.add("".join(x))
    names = sorted(names)
    got = [tuple(x) for x in joins.similar_pairs(spark.createDataFrame([(n,) for n in [*names, *names[:3], None]], "n string"), "n", least).collect()]
    expected = {(a, b, d) for i, a in enumerate(names) for b in names[i + 1 :] for d in [edits(a, b)] if 1 - d / max(len(a), len(b)) >= least - 1e-12}
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 5
    assert joins.similar_pairs(spark.createDataFrame([], "n string"), "n", least).count() == 0
