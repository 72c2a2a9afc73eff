import random

import pytest

from caseloom.llm.common import join_groups, numbered, possibly_in, shared_dir, small_batches


@pytest.mark.parametrize(("n", "most_bits"), [(0, 1 << 27), (5, 1 << 27), (5000, 1 << 27), (5000, 1 << 15)])
def test_possibly_in_loses_nothing(spark, n, most_bits):
    r = random.Random(n)
    wanted = [r.randrange(-(2**62), 2**62) for _ in range(n)]
    other = [r.randrange(-(2**62), 2**62) for _ in range(20_000)]
    keys = spark.createDataFrame([(k,) for k in [*wanted, *wanted[:3], None]], "k long")
    rows = spark.createDataFrame([(k, "x") for k in [*wanted, *other, None]], "id long, _words string")
    got = [x.id for x in possibly_in(rows, "id", keys, most_bits).collect()]
    assert set(wanted) <= set(got) and None not in got and len(got) == len(set(got))
    if most_bits > 1 << 15:
        assert len(got) <= len(set(wanted)) + 0.1 * len(other)


def test_small_batches_are_undone(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), small_batches(spark, 7):
        assert spark.conf.get(key) == "7"
        1 / 0  # noqa: B018
    assert spark.conf.get(key) == before


def test_numbers_are_unique_and_repeatable(spark):
    df = spark.range(1000).repartition(5, "id")
    a, b = ({r.id: r.n for r in numbered(df, "n", ["id"]).collect()} for _ in range(2))
    assert a == b and len(set(a.values())) == 1000 and shared_dir(spark)


@pytest.mark.parametrize("least", [1, 64])
def test_join_groups_is_a_join(spark, least):
    r = random.Random(3)
    pairs = [(r.choice(["hot"] * 30 + [f"k{i}" for i in range(40)]), i) for i in range(3000)]
    rows = spark.createDataFrame(pairs, "k string, v long")
    groups = rows.where("k <> 'k7'").groupBy("k").count()
    got = sorted((x.k, x.v, x["count"]) for x in join_groups(rows, groups, ["k"], "count", 50, least).collect())
    sizes = {x: sum(k == x for k, _ in pairs) for x, _ in pairs}
    assert got == sorted((k, v, sizes[k]) for k, v in pairs if k != "k7")
    assert join_groups(rows, groups.limit(0), ["k"], "count").count() == 0
