"""Every registered query gives the rows of its SQL on the small tables, or (without SQL) a stable result."""

import math
from pathlib import Path

import duckdb
import pytest

from caseloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def shown(v):
    if v is None or isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "quantize"):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = df.collect()
    if name in registry.ORACLE_SQL:
        cursor = duck.execute(registry.ORACLE_SQL[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows(df.columns, got) == rows(columns, cursor.fetchall())
    else:
        assert rows(df.columns, got) == rows(df.columns, registry.QUERIES[name](spark, SF).collect()) and got


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
