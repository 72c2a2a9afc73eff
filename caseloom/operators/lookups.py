"""Everything about one case or one person: point filters that reach the scans, then joins of what belongs to them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def about(rows: DataFrame, key: str, values: list, *parts: tuple[DataFrame, str, str]) -> DataFrame:
    """Rows of some keys with what belongs to them: each part is (table, its key, the column it refers to); all rows stay."""
    out = rows.where(F.col(key).isin(values))
    for table, own, other in parts:
        out = out.join(table, out[other] == table[own], "left")
    return out


def any_holds(rows: DataFrame, columns: list[str], part: str) -> DataFrame:
    """Rows with the text in any of some columns, in any case."""
    return rows.where(reduce(or_, (F.contains(F.lower(F.col(c).cast("string")), F.lit(part.lower())) for c in columns)))


def with_number(rows: DataFrame, phones: Column, number: str) -> DataFrame:
    """Rows whose list of numbers has one with the same last ten digits."""
    from ..functions.text import phone_digits

    return rows.where(F.array_contains(F.transform(phones, phone_digits), phone_digits(F.lit(number))))


def identities(records: DataFrame, person: str, counted: dict[str, str], listed: dict[str, str], least: int = 1) -> DataFrame:
    """A row per person with distinct counts (name: column) and joined lists (name: column) of its records; people with
    fewer than `least` of the first count are left out."""
    first = next(iter(counted))
    g = records.groupBy(person).agg(*(F.countDistinct(c).alias(n) for n, c in counted.items()), *(F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ", ").alias(n) for n, c in listed.items()))
    return g.where(F.col(first) >= least)
