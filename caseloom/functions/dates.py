"""Dates and times; the day of reference is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy")


def parse_tolerant(c: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats))


def date_in_text(c: Column) -> Column:
    """The first dd/mm/yyyy of a text."""
    return F.try_to_timestamp(F.regexp_extract(c, r"(\d{2}/\d{2}/\d{4})", 1), F.lit("dd/MM/yyyy")).cast("date")


def sla_days(is_large: Column) -> Column:
    """Days until a case is due."""
    return F.when(is_large, 180).otherwise(60)


def sla_bucket(start: Column, as_of: Column, days: Column) -> Column:
    elapsed = F.datediff(as_of, start)
    return F.when(start.isNull(), F.lit("Unknown")).when(elapsed > days, "Overdue").when(elapsed > days - 15, "Due Soon").otherwise("Within Limit")


def years_between(start: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, start) / 12).cast("int")


def in_last_days(c: Column, as_of: Column, days: int) -> Column:
    return (c > F.date_sub(as_of, days)) & (c <= as_of)


def in_last_months(c: Column, as_of: Column, months: int) -> Column:
    return (c > F.add_months(as_of, -months)) & (c <= as_of)
