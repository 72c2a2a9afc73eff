"""Nested values: ordered lists, maps, JSON, deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_list(payload: Column, *order: Column) -> Column:
    """Aggregate: payloads as an array, in order (nulls of the order first)."""
    key = F.struct(*(o.alias(f"k{i}") for i, o in enumerate(order)), payload.alias("payload"))
    return F.transform(F.array_sort(F.collect_list(key)), lambda x: x.payload)


def sorted_set(c: Column) -> Column:
    """Aggregate: distinct values in order; an empty array if there are none."""
    return F.array_sort(F.collect_set(c))


def to_map(key: Column, value: Column) -> Column:
    """Aggregate: one entry per row; keys must differ."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))


def uuid5(namespace_hex: str, name: Column) -> Column:
    """Version 5 UUID of a name, from its SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("long").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def blank_fields_to_null(s: str, fields: list[str]) -> Column:
    """A struct column with its blank text fields as null."""
    return F.struct(*(F.when(F.trim(F.col(f"{s}.{f}")) != "", F.col(f"{s}.{f}")).alias(f) for f in fields))


def merge_structs(a: str, b: str, fields_a: list[str], fields_b: list[str]) -> Column:
    """All fields of two structs; b's where both have one."""
    return F.struct(*(F.col(f"{a}.{f}") for f in fields_a if f not in fields_b), *(F.col(f"{b}.{f}") for f in fields_b))


def json_kind(text: Column) -> Column:
    """object, array, string, number, boolean, null; null for what is no JSON."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", "null").when(kind.isNotNull(), "number")
    )


def media_list(ids: Column) -> Column:
    """Trimmed ids, each once, in first order, without blanks."""
    return F.array_distinct(F.filter(F.transform(ids, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))
