"""Seized items out of case texts: a chain of DataFrame steps without a model. Each step is of use alone.

Whose an amount is, is a question of order: a text is cut where a person's code stands, and what follows belongs to that
person until the next code. Amounts cut it further, and each amount's item is the longest known name up to the next amount.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import units
from . import enrich, rules
from .joins import small

#: A number with any unit of weight or volume that `units` knows (longer spellings first).
AMOUNT = rf"(?i)(?=\d)(?<![\w.])(\d+(?:\.\d+)?)\s*({'|'.join(sorted({u for (kind, _), names in units.UNITS.items() if kind != 'count' for u in names}, key=lambda u: (-len(u), u)))})\b"


def _stretches(text: Column) -> Column:
    """array<struct(ord, segment, joint)>: what follows each code of a text, cut once; ord counts what stands before the first."""
    code, last = F.lit(f"^{T.CODE}"), F.lit(rf"^{T.CODE}\s+(?i)to\s*$")
    ranged = lambda cut, i: F.coalesce((i > 0) & F.regexp_like(F.element_at(cut, F.greatest(i, F.lit(1))), last), F.lit(False))
    told = lambda cut: F.transform(cut, lambda s, i: F.when((i > 0) | F.regexp_like(s, code), F.struct(i.alias("ord"), F.trim(s).alias("segment"), ranged(cut, i).alias("joint"))))
    return F.array_compact(T.once(T.cut(text, f"(?={T.CODE})"), told))


def segments(rows: DataFrame, id_: str, text: str) -> DataFrame:
    """id_, ord, person_code, segment, joint: the stretch from each person's code to the next code or the end of the text.
    joint marks the last code of a range ("A-2 to A-4"): what follows is of all of them together, not that person's."""
    each = rows.select(id_, F.explode(_stretches(F.col(text))).alias("s"))
    return each.select(id_, "s.ord", T.person_code(F.col("s.segment")).alias("person_code"), "s.segment", "s.joint")


def segment_counts(rows: DataFrame, id_: str, text: str) -> DataFrame:
    """id_, segments, people: how many stretches each text has and of how many different codes, counted where the text
    lies, without a group; a text without a stretch gives no row."""
    codes = F.transform(_stretches(F.col(text)), lambda s: T.person_code(s.segment))
    counts = F.transform(F.array(codes), lambda c: F.struct(F.size(c).cast("long").alias("segments"), F.size(F.array_distinct(F.array_compact(c))).cast("long").alias("people")))
    each = rows.select(id_, F.explode(F.filter(counts, lambda c: c.segments > 0)).alias("c"))
    return each.select(id_, "c.segments", "c.people")


def amounts(c: Column) -> Column:
    """array<struct(quantity, unit, told)>: every amount with a unit; told is the text from it to the next one."""
    split = F.transform(T.cut(c, f"(?={AMOUNT})"), lambda p: F.struct(F.regexp_extract(p, f"^{AMOUNT}", 1).try_cast("double").alias("quantity"), F.lower(F.regexp_extract(p, f"^{AMOUNT}", 2)).alias("unit"), p.alias("told")))
    return F.filter(split, lambda a: a.unit != "")


def _told(rows: DataFrame, id_: str, text: str, names: DataFrame, raw: str, standard: str, people: bool = True, packed: bool = True) -> DataFrame:
    """id_, _whole (the text), person_code, item, quantity, unit, sentence: what people's stretches and sentences about packets tell, in one
    pass over each text: rows stay where their text lies. The item is the longest known name, of the amount or of all the
    sentence."""
    sentence = F.col("_t.sentence")
    own = F.transform(F.filter(_stretches(F.col(text)), lambda s: ~s.joint & rules.holds(s.segment, rules.SEIZED)), lambda s: F.struct(s.segment.alias("sentence"), F.lit(True).alias("own")))
    held = F.when(rules.holds(F.col(text), rules.PACKETS), rules.sentences(F.col(text))).otherwise(F.array().cast("array<string>"))
    packs = F.transform(F.filter(held, lambda s: rules.holds(s, rules.PACKETS)), lambda s: F.struct(s.alias("sentence"), F.lit(False).alias("own")))
    each = rows.where(F.col(id_).isNotNull()).select(id_, F.col(text).alias("_whole"), F.explode(F.concat(*([own] if people else []), *([packs] if packed else []))).alias("_t"))
    of_packets = F.transform(rules.packets(sentence), lambda p: F.struct((p.packets * p.each).alias("quantity"), p.unit.alias("unit"), sentence.alias("told")))
    each = each.select(id_, "_whole", sentence.alias("sentence"), F.when(F.col("_t.own"), T.person_code(sentence)).alias("person_code"), F.explode(F.when(F.col("_t.own"), amounts(sentence)).otherwise(of_packets)).alias("a"))
    each = each.select(id_, "_whole", "sentence", "person_code", "a.quantity", "a.unit", "a.told")
    known = small(names.groupBy(F.lower(raw).alias("keyword")).agg(F.min(standard).alias("_standard")))
    for column, found in (("told", "_near"), ("sentence", "_any")):
        each = rules.longest_keyword(each, column, names, raw).join(known, "keyword", "left").drop("keyword").withColumnRenamed("_standard", found)
    return each.withColumn("item", F.coalesce("_near", "_any")).where("item IS NOT NULL").select(id_, "_whole", "person_code", "item", "quantity", "unit", "sentence")


def items_of_people(rows: DataFrame, id_: str, text: str, names: DataFrame, raw: str, standard: str) -> DataFrame:
    """id_, person_code, item, quantity, unit, sentence: the amounts of each person's stretch that tells of a seizure. An
    amount without a name of its own takes that of the stretch."""
    return _told(rows, id_, text, names, raw, standard, packed=False).drop("_whole")


def items_in_packets(rows: DataFrame, id_: str, text: str, names: DataFrame, raw: str, standard: str) -> DataFrame:
    """The same for packets ("3 packets of 2 kg each"), by sentence, without a person: the weight of all packets."""
    return _told(rows, id_, text, names, raw, standard, people=False).drop("_whole")


def seized_items(rows: DataFrame, id_: str, text: str, names: DataFrame, raw: str, standard: str, ignored: DataFrame | None = None, large_g: float = 20_000.0) -> DataFrame:
    """A row per case, person, item and amount: id_, person_code, item, weight_g, volume_ml, count_total, label, is_sample,
    is_large (for all rows of a case's item, if one or their sum is large). Steps: people's stretches and packets; seizures
    only; nothing that is on the list of ignored items; standard units; no gross weight beside its net one; samples marked;
    each amount once."""
    found = _told(rows, id_, text, names, raw, standard)
    kept = found.where(rules.seizure_filter(F.col("sentence"), F.col("_whole"), F.col("item"))["keep"])
    kept = kept if ignored is None else rules.without_ignored(kept, "item", ignored, ignored.columns[0])
    q = units.standard_quantity(F.col("quantity"), F.col("unit"), F.lit("unknown"), F.lit(0.0), F.col("sentence"))
    measured = kept.withColumn("q", q).where(~enrich.is_gross_beside_net(F.col("_whole"), F.col("sentence"), F.col("q.weight_g")))
    amount = measured.select(id_, "person_code", "item", "q.weight_g", "q.volume_ml", "q.count_total", enrich.is_sample(F.col("q.weight_g"), F.col("sentence")).alias("is_sample"))
    once = amount.groupBy(id_, "person_code", "item", "weight_g", "volume_ml", "count_total").agg(F.max("is_sample").alias("is_sample"))
    large = F.sum(F.coalesce("weight_g", F.lit(0.0))).over(W.partitionBy(id_, "item")) >= large_g
    return once.withColumn("is_large", large).withColumn("label", units.quantity_label(F.col("weight_g"), F.col("volume_ml"), F.col("count_total")))
