"""Whose is an item: items of a case go to the people whom their sentences name.

Cases stream through tasks, people first. Of a case of many people the words of all names become one Aho-Corasick automaton, and
every sentence is read once, however many they are. The items of a large case are dealt to pieces, each with a copy of the
case's people.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..shared import checkpointed
from .joins import small

#: Words of a deal with somebody else; who stands behind one of them (at most so many characters) has dealt, not had.
DEALT = ("sell", "sold", "selling", "buyer", "customer", "purchase", "bought", "received", "consume", "consumed", "consumption")
REACH = 100
#: Signs of use, and of many people at once.
USE = ("smoked", "smoking", "consumed", "consuming", "consumption", "urine test", "tested positive", "drug detection test", "positive")
ALL = ("accused persons", "they", "all accused", "all of them")
#: The words of the names of at most so many people are looked for without an automaton.
FEW = 16
#: The name of an item that says that nothing was found.
NOTHING = "NO_DRUGS_DETECTED"

_CODE = re.compile(r"\bA\s*[-.]?\s*(\d+)\b", re.I)
_RANGE = re.compile(r"\bA\s*[-.]?\s*\d+\s+to\s+A\s*[-.]?\s*\d+\b", re.I)
_DEAL = re.compile(rf"\b(?:{'|'.join(DEALT)})\s", re.I)


def _dealt(sentence: str, at: int) -> bool:
    return bool(_DEAL.search(sentence, max(0, at - REACH), at))


@lru_cache(10_000)
def codes_in(sentence: str | None) -> list[str]:
    """Codes of people in a sentence, without those it only deals with; none if it speaks of a range ("A2 to A4"), which
    is of all together."""
    s = sentence or ""
    met = list(_CODE.finditer(s))
    if len(met) > 1 and _RANGE.search(s):
        return []
    return list(dict.fromkeys(f"A-{int(m[1])}" for m in met if not _dealt(s, m.start())))


@lru_cache(100_000)
def _words(name: str) -> list[str]:
    """The words of a lower-case name by which it is known."""
    return [w for w in dict.fromkeys(name.split()) if len(w) > 2] if len(name) > 3 else []


@dataclass
class _Case:
    """The people of a case, in order: (person, code, name)."""

    people: list[tuple[str, str | None, str | None]] = field(default_factory=list)
    by_code: dict[str, int] = field(default_factory=dict)
    words: list[list[str]] = field(default_factory=list)
    automaton: ahocorasick.Automaton | None = None
    owners: dict[str, list[int]] | None = None

    def add(self, person: str, code: str | None, name: str | None) -> None:
        m = _CODE.search(code or "")
        if m:
            self.by_code.setdefault(f"A-{int(m[1])}", len(self.people))
        name = (name or "").strip().lower()
        self.words.append(_words(name))
        self.people.append((person, code, name))

    def _told_of(self, low: str) -> tuple[Iterable[int], Callable[[str], int]]:
        """Who may be named in a sentence, in order, and where a word of theirs first stands in it (-1: nowhere). The words of a
        few people are looked for one by one, which is less than an automaton of them takes to make."""
        if len(self.people) <= FEW:
            return range(len(self.people)), low.find
        if self.owners is None:
            self.owners, self.automaton = {}, ahocorasick.Automaton()
            for i, own in enumerate(self.words):
                for w in own:
                    self.owners.setdefault(w, []).append(i)
                    self.automaton.add_word(w, w)
            self.automaton.make_automaton()
        if not self.owners:
            return [], low.find
        first: dict[str, int] = {}
        for end, w in self.automaton.iter(low):
            first.setdefault(w, end - len(w) + 1)
        return sorted({i for w in first for i in self.owners[w]}), lambda w: first.get(w, -1)

    def named(self, sentence: str) -> list[int]:
        """Who is named: by two words of the name, or by its only one."""
        low, out = sentence.lower(), []
        told, place = self._told_of(low)
        for i in told:
            held = [at for at in map(place, self.words[i]) if at >= 0]
            if held and len(held) >= min(2, len(self.words[i])) and not _dealt(low, held[0]):
                out.append(i)
        return out

    def attribute(self, name: str | None, sentence: str | None, sources: list[str] | None, ref: str | None) -> tuple[list[int], str]:
        everyone = range(len(self.people))
        if not self.people:
            return [], "orphan"
        if (name or "").strip().upper() == NOTHING:
            return list(everyone), "nothing_found"
        known = _CODE.search(ref or "")
        if sources:
            codes = next((c for c in map(codes_in, sources) if c), [])
        else:
            codes = [f"A-{int(known[1])}"] if known else codes_in(sentence)
        found = sorted(self.by_code[c] for c in codes if c in self.by_code) or self.named(sentence or "")
        if found:
            return (found, "individual") if len(found) == 1 else ([0], "collective")
        low = (sentence or "").lower()
        if len(self.people) > 1 and any(w in low for w in USE) and any(w in low for w in ALL):
            return list(everyone), "collective_use"
        return [0], "first_person"


def _attributed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by case, piece, kind (people before items) and order; what an item has of its own passes through."""
    key, case = None, _Case()
    for batch in batches:
        people, how = [], []
        rows = zip(*(batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("case", "piece", "kind", "person", "code", "name", "sentence", "sources", "ref")))
        for of, piece, kind, person, code, name, sentence, sources, ref in rows:
            if (of, piece) != key:
                key, case = (of, piece), _Case()
            if kind == 0:
                case.add(person, code, name)
                continue
            found, rule = case.attribute(name, sentence, json.loads(sources) if sources else None, ref)
            people.append([case.people[i][0] for i in found])
            how.append(rule)
        own = batch.column("row").filter(pc.equal(batch.column("kind"), 1))
        yield pa.RecordBatch.from_arrays([own, pa.array(people, pa.list_(pa.string())), pa.array(how, pa.string())], names=["_row", "_people", "attribution"])


def attribute(items: DataFrame, people: DataFrame, case: str, sentence: str, person: str, code: str, name: str, order: list[str], item_name: str | None = None, sources: str | None = None, ref: str | None = None, piece: int = 2000) -> DataFrame:
    """items with person (a key of people, as text) and attribution, a row per person they go to:

    individual     one person, by code, else by name
    collective     several are named: the first person of the case (by order) stands for them
    first_person   nobody is named
    collective_use nobody is named, and all are said to have used it: a row each
    nothing_found  the item says that nothing was found: a row each
    orphan         the case has no people: person is null

    sources (an array column) is what was merged into an item: the first of them that holds codes counts; ref is a code given
    apart. Items of a null case are orphans; of people that share a code the first stands for it. Items move once, with all their
    columns; of a large case they are dealt to pieces by what they hold. The people of one case are held in a task's memory."""
    text = lambda c: (F.lit(None) if c is None else F.col(c)).cast("string")
    sized = items.where(F.col(case).isNotNull()).groupBy(case).agg(F.ceil(F.count(F.lit(1)) / F.lit(piece)).cast("int").alias("_pieces"))
    pieces = checkpointed(sized.where("_pieces > 1"))
    n = F.coalesce("_pieces", F.lit(1))
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(x) for x in names]
    # a column that is all null, or of lists, costs the square of a batch's rows on its way to Python
    empty = lambda *names: [F.lit("").alias(x) for x in names]
    who = people.join(small(pieces), case, "left").select(
        F.col(case).cast("string").alias("case"), F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"), F.lit(0).alias("kind"), F.struct(*order).alias("order"), text(person).alias("person"), text(code).alias("code"), text(name).alias("name"),
        *none(items.schema, "row"), *empty("sentence", "sources", "ref"),
    )
    dealt = F.xxhash64(*(c for c, kind in items.dtypes if "map<" not in kind))  # a map has no hash
    what = items.where(F.col(case).isNotNull()).join(small(pieces), case, "left").select(
        F.col(case).cast("string").alias("case"), F.pmod(dealt, n).cast("int").alias("piece"), F.lit(1).alias("kind"), *none(who.schema["order"].dataType, "order"), *empty("person", "code"), text(item_name).alias("name"),
        F.struct(*items.columns).alias("row"), text(sentence).alias("sentence"), F.lit("").alias("sources") if sources is None else F.coalesce(F.to_json(F.col(sources).cast("array<string>")), F.lit("")).alias("sources"), F.coalesce(text(ref), F.lit("")).alias("ref"),
    )
    met = who.where("case IS NOT NULL").unionByName(what).repartition("case", "piece").sortWithinPartitions("case", "piece", "kind", "order").drop("order")
    told = StructType([StructField("_row", items.schema), StructField("_people", ArrayType(StringType())), StructField("attribution", StringType())])
    out = met.mapInArrow(_attributed, told).select("_row.*", "_people", "attribution")
    orphans = items.where(F.col(case).isNull()).select("*", F.lit(None).cast("array<string>").alias("_people"), F.lit("orphan").alias("attribution"))
    return out.unionByName(orphans).withColumn("person", F.explode_outer("_people")).drop("_people")
