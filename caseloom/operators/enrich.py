"""Enrichment against reference tables: addresses, genders, provenance; each result says where it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity
from ..functions import text as T
from .joins import best_match, small

#: A reference that is compared with every row has at most so many rows.
REFERENCE_ROWS = 2000
#: Gender by title, and confidences of the steps.
TITLES = {"mr": "Male", "sri": "Male", "shri": "Male", "mrs": "Female", "smt": "Female", "kumari": "Female", "ms": "Female"}
GIVEN, BY_TITLE, BY_RULE, BY_SUFFIX = 1.0, 0.95, 0.90, 0.65
#: Ends of last names that tell nothing, and ends that mostly go with one gender.
NEUTRAL_ENDS = ("pati", "pathi", "kurthi", "reddy", "raju", "naidu", "gari", "wari", "ouri", "uri", "ari", "puri", "vari", "neni", "sani", "dhar", "kar", "war", "pur")
MALE_ENDS = ("esh", "endra", "kumar", "raj", "veer", "wanth", "kanth", "nath", "deep", "jeet", "preet", "arth")
FEMALE_ENDS = ("ya", "ika", "itha", "ita", "ini", "avani", "avathi", "aveni", "rani", "devi", "veni", "vathi")


def resolve_level(rows: DataFrame, column: str, known: DataFrame, name: str, out: str, parent: str | None = None, least: float = 0.65) -> DataFrame:
    """rows with `out` (the known name that equals column, within the same parent if one is named; else the most similar
    one) and `out`_confidence: 1.0 or 0.6. parent is the column of both tables that holds the resolved level above."""
    key = F.lower(T.squeeze(F.col(column)))
    p = [parent] if parent else []
    names = known.select(F.lower(T.squeeze(F.col(name))).alias("_known"), *p).where("_known IS NOT NULL").distinct()
    keyed = rows.withColumn("_key", key)
    open_ = keyed.select("_key", *p).where("_key <> ''").distinct()
    exact = open_.join(small(names), [F.col("_key") == F.col("_known")] + [open_[c] == names[c] for c in p], "left_semi").withColumn("_exact", F.lit(True))
    rest = open_.join(exact.select("_key", *p), ["_key", *p], "left_anti")
    near = best_match(rest, "_key", names, "_known", similarity.trigram_similarity, least, parent).where("match IS NOT NULL").select("_key", *p, F.col("match").alias("_near"))
    found = keyed.join(exact, ["_key", *p], "left").join(near, ["_key", *p], "left")
    return found.withColumn(out, F.when(F.col("_exact"), F.col("_key")).otherwise(F.col("_near"))).withColumn(f"{out}_confidence", F.when(F.col("_exact"), 1.0).when(F.col("_near").isNotNull(), 0.6)).drop("_key", "_exact", "_near")


def mirror(first: list[str], second: list[str]) -> dict[str, Column]:
    """Columns of two address slots, each filled from the other where it is wholly empty."""
    empty = lambda slot: F.size(F.array_compact(F.array(*(T.blank_to_null(F.col(c)) for c in slot)))) == 0
    a, b = empty(first), empty(second)
    return {x: F.when(a, F.col(y)).otherwise(F.col(x)) for x, y in zip(first, second, strict=True)} | {y: F.when(b, F.col(x)).otherwise(F.col(y)) for x, y in zip(first, second, strict=True)}


def gender(given: Column, name: Column, rule: Column | None = None, accept: float = BY_SUFFIX) -> Column:
    """struct(value, source, confidence): the given value, else a title, else a learned rule, else the end of the last
    name; null where none tells or what tells is below `accept`. An inferred value is marked as such, and callers choose
    the confidence they accept."""
    low = F.lower(F.trim(given))
    own = F.when(low.isin("m", "male"), "Male").when(low.isin("f", "female"), "Female").when(low.isin("t", "transgender", "other"), "Other")
    title = F.lower(F.regexp_extract(name, r"^\s*([A-Za-z]+)\b", 1))
    by_title = F.lit(None).cast("string")
    for word, value in TITLES.items():
        by_title = F.when(title == word, value).otherwise(by_title)
    by_rule = F.lit(None).cast("string") if rule is None else rule
    last = F.element_at(F.split(T.normal_name(name), " "), -1)
    ends = lambda parts: last.rlike(f"(?:{'|'.join(parts)})$")
    by_end = F.when(~ends(NEUTRAL_ENDS), F.when(ends(MALE_ENDS), "Male").when(ends(FEMALE_ENDS), "Female"))
    steps = [(own, "given", GIVEN), (by_title, "title", BY_TITLE), (by_rule, "rule", BY_RULE), (by_end, "suffix", BY_SUFFIX)]
    found = [F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(source).alias("source"), F.lit(c).alias("confidence"))) for v, source, c in steps if c >= accept]
    nothing = F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("double").alias("confidence"))
    return F.coalesce(*found, nothing)


def nearest_with_margin(rows: DataFrame, vector: str, known: DataFrame, known_vector: str, name: str, id_: str, least: float, margin: float) -> DataFrame:
    """rows with the known name of highest cosine, null below `least` or where the second is nearer than margin. The known
    table is a reference of counted, bounded size: it is one broadcast array, and each row keeps its two best names only."""
    entries = known.select(F.col(name).alias("n"), F.col(known_vector).alias("v"))
    if entries.limit(REFERENCE_ROWS + 1).count() > REFERENCE_ROWS:
        raise ValueError(f"the reference has more than {REFERENCE_ROWS} rows: search it with an index")
    held = rows.select(id_, vector).join(F.broadcast(entries.agg(F.collect_list(F.struct("n", "v")).alias("_known"))))
    score = lambda k: F.struct(F.round(similarity.cosine(F.col(vector), k.v), 9).alias("s"), k.n.alias("n"))
    top = held.select(id_, F.slice(F.sort_array(F.transform("_known", score), False), 1, 2).alias("_top")).select(id_, F.try_element_at("_top", F.lit(1)).alias("_first"), F.try_element_at("_top", F.lit(2)).alias("_second"))
    clear = (F.col("_first.s") >= least) & (F.col("_first.s") - F.coalesce("_second.s", F.lit(-1.0)) >= margin)
    return rows.join(top.select(id_, F.when(clear, F.col("_first.n")).alias("match"), F.round("_first.s", 6).alias("score")), id_, "left")


def with_provenance(stored: DataFrame, extracted: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Stored rows keep what they have, extracted ones fill gaps only; provenance map<field, source> of filled fields."""
    j = stored.alias("s").join(extracted.alias("e"), keys, "left")
    value = {f: F.coalesce(T.blank_to_null(F.col(f"s.{f}")), T.blank_to_null(F.col(f"e.{f}"))) for f in fields}
    came = {f: F.when(T.blank_to_null(F.col(f"s.{f}")).isNotNull(), "stored").when(T.blank_to_null(F.col(f"e.{f}")).isNotNull(), "extracted") for f in fields}
    pairs = F.map_from_entries(F.array(*(F.struct(F.lit(f), came[f]) for f in fields)))
    return j.select(*keys, *(v.alias(f) for f, v in value.items()), F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("provenance"))


def is_sample(quantity_g: Column, sentence: Column, most_g: float = 50.0) -> Column:
    """Whether a small quantity is what was taken for analysis."""
    return F.coalesce((quantity_g <= most_g) & F.lower(sentence).rlike(r"\b(?:samples?|aliquots?|fsl)\b"), F.lit(False))


def net_or_gross(rows: DataFrame, keys: list[str], sentence: str) -> DataFrame:
    """rows without gross weights of groups that also have a net weight."""
    low = F.lower(F.col(sentence))
    kind = F.when(low.rlike(r"\bnet\b"), "net").when(low.rlike(r"\bgross\b"), "gross")
    has_net = rows.where(low.rlike(r"\bnet\b")).select(*keys).distinct().withColumn("_net", F.lit(True))
    return rows.withColumn("_kind", kind).join(has_net, keys, "left").where(~F.coalesce((F.col("_kind") == "gross") & F.col("_net"), F.lit(False))).drop("_kind", "_net")


def gross_beside_net(text: Column) -> Column:
    """array<double>: the gross weights, in grams to a tenth, of a text's sentences that state a gross weight and a net or actual one."""
    from .rules import sentences

    amount = r"\D{0,40}?(\d+(?:[.,]\d+)?)\s*(kg|kilo|g)[a-z]*\b"
    gross, net = r"gross\s+w(?:eigh)?t\b" + amount, r"(?:net\s+w(?:eigh)?t|actual\s+weight)\b" + amount
    # words are looked for before patterns; a sentence without an amount behind "gross" gives null
    both = lambda s: F.contains(s, F.lit("gross")) & (F.contains(s, F.lit("net")) | F.contains(s, F.lit("actual"))) & s.rlike(net)
    grams = lambda s: F.round(F.regexp_replace(F.regexp_extract(s, gross, 1), ",", ".").try_cast("double") * F.when(F.regexp_extract(s, gross, 2) == "g", 1.0).otherwise(1000.0), 1)
    low = F.lower(text)
    stated = F.contains(low, F.lit("gross")) & (F.contains(low, F.lit("net")) | F.contains(low, F.lit("actual")))
    found = F.transform(F.filter(F.transform(sentences(text), F.lower), both), grams)
    return F.when(stated, F.array_compact(found)).otherwise(F.array().cast("array<double>"))


def is_gross_beside_net(text: Column, sentence: Column, weight_g: Column, stated: Column | None = None) -> Column:
    """Whether a weight is the gross one of a sentence of the text that states both: its own sentence speaks of a gross weight, and
    some sentence gives this weight (to a tenth of a gram) behind "gross", and a net or actual weight too. stated: what
    `gross_beside_net` gives of the text, where many weights of a text are asked for."""
    low = F.lower(sentence)
    held = F.array_contains(gross_beside_net(text) if stated is None else stated, F.round(weight_g, 1))
    return F.coalesce(F.contains(low, F.lit("gross")) & low.rlike(r"gross\s+w(?:eigh)?t\b") & held, F.lit(False))


def identity_in_text(text: Column, name: Column, chars: int = 120) -> Column:
    """struct(relation, relative, place) found within so many characters behind a name's first mention."""
    at = F.position(F.lower(name), F.lower(text))
    behind = F.when(at > 0, F.substring(text, at, F.length(name) + chars))
    relation = T.relation_of(behind)
    return F.struct(relation["relation"].alias("relation"), F.trim(F.regexp_extract(relation["relative"], r"^([A-Za-z. ]+?)(?:\s+(?:r/o|n/o|aged?)\b.*)?$", 1)).alias("relative"), T.blank_to_null(F.regexp_extract(behind, r"(?i)\b[rn]/o\.?\s+([A-Za-z ]+)", 1)).alias("place"))
