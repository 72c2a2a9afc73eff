"""Classification rules as expressions: ordered conditions, each result explainable by the condition that fired."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .joins import small

#: What case states are called elsewhere.
CASE_STATES = {
    "PT Cases": "PT", "UI Cases": "UI", "New": "UI", "Chargesheet Created": "Chargesheeted", "compounded": "Compounded",
    "Pending Trial": "PT", "Under Investigation": "UI", "Under Trial": "UI",
}
#: Classes by rising priority.
PRIORITY = ("small", "intermediate", "commercial", "cultivation")


def ladder(steps: list[tuple[Column, str]], default: str | None = None) -> Column:
    """The value of the first condition that holds."""
    return reduce(lambda w, s: w.when(*s), steps[1:], F.when(*steps[0])).otherwise(F.lit(default))


def person_status(c: Column) -> Column:
    return ladder([
        (c.ilike("arrest related%"), "Absconding"), (c.ilike("arrest%"), "Arrested"), (c.ilike("surrendered%"), "Arrested"), (c.ilike("absconding"), "Absconding"),
        (c.ilike("41a cr.p.c%") | c.ilike("high court directions%"), "Issued Notice"),
    ], "Unknown")


def case_state(c: Column) -> Column:
    return reduce(lambda out, kv: F.when(c == kv[0], kv[1]).otherwise(out), CASE_STATES.items(), c)


def section_tokens(c: Column) -> Column:
    """"8(c) r/w 20(b)(ii)(C), 27" -> [8c, 8?...]: section codes without hyphens and brackets, then bare numbers, part by part."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)\br/w\b", " ")
    parts = F.transform(F.split(plain, ","), lambda p: F.regexp_replace(F.trim(p), r"(?i)\bNDPSA{1,2}\b", " "))
    codes = lambda p: F.transform(F.regexp_extract_all(p, F.lit(r"(\d+[A-Za-z]?(?:-[A-Za-z0-9]+)*(?:\([A-Za-z0-9]+\))*)"), 1), lambda t: F.lower(F.regexp_replace(t, r"[-()]", "")))
    numbers = lambda p: F.regexp_extract_all(p, F.lit(r"\b(\d+)\b"), 1)
    return F.array_distinct(F.flatten(F.transform(parts, lambda p: F.concat(codes(p), numbers(p)))))


def section_class(code: Column) -> Column:
    """small, intermediate, commercial, cultivation or null for one section code."""
    letters = F.regexp_replace(code, "[^a-z]", "")
    last = F.right(letters, F.lit(1))
    by_letter = lambda c: F.when(c == "a", "small").when(c == "b", "intermediate").when(c == "c", "commercial")
    present = F.when(letters.contains("a"), "a").when(letters.contains("b"), "b").when(letters.contains("c"), "c")
    return F.when(code.rlike(r"^\d+$"), "small").when(code == "8c", "small").when(code.contains("20a"), "cultivation").when(code.rlike("^27[0-9a-z]*$"), "small").otherwise(by_letter(F.when(last.isin("a", "b", "c"), last).otherwise(present)))


def highest_class(codes: Column) -> Column:
    """The class of highest priority among section codes, capitalised."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, PRIORITY)), c)
    best = F.array_max(F.transform(codes, lambda c: F.coalesce(rank(section_class(c)), F.lit(0))))
    return F.when(best > 0, F.initcap(F.element_at(F.array(*map(F.lit, PRIORITY)), F.greatest(best, F.lit(1)).cast("int"))))


def domicile(perm_state: Column, perm_country: Column, pres_state: Column, pres_country: Column, nationality: Column, home: str, native: str, states: list[str]) -> Column:
    """Country first (permanent, present, nationality), then state; null where it cannot be told."""
    norm = lambda c: F.lower(T.blank_to_null(c))
    country = F.coalesce(norm(perm_country), norm(pres_country), norm(nationality))
    state = F.coalesce(norm(perm_state), norm(pres_state))
    return F.when(country != home, "international").when((country == home) & (state == native), "native state").when((country == home) & state.isin(*states), "inter state")


def status_flags(c: Column) -> Column:
    """struct(is_arrested, is_absconding, is_dead, on_date) of a free-text status."""
    from ..functions.dates import date_in_text

    return F.struct(c.rlike(r"(?i)\barrest").alias("is_arrested"), c.rlike(r"(?i)abscond").alias("is_absconding"), c.rlike(r"(?i)\b(?:died|dead|deceased|expired)\b").alias("is_dead"), date_in_text(c).alias("on_date"))


def route(rows: DataFrame, column: str, targets: dict[str, Column]) -> dict[str, DataFrame]:
    """The rows for each target; a row may go to several, or to none."""
    return {name: rows.where(F.coalesce(condition, F.lit(False))) for name, condition in targets.items()}


#: What a text about a role holds, class by class in the order in which they are tested. (Words that hold
#: another word of their class are not repeated.)
ROLES = (
    ("peddler", ("selling", "sold", "retailer", "street dealer", "waiting for customers", "sale of", "business", "to sell", "distributing", "pushing", "hawking", "street sale", "spot sale", "trafficking", "peddling")),
    ("consumer", ("consuming", "consumption", "smoking", "urine test", "tested positive", "for personal use", "for self use", "addict", "consumed", "using drugs", "drug user", "under influence", "for own use")),
    ("organizer_kingpin", ("mastermind", "kingpin", "organizer", "planned the operation", "network leader", "head of", "directed", "controlled", "ringleader", "boss", "gang leader", "in-charge", "overseeing", "coordinating", "managing the operation")),
    ("supplier", ("supplied", "supplier", "distributor", "wholesaler", "bulk", "large quantity", "provided drugs to", "source of", "procured", "transport", "carrying", "delivering", "courier", "driver", "dispatch", "shipment", "transit", "receiver", "recipient", "received from", "crime vehicle", "owner of the vehicle", "brought from", "bought from", "hand over")),
    ("manufacturer", ("manufactured", "production of", "producing", "growing", "cultivator", "farm", "cultivated", "grown", "grower", "cultivation", "producer")),
    ("harbourer", ("shelter", "safe house", "lodge owner", "rented room", "harboured", "concealed", "premises used", "hiding", "stash house", "storing at", "stored at", "kept at", "concealing")),
    ("financier", ("finance", "funded", "funding", "investor", "invested", "money launder", "provided capital", "backer", "sponsored", "money for purchase", "provided money", "lender")),
    ("processor", ("processed ganja", "converted", "refined", "chemical processing", "lab", "processing", "packaging", "packed", "mixing", "adulteration", "weighing and packing")),
    ("peddler", ("caught with", "possession", "purchasing", "purchased", "bought", "buy", "small scale")),
)


def holds(c: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds any of some words, in any case."""
    listed = F.array(*map(F.lit, words))
    return F.coalesce(T.once(F.lower(c), lambda low: F.exists(listed, lambda w: F.contains(low, w))), F.lit(False))


def role(c: Column) -> Column:
    return ladder([(holds(c, words), name) for name, words in ROLES], "unknown")


def is_minor(age: Column, *texts: Column) -> Column:
    """By age, or by a word for it."""
    word = F.concat_ws(" ", *texts).rlike(r"(?i)\b(?:ccl|juvenile|minor|child in conflict)\b")
    return F.coalesce(age.between(1, 17), F.lit(False)) | word


#: Signs of a seizure, of use or a test, of a sale, and of equipment; and what joins a drug to its seizure.
SEIZED = ("seized", "confiscated", "recovered", "found with", "caught with", "arrested with", "possessed of", "possession", "contraband", "apprehended")
USED = ("tested positive", "positive for", "urine test", "drug test", "detected in test", "found positive", "positive in test", "smoked", "consumed", "ingested", "consumption", "drank", "drink")
SOLD = ("sold to", "sold by", "sold for", "selling to", "buyer", "customers", "purchased", "transaction", "transacted", "dealt to", "given to", "distributed to", "bought")
EQUIPMENT = ("urine sample", "drug testing kit", "test kit", "testing kit", "positive indication", "positive result", "matchbox", "matchsticks", "hollow pen tube", "thums up bottle", "plastic bottle", "bottle fitted", "panchanama", "photographs and videography", "nearby bushes")
SEIZURE_OF = ("seized", "confiscated", "recovered", "found with", "apprehended with", "caught with", "arrested with", "in possession of", "possession of", "possessed")


def _near_in_clause(text: Column, name: Column, terms: tuple[str, ...], reach: int) -> Column:
    """Whether some clause has the name as a word with a term at most so many characters before or behind it: a clause is
    cut at the name, and the ends of the pieces that meet it are searched."""
    pieces = F.transform(F.split(text, r"[.\n]"), lambda clause: F.split(clause, F.concat(F.lit(r"\b\Q"), name, F.lit(r"\E\b"))))
    before = lambda p: reduce(lambda x, t: x | F.right(p, F.lit(reach + len(t))).contains(t), terms, F.lit(False))
    behind = lambda p: reduce(lambda x, t: x | F.left(p, F.lit(reach + len(t))).contains(t), terms, F.lit(False))
    near = lambda p: F.exists(F.slice(p, 1, F.size(p) - 1), before) | F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), behind)
    return F.coalesce(F.when(name != "", F.exists(pieces, near)), F.lit(False))


def seizure_filter(sentence: Column, text: Column | None = None, drug: Column | None = None) -> Column:
    """struct(keep, reason) of a sentence about a drug, in its text: use or sale alone is no seizure; a sentence without any
    sign counts if its text has one; equipment counts only where the sentence joins the drug's name to a seizure (within
    80 characters, in one clause)."""
    seized = holds(sentence, SEIZED)
    whole = seized if text is None else seized | holds(text, SEIZED)
    reason = [(~seized & holds(sentence, USED), "CONSUMPTION_ONLY"), (~seized & holds(sentence, SOLD), "SALE_ONLY"), (~whole & F.coalesce(F.trim(sentence) != "", F.lit(False)), "NO_SEIZURE")]
    if drug is not None:
        reason.append((holds(sentence, EQUIPMENT) & ~_near_in_clause(F.lower(sentence), F.lower(F.trim(drug)), SEIZURE_OF, 80), "EQUIPMENT"))
    found = ladder(reason)
    return F.struct(found.isNull().alias("keep"), found.alias("reason"))


def creation_gate(name: Column, text: Column, known: Column) -> Column:
    """struct(keep, reason): whether a person named in a text gets a row. known: whether the case has the name already."""
    low = F.lower(F.coalesce(text, F.lit("")))
    reason = ladder([
        (F.coalesce(F.trim(name) == "", F.lit(True)), "EMPTY_NAME"), (known, "DUPLICATE_IN_DB"), (low.rlike("(?:unknown|unidentified) (?:person|accused)|(?:one|some) unknown"), "UNKNOWN_PERSON_PATTERN"),
        (F.lower(name).rlike(r"\b(?:si|asi|inspector|constable|hc|pc)\b"), "POLICE_OFFICIAL"), (T.near(text, name, r"supplier|purchased from|procured from", 80), "SUPPLIER_CONTEXT"), (T.near(text, name, r"associate|friend of", 80), "ASSOCIATE_ONLY"),
    ])
    return F.struct((reason.isNull() | (reason == "SUPPLIER_CONTEXT")).alias("keep"), reason.alias("reason"))


def without_ignored(rows: DataFrame, name: str, ignored: DataFrame, ignored_name: str, parts: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose name is not on a list and holds none of some parts."""
    key = F.lower(F.trim(F.col(name)))
    out = rows.withColumn("_k", key).join(ignored.select(F.lower(F.trim(F.col(ignored_name))).alias("_k")).distinct(), "_k", "left_anti").drop("_k")
    return out.where(~F.coalesce(F.lower(name).rlike("|".join(parts)), F.lit(False))) if parts else out


#: So many known words are looked up where a text lies; more are joined.
LISTED = 1000


def longest_keyword(rows: DataFrame, text: str, words: DataFrame, word: str) -> DataFrame:
    """rows with the longest known word of one token that their text holds, as keyword. Up to LISTED known words go to every
    task as one list, and rows stay where they are. Beyond, distinct tokens of a text meet the known words, and only the
    tokens that are known are grouped, by a digest of the text."""
    known = words.select(F.lower(F.col(word)).alias("_w")).where("_w <> ''").distinct()
    if known.limit(LISTED + 1).count() <= LISTED:
        held = F.array_intersect(F.regexp_extract_all(F.lower(text), F.lit(r"(\w+)"), 1), F.col("_known"))
        longest = F.array_max(F.transform(held, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
        return rows.crossJoin(F.broadcast(known.agg(F.collect_list("_w").alias("_known")))).withColumn("keyword", longest).drop("_known")
    digest = F.md5(F.col(text).cast("binary"))
    tokens = rows.select(digest.alias("_text"), F.explode(F.array_distinct(F.split(F.lower(text), r"\W+"))).alias("_w"))
    best = tokens.join(small(known), "_w").groupBy("_text").agg(F.max(F.struct(F.length("_w").alias("n"), F.col("_w").alias("w")))["w"].alias("keyword"))
    return rows.withColumn("_text", digest).join(best, "_text", "left").drop("_text")


def sentences(c: Column) -> Column:
    """A text's sentences: cut at line ends, and at a full stop behind a letter or a closing bracket, with a blank after it."""
    return F.filter(F.transform(T.cut(c, r"\s(?:(?<=\n)|(?<=[a-z)][.]\s))"), lambda s: F.trim(s)), lambda s: s != "")


#: What things are packed in.
PACKETS = ("packet", "cover", "bag", "bundle")


def packets(c: Column) -> Column:
    """array<struct(packets, each, unit)>: "3 packets of 2 kg each" and the like."""
    pattern = rf"(?i)(\d+)\s+(?:{'|'.join(PACKETS)})s?[^.\d]{{0,40}}?(\d+(?:\.\d+)?)\s*(kgs?|gms?|grams?|g|ml|l)\b"
    whole = F.regexp_extract_all(c, F.lit(f"({pattern[4:]})".replace("(", "(?i)(", 1)), 1)
    part = lambda x, i: F.regexp_extract(x, pattern, i)
    return F.transform(whole, lambda x: F.struct(part(x, 1).cast("int").alias("packets"), part(x, 2).cast("double").alias("each"), F.lower(part(x, 3)).alias("unit")))


def keyword_base(rows: DataFrame, *columns: str) -> DataFrame:
    """Distinct lower-case words of more than two letters of some columns."""
    joined = F.concat_ws(" ", *columns)
    return rows.select(F.explode(F.split(F.lower(joined), r"\W+")).alias("keyword")).where(F.length("keyword") > 2).distinct()


#: Patterns of identifiers in texts, tested in this order.
IDENTIFIERS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "pan": r"\b[A-Z]{5}\d{4}[A-Z]\b",
    "ifsc": r"\b[A-Z]{4}0[A-Z0-9]{6}\b",
    "vehicle": r"\b[A-Z]{2}\s?\d{1,2}\s?[A-Z]{1,2}\s?\d{4}\b",
    "aadhaar": r"\b\d{4}\s?\d{4}\s?\d{4}\b",
    "phone": r"\b[6-9]\d{9}\b",
}


def identifiers(c: Column) -> Column:
    """array<struct(kind, value)> of the identifiers in a text."""
    def found(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit(f"({pattern})"), 1), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    return F.flatten(F.array(*(found(kind, p) for kind, p in IDENTIFIERS.items())))


def redact(c: Column) -> Column:
    return reduce(lambda out, kv: F.regexp_replace(out, kv[1], f"<{kv[0]}>"), IDENTIFIERS.items(), c)
