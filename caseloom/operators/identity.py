"""Which records describe the same person: evidence columns, an explainable score, tiers and groups.

Every decision keeps what led to it (evidence, score, tier, review flag); nothing is merged without them. Records resolve
against a snapshot of earlier ones, so a result does not depend on the order in which rows are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import nested, similarity
from ..functions import text as T
from .joins import first_per_key

#: Numbers that people give instead of one.
FAKE_PHONES = ("9000000000", "9999999999", "8888888888", "7777777777", "0000000000", "1111111111", "1234567890", "9876543210", "9111111111", "9000000001")
#: Weights of the evidence, and what is added for context.
WEIGHTS = {"name": 0.30, "tokens": 0.10, "fuzzy_tokens": 0.20, "sound": 0.15, "address": 0.12, "age": 0.10, "alias": 0.03}
BOOSTS = {"same_station": 0.05, "same_offence": 0.04, "shared_associates": 0.06, "phone": 0.10, "alias_cross": 0.08, "same_age_and_gender": 0.12}
ADOPT, REVIEW = 0.70, 0.45
#: Confidence of a fingerprint by its tier.
TIER_WEIGHTS = (0.95, 0.90, 0.85, 0.75, 0.65)
#: The DNS namespace of RFC 4122, for deterministic ids.
NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def age_score(a: Column, b: Column) -> Column:
    """0.8 for at most two years apart, falling to 0 at ten; 0.3 if one is unknown (null or 0), 0 if both are."""
    x, y = F.nullif(a, F.lit(0)), F.nullif(b, F.lit(0))
    apart = F.abs(x - y)
    return F.when(x.isNull() & y.isNull(), 0.0).when(apart.isNull(), 0.3).when(apart <= 2, 0.8).when(apart >= 10, 0.0).otherwise(0.8 - (apart - 2) * 0.1)


def alias_score(a: Column, b: Column) -> Column:
    return F.when((T.normal_name(a) == T.normal_name(b)) & (a != ""), 1.0).otherwise(0.0)


def real_phones(phones: Column) -> Column:
    """Last ten digits of each number of an array, without short and made-up ones."""
    digits = F.transform(phones, T.phone_digits)
    return F.array_distinct(F.filter(digits, lambda d: (F.length(d) >= 8) & ~d.isin(*FAKE_PHONES)))


def phone_score(a: Column, b: Column) -> Column:
    return F.when(F.coalesce(F.arrays_overlap(real_phones(a), real_phones(b)), F.lit(False)), 1.0).otherwise(0.0)


def address_similarity(a: Column, b: Column) -> Column:
    return similarity.jaccard(T.address_tokens(a), T.address_tokens(b))


def token_similarity(a: Column, b: Column) -> Column:
    """Dice of the words; two single words without overlap count half their likeness."""
    x, y = similarity.words(T.normal_name(a)), similarity.words(T.normal_name(b))
    plain = similarity.dice(x, y)
    single = (F.size(x) == 1) & (F.size(y) == 1) & (plain == 0)
    one = lambda c: F.when(single, T.normal_name(c)).otherwise("")  # noqa: E731  Python is called for every row
    return F.when(single, similarity.name_similarity(one(a), one(b)) * 0.5).otherwise(plain)


@F.pandas_udf(DoubleType())
def _fuzzy_dice(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    return pd.Series([2.0 * sum(any(similarity.alike(s, t, k) for t in y) for s in x) / max(len(x) + len(y), 1) for x, y, k in zip(a, b, least, strict=True)], dtype="float64")


def fuzzy_token_similarity(a: Column, b: Column, least: float = 0.85) -> Column:
    """Dice of words, where words match from a likeness of `least` on."""
    return _fuzzy_dice(similarity.words(T.normal_name(a)), similarity.words(T.normal_name(b)), F.lit(least))


def prepared(p: Column) -> Column:
    """A person with what `evidence` needs of one side alone: done before pairs are made, it is done once a record."""
    n = T.normal_name(p["name"])
    words = similarity.words(n)
    codes = F.array_distinct(F.transform(words, lambda w: similarity.soundex_or_zero(w)))
    return p.withField("_n", n).withField("_words", words).withField("_codes", codes).withField("_tokens", T.address_tokens(p["address"])).withField("_phones", real_phones(p["phones"])).withField("_alias", T.normal_name(p["alias"]))


def evidence(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs (two structs: name, alias, age, gender, phones, address, station, offence, associates; the last two arrays)
    with one column of evidence per rule. Structs that are not `prepared` are, pair by pair."""
    for s in (a, b):
        if "_n" not in pairs.schema[s].dataType.names:
            pairs = pairs.withColumn(s, prepared(F.col(s)))
    f = lambda s, name: F.col(f"{s}.{name}")
    both = lambda name: (f(a, name), f(b, name))
    overlap = lambda name: F.coalesce(F.arrays_overlap(*both(name)), F.lit(False))
    same = lambda name: F.coalesce(f(a, name) == f(b, name), F.lit(False))

    def likeness(x: str, y: str, name: str, alias: str) -> Column:
        filled = (F.coalesce(f(x, "name"), F.lit("")) != "") & (F.coalesce(f(y, "alias"), F.lit("")) != "")
        one = lambda c: F.when(filled, c).otherwise("")  # noqa: E731  Python is called for every row
        return F.when(filled, similarity.name_similarity(one(f(x, name)), one(f(y, alias)))).otherwise(0.0)

    plain = similarity.dice(*both("_words"))
    single = (F.size(f(a, "_words")) == 1) & (F.size(f(b, "_words")) == 1) & (plain == 0)
    likely = similarity.name_similarity(*both("_n"))
    out = pairs.withColumns({
        "tokens": F.when(single, likely * 0.5).otherwise(plain), "fuzzy_tokens": _fuzzy_dice(*both("_words"), F.lit(0.85)), "sound": similarity.sound_overlap(*both("_n"), *both("_codes")),
        "address": similarity.jaccard(*both("_tokens")), "age": age_score(*both("age")), "alias": F.when((f(a, "_alias") == f(b, "_alias")) & (f(a, "alias") != ""), 1.0).otherwise(0.0),
        "phone": F.when(F.coalesce(F.arrays_overlap(*both("_phones")), F.lit(False)), 1.0).otherwise(0.0), "alias_cross": F.greatest(likeness(a, b, "_n", "_alias"), likeness(b, a, "_n", "_alias")),
        "same_station": same("station"), "same_offence": overlap("offence"), "shared_associates": overlap("associates"), "same_gender": F.coalesce(F.lower(f(a, "gender")) == F.lower(f(b, "gender")), F.lit(False)), "_likely": likely,
    })
    likely = F.col("_likely")
    return out.withColumns({"name": F.when(F.col("tokens") == 1.0, F.greatest(likely, F.lit(0.95))).otherwise(likely), "same_age_and_gender": F.col("same_gender") & (F.col("fuzzy_tokens") > 0) & same("age") & (f(a, "age") > 0)}).drop("_likely")


def _weighed(e: dict, odd, only_common, where: Callable = lambda c, x, y: F.when(c, x).otherwise(y), least: Callable = lambda x, y: F.least(x, F.lit(y)), greatest: Callable = lambda x, y: F.greatest(x, F.lit(y))) -> tuple:
    """strong and the score, not rounded, of a value per evidence, of columns or arrays; it never falls where evidence or
    strong grows or odd falls."""
    score = sum(w * e[c] for c, w in WEIGHTS.items())
    boosted = {"phone": e["phone"] > 0, "alias_cross": e["alias_cross"] > 0.85}
    for c, w in BOOSTS.items():
        score = score + where(boosted.get(c, e[c]), w, 0.0)
    strong = (e["phone"] > 0) | (e["address"] > 0.8) | ((e["age"] > 0.8) & e["same_gender"]) | (e["same_station"] & e["shared_associates"])
    score = score - 0.15 * odd * where(strong, 0.3, 1.0)
    score = where(only_common & ~strong, score * 0.6, score)
    other = (e["address"] > 0) | (e["phone"] > 0) | (e["age"] > 0.3) | (e["alias"] > 0) | (e["alias_cross"] > 0)
    score = where(other, score, least(score, 0.64))
    return strong, greatest(least(score, 1.0), 0.0)


def match_score(rows: DataFrame, a: str = "a", b: str = "b", common: tuple[str, ...] = ()) -> DataFrame:
    """rows of `evidence` with strong (corroborated beyond the name) and score between 0 and 1. Words of only one name
    that are not common lower the score; names of common words alone, and names without any other evidence, stay below
    what is adopted."""
    x, y = F.col(f"{a}._words"), F.col(f"{b}._words")
    known = F.array(*map(F.lit, common)).cast("array<string>")
    odd = F.size(F.array_except(F.array_union(F.array_except(x, y), F.array_except(y, x)), known))
    only_common = (F.size(F.array_except(x, known)) == 0) | (F.size(F.array_except(y, known)) == 0)
    used = {*WEIGHTS, *BOOSTS, "same_gender"}
    strong, score = _weighed({c: F.col(c) for c in used}, odd, only_common)
    return rows.withColumn("strong", strong).withColumn("score", F.round(score, 2))


def likeliest(asked: DataFrame, known: DataFrame, common: tuple[str, ...] = (), ties_from: float = 0.0) -> DataFrame:
    """_a, _b, score: for each asked person the known ones of the highest score among all that share a key, are of another
    case and lie within its bounds; all of them where that score is `ties_from` or more, else one at least. asked: _a, a (a struct as
    `evidence` takes it), _case, _from, _until, keys (an array of structs); known: _b, b, _case, _at, keys."""
    from ..shared import checkpointed
    from .joins import dealt
    from .likeliest import search

    a, b = checkpointed(asked.withColumn("a", prepared(F.col("a")))), checkpointed(known.withColumn("b", prepared(F.col("b"))))
    on = [*asked.schema["keys"].dataType.elementType.names, "_left", "_right"]
    keyed = lambda df: df.select(*(c for c in df.columns if c != "keys"), F.explode("keys").alias("_k")).select("*", "_k.*").drop("_k")
    people = a.count()
    left, right = dealt(keyed(a), keyed(b), on[:-2], min(max(people // 64, 2000), 20_000), 10_000)
    weighed = lambda e, odd, only_common: _weighed(e, odd, only_common, np.where, np.minimum, np.maximum)[1]
    types = [df.schema[c].dataType.simpleString() for df, c in ((a, "_a"), (b, "_b"))]
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(people / 2000))
    left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)  # few bytes may be much work
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(search(weighed, common, ties_from), "_a {}, _b {}".format(*types))
    pairs = checkpointed(found.distinct()).join(a.select("_a", "a"), "_a").join(b.select("_b", "b"), "_b")
    scored = checkpointed(match_score(evidence(pairs), common=common).select("_a", "_b", "score"))
    return scored.join(scored.groupBy("_a").agg(F.max("score").alias("_best")), "_a").where("score = _best").drop("_best")


def canonical_id(name: Column, gender: Column, station: Column) -> Column:
    """The same for all records with these words of a name (in any order), gender and station."""
    words = F.array_join(F.array_sort(F.filter(F.split(F.lower(F.coalesce(name, F.lit(""))), r"\s+"), lambda w: w != "")), " ")
    return nested.uuid5(NAMESPACE, F.concat_ws("|", words, F.lower(F.coalesce(gender, F.lit(""))), F.coalesce(station, F.lit(""))))


def is_placeholder(name: Column) -> Column:
    return F.coalesce(F.trim(name) == "", F.lit(True)) | name.rlike(r"(?i)^\s*(?:unknown|unidentified|un-?named)\b")


def resolve(records: DataFrame, scored: DataFrame, known_ids: DataFrame) -> DataFrame:
    """canonical_person_id, match_score, tier and review for each record (record_id, case_id, accused_id, own_canonical,
    placeholder). known_ids: accused_id, canonical of the snapshot. scored: record_id, canonical, score against it.

    Placeholders stay within their case (tier 3); a known accused id decides (tier 0); else the best score: from ADOPT on
    its identity is taken (tier 1), from REVIEW on the record keeps its own and is flagged (tier 2), else tier 3."""
    exact = known_ids.where("accused_id IS NOT NULL").groupBy("accused_id").agg(F.min("canonical").alias("_exact"))
    best = scored.groupBy("record_id").agg(F.max(F.struct("score", "canonical")).alias("_best"))
    r = records.join(exact, "accused_id", "left").join(best, "record_id", "left")
    scoped = nested.uuid5(NAMESPACE, F.concat_ws("|", "case_id", F.coalesce("accused_id", "record_id")))
    score = F.col("_best.score")
    hidden, direct = F.col("placeholder"), F.col("_exact").isNotNull()
    tier = F.when(hidden, 3).when(direct, 0).when(score >= ADOPT, 1).when(score >= REVIEW, 2).otherwise(3)
    chosen = F.when(hidden, scoped).when(direct, F.col("_exact")).when(tier == 1, F.col("_best.canonical")).otherwise(F.col("own_canonical"))
    return r.select("record_id", chosen.alias("canonical_person_id"), F.when(hidden, 0.0).when(~direct, F.coalesce(score, F.lit(0.0))).alias("match_score"), tier.alias("tier"), (tier == 2).alias("review"))


def resolve_in_epochs(records: DataFrame, days: int = 365, years: int = 2, common: tuple[str, ...] = ()) -> DataFrame:
    """record_id, canonical_person_id, match_score, tier, review of records (record_id, case_id, accused_id, day, p: a struct as
    `evidence` takes it) in the order in which they came: windows of so many days are resolved one after the other, each
    against the identities that the windows before it gave. Within a window the order does not matter.

    A record's candidates are all earlier ones of other cases whose names sound alike, as `joins.phonetic_candidates` has
    them; the best score decides, as in `resolve`. Scores do not depend on identities, so the best ones are found for all
    windows at once (`likeliest`), and windows only pass identities on. Records without a day come in the first window; they
    have no candidates and are none."""
    from ..shared import checkpointed
    from .joins import phonetic_keys

    window = F.coalesce(F.floor(F.datediff(F.col("day").cast("date"), F.lit("1970-01-01")) / F.lit(days)), F.lit(-(2**31))).cast("int")
    own = records.withColumn("_window", window).withColumn("own_canonical", canonical_id(F.col("p.name"), F.col("p.gender"), F.col("p.station"))).withColumn("placeholder", is_placeholder(F.col("p.name")))
    own = checkpointed(own)
    windows = sorted(r["_window"] for r in own.select("_window").distinct().collect())  # one per window of time
    if not windows:
        return own.select("record_id").withColumns({"canonical_person_id": F.lit(""), "match_score": F.lit(0.0), "tier": F.lit(0), "review": F.lit(False)})
    first = own.where("accused_id IS NOT NULL").groupBy("accused_id").agg(F.min("_window").alias("_first"))
    named = own.where("NOT placeholder").withColumn("day", F.col("day").cast("date")).withColumn("name", F.col("p.name")).dropna(subset=["day", "case_id", "name"])
    open_ = named.join(first, "accused_id", "left").where((F.col("_window") > windows[0]) & ~F.coalesce(F.col("_first") < F.col("_window"), F.lit(False)))  # the others have a known id
    asked, known = phonetic_keys(open_, named, "name")
    number = lambda c: F.datediff(c, F.lit("1970-01-01"))
    side = lambda df, i, **c: df.select(F.col("record_id").alias(f"_{i}"), F.col("p").alias(i), F.col("case_id").alias("_case"), "keys", *(x.alias(f"_{n}") for n, x in c.items()))
    asked, known = side(asked, "a", **{"from": number(F.add_months("day", -12 * years)), "until": F.col("_window") * days - 1}), side(known, "b", at=number(F.col("day")))
    links = checkpointed(likeliest(asked, known, common, ADOPT).join(own.select(F.col("record_id").alias("_a"), "_window"), "_a"))
    out = None
    for w in windows:
        new = own.where(F.col("_window") == w)
        done = own.select("record_id", F.lit("").alias("canonical")).limit(0) if out is None else out.select("record_id", F.col("canonical_person_id").alias("canonical"))
        scored = links.where(F.col("_window") == w).join(done.withColumnRenamed("record_id", "_b"), "_b").select(F.col("_a").alias("record_id"), "canonical", "score")
        ids = own.where("accused_id IS NOT NULL").select("record_id", "accused_id").join(done, "record_id").select("accused_id", "canonical")
        found = checkpointed(resolve(new.select("record_id", "case_id", "accused_id", "own_canonical", "placeholder"), scored, ids))
        out = found if out is None else out.unionByName(found)
    return out


def fingerprint(tiers: list[list[Column]]) -> Column:
    """struct(tier, fingerprint): MD5 of the first tier whose parts are all filled."""
    tier, digest = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, parts in reversed(list(enumerate(tiers, 1))):
        clean = [F.lower(T.blank_to_null(p.cast("string"))) for p in parts]
        whole = F.lit(True)
        for c in clean:
            whole = whole & c.isNotNull()
        tier, digest = F.when(whole, i).otherwise(tier), F.when(whole, F.md5(F.concat_ws("|", *clean))).otherwise(digest)
    return F.struct(tier.alias("tier"), digest.alias("fingerprint"))


#: Weights by which a row without a fingerprint is attached, and what they must reach; weights of two people.
ATTACH = {"name": 0.40, "relative": 0.30, "relation": 0.15, "gender": 0.10, "age": 0.03, "locality": 0.015, "phone": 0.005}
PERSON = {"name": 0.50, "relative": 0.30, "gender": 0.10, "locality": 0.10}
LEAST = 0.65


def _slip(a: Column, b: Column, most: int = 3) -> Column:
    """Whether two texts of more than four letters differ by so many edits at most."""
    return (F.least(F.length(a), F.length(b)) > 4) & (F.levenshtein(a, b) <= most)


def attach_evidence(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """A value between 0 and 1 per weight of ATTACH; 0 where either side is blank."""
    filled = lambda f: T.blank_to_null(a[f].cast("string")).isNotNull() & T.blank_to_null(b[f].cast("string")).isNotNull()

    def likely(f: str) -> Column:
        x, y = T.normal_name(a[f]), T.normal_name(b[f])
        u, v = similarity.words(x), similarity.words(y)
        overlap = F.size(F.array_intersect(u, v)) / F.greatest(F.size(F.array_union(u, v)), F.lit(1))
        return F.when(_slip(x, y), 1.0).otherwise(F.greatest(similarity.levenshtein_similarity(x, y), overlap))

    apart = F.abs(a["age"].cast("int") - b["age"].cast("int"))
    first = lambda f, p: F.lower(F.left(F.trim(p[f]), F.lit(1)))
    digits = lambda p: T.phone_digits(p["phone"])
    rules = {
        "name": likely("name"), "relative": likely("relative"), "relation": (T.normal_name(a["relation"]) == T.normal_name(b["relation"])).cast("double"), "gender": (first("gender", a) == first("gender", b)).cast("double"),
        "age": F.when(apart == 0, 1.0).when(apart <= 2, 0.8).when(apart <= 5, 0.5).otherwise(0.0), "locality": similarity.levenshtein_similarity(T.normal_name(a["locality"]), T.normal_name(b["locality"])), "phone": (digits(a) == digits(b)).cast("double"),
    }
    return {f: F.when(filled(f), rules[f]).otherwise(0.0) for f in a}


def person_score(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """How much two people (name, relative, gender, locality) are alike, by the ensemble of string scores."""
    value = lambda f: F.when((F.coalesce(a[f], F.lit("")) != "") & (F.coalesce(b[f], F.lit("")) != ""), similarity.ensemble(T.normal_name(a[f]), T.normal_name(b[f]))).otherwise(0.0)
    gender = F.coalesce((F.lower(F.left(a["gender"], F.lit(1))) == F.lower(F.left(b["gender"], F.lit(1)))).cast("double"), F.lit(0.0))
    return F.round(sum((w * (gender if f == "gender" else value(f)) for f, w in PERSON.items()), F.lit(0.0)), 3)


def attach(known: DataFrame, rows: DataFrame, id_: str, person: str, fields: dict[str, str]) -> DataFrame:
    """rows (id) with attached_to, the known person of the highest score from LEAST on (ties: the smaller id), and that score.
    Rows resolve against the known people only, so the result does not depend on their order. Candidates have the first
    three letters of a name's first word in common, or all of a phone number.

    Many share three letters, so the likeliest are tried first: those of the same phone, then those of the same age, then
    all others; a row goes on only while what its filled fields can still reach is not below what it has and LEAST."""
    from ..shared import checkpointed
    from .joins import small

    phone, prefix = T.phone_digits(F.col(fields["phone"])), F.concat(F.lit("p:"), F.left(T.normal_name(F.col(fields["name"])), F.lit(3)))
    keys = {"phone": F.array(F.when(F.length(phone) == 10, phone)), "age": F.array(prefix, F.col(fields["age"]).cast("int").cast("string")), "name": F.array(prefix)}
    side = lambda s: {f: F.col(f"{s}.{c.removeprefix(f'{person}.')}") for f, c in fields.items()}
    evidence = attach_evidence(side("r"), side("k"))
    scored = sum((w * evidence[f] for f, w in ATTACH.items()), F.lit(0.0))
    has = {f: T.blank_to_null(F.col(c).cast("string")).isNotNull() for f, c in fields.items()}
    reach = sum((F.when(has[f], w).otherwise(0.0) for f, w in ATTACH.items()), F.lit(0.0))
    no_phone = F.when(F.length(phone) == 10, ATTACH["phone"]).otherwise(0.0)
    no_age = F.when(has["age"], ATTACH["age"] * 0.2).otherwise(0.0)  # another age is worth 0.8 at most
    reaches = {"phone": reach, "age": reach - no_phone, "name": reach - no_phone - no_age}
    state = rows.select(F.col(id_).alias("_r"), F.col(person).alias("r"), *(k.alias(f"_by_{n}") for n, k in keys.items()), *(r.alias(f"_reach_{n}") for n, r in reaches.items()), F.lit(None).cast(f"struct<_score: double, n: {rows.schema[id_].dataType.simpleString()}>").alias("_best"))
    for n, key in keys.items():
        open_ = state.where(F.col(f"_reach_{n}") >= F.greatest(F.coalesce("_best._score", F.lit(0.0)), F.lit(LEAST)) - 1e-9).where(~F.exists(f"_by_{n}", lambda x: x.isNull()))
        people = known.select(F.col(id_).alias("_k"), F.col(person).alias("k"), key.alias("_key")).where(~F.exists("_key", lambda x: x.isNull()))
        pairs = open_.select("_r", "r", F.col(f"_by_{n}").alias("_key")).join(small(people), "_key")
        best = pairs.withColumn("_score", scored).where(F.col("_score") >= LEAST).groupBy("_r").agg(F.max(F.struct("_score", (-F.col("_k")).alias("n"))).alias("_new"))
        state = checkpointed(state.join(best, "_r", "left").withColumn("_best", F.greatest("_best", "_new")).drop("_new"))
    return state.select(F.col("_r").alias(id_), (-F.col("_best.n")).alias("attached_to"), F.col("_best._score").alias("score"))


def completeness(*columns: Column) -> Column:
    """Share of filled columns."""
    return sum((T.blank_to_null(c.cast("string")).isNotNull().cast("int") for c in columns), F.lit(0)) / float(len(columns))


def confidence(tier: Column, complete: Column) -> Column:
    return F.round(F.coalesce(F.try_element_at(F.array(*map(F.lit, TIER_WEIGHTS)), tier), F.lit(0.5)) * complete, 2)


def roll_up(rows: DataFrame, keys: list[str], id_: str, created: str, cases: str) -> DataFrame:
    """A row per group: its earliest record is the canonical one; all ids, number of records and of cases."""
    return rows.groupBy(*keys).agg(F.min_by(id_, F.struct(created, id_)).alias("canonical_id"), nested.sorted_set(F.col(id_)).alias("ids"), F.count(F.lit(1)).alias("records"), F.sum(cases).alias("cases"))


def offender_bucket(n: Column, fixed: bool = False) -> Column:
    """As published, two cases fall between the classes; fixed=True counts them as several."""
    return F.when(n > 5, "Repeat Offender").when(n > (1 if fixed else 2), "Multiple Cases").when(n == 1, "Single Case").otherwise("No Cases")


def same_case_duplicates(rows: DataFrame, case: str, id_: str, name: str, phones: str, age: str, gender: str, address: str, priority: Column, least: float = 0.93) -> DataFrame:
    """rows without those that repeat another row of their case: the same words in any order or nearly the same name, and
    a phone or age, gender and address in common. The row of higher priority stays (ties: the smaller id). Pairs are made
    within a case and a common initial of any word only."""
    n = T.normal_name(F.col(name))
    initials = F.array_distinct(F.transform(similarity.words(n), lambda w: F.left(w, F.lit(1))))
    r = rows.select(F.col(case).alias("_case"), F.col(id_).alias("_id"), n.alias("_n"), T.name_key(F.col(name)).alias("_key"), F.col(phones).alias("_p"), F.col(age).alias("_age"), F.col(gender).alias("_g"), F.col(address).alias("_ad"), priority.alias("_pr"), F.explode(initials).alias("_i"))
    x, y = r.alias("x"), r.alias("y")
    better = (F.col("x._pr") > F.col("y._pr")) | ((F.col("x._pr") == F.col("y._pr")) & (F.col("x._id") < F.col("y._id")))
    pairs = x.join(y, (F.col("x._case") == F.col("y._case")) & (F.col("x._i") == F.col("y._i")) & better)
    backed = (phone_score(F.col("x._p"), F.col("y._p")) > 0) | ((F.col("x._age") == F.col("y._age")) & (F.col("x._g") == F.col("y._g")) & (address_similarity(F.col("x._ad"), F.col("y._ad")) >= 0.45))
    named = (F.col("x._key") == F.col("y._key")) | (similarity.name_similarity(F.col("x._n"), F.col("y._n")) >= least)
    gone = pairs.where(F.coalesce(backed, F.lit(False))).where(named).select(F.col("y._case").alias(case), F.col("y._id").alias(id_)).distinct()
    return rows.join(gone, [case, id_], "left_anti")


def extracted_matches(name: Column, known: Column) -> Column:
    """The rule by which a name in a text is a known one: exact; the same words; its only word is one of the known; a word
    that sounds like one of the known (Double Metaphone); likeness of the whole; two words and half of the shorter in common; else null."""
    from ..functions.phonetics import word_codes

    x, y = T.normal_name(name), T.normal_name(known)
    a, b = similarity.words(x), similarity.words(y)
    both = F.size(F.array_intersect(a, b))
    steps = [
        (x == y, "exact"), (F.array_sort(a) == F.array_sort(b), "tokens"), ((F.size(a) == 1) & (both == 1), "subset"), (F.arrays_overlap(word_codes(x), word_codes(y)), "sound"),
        (similarity.name_similarity(x, y) >= 0.85, "likeness"), ((both >= 2) & (both * 2 >= F.least(F.size(a), F.size(b))), "overlap"),
    ]
    rule = F.lit(None).cast("string")
    for condition, how in reversed(steps):
        rule = F.when(condition, how).otherwise(rule)
    return F.when((x != "") & (y != ""), rule)


def person_fingerprint(name: Column, parent: Column, locality: Column, district: Column, age: Column, phone: Column) -> Column:
    """struct(tier, fingerprint) by the five tiers of what is known of a person."""
    return fingerprint([[name, parent, locality, age, phone], [name, parent, locality, phone], [name, parent, district, age], [name, phone, age], [name, district, age]])


def merge_extracted(rows: DataFrame, keys: list[str], name: str, quality: Column, fields: list[str]) -> DataFrame:
    """Persons of one list under the same order-free name are one: the row of best quality, its gaps filled by others."""
    from .aggregates import consolidate

    keyed = rows.withColumn("_key", T.name_key(F.col(name))).withColumn("_quality", quality.cast("double"))
    return consolidate(keyed, [*keys, "_key"], "_quality", [name, *fields], name, F.col(name)).drop("_key", "_quality", "sources")


def branch(rows: DataFrame, case: str, person: str) -> DataFrame:
    """A: a case has people with a person id; B: people without one; C (no people) is a case without a row here."""
    return rows.groupBy(case).agg(F.when(F.max(F.col(person).isNotNull()), "A").otherwise("B").alias("branch"), F.count(F.lit(1)).alias("people"))


def pair_roles(people: DataFrame, roles: DataFrame, case: str) -> DataFrame:
    """people (case, accused_id, code, name) with the role (case, code, name, role) of the same code, else the same
    normalised code, else the same name."""
    steps = [("code", F.col("code")), ("normal_code", T.person_code(F.col("code"))), ("name", T.normal_name(F.col("name")))]
    out = people
    for how, key in steps:
        own = roles.select(case, key.alias("_key"), "role").where("_key <> ''").groupBy(case, "_key").agg(F.min("role").alias(f"_{how}"))
        out = out.withColumn("_key", key).join(own, [case, "_key"], "left").drop("_key")
    found = F.coalesce(*(F.col(f"_{how}") for how, _ in steps))
    return out.withColumn("role", found).withColumn("paired_by", F.coalesce(*(F.when(F.col(f"_{how}").isNotNull(), how) for how, _ in steps))).drop(*(f"_{how}" for how, _ in steps))


def history(rows: DataFrame, group: str, id_: str, value):
    """The rows, grouped, of the groups that hold an id: the id is looked up first, so only its groups are read further."""
    return rows.join(rows.where(F.col(id_) == value).select(group).distinct(), group, "left_semi").groupBy(group)


def search_by_name(groups: DataFrame, name: str, part: str, order: str) -> DataFrame:
    return groups.where(F.lower(name).contains(part.lower())).orderBy(F.desc(order), name)


def canonical_of_text_only(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per text-only person, the last in order."""
    return first_per_key(rows, keys, order.desc())
