"""Joins that a plain equi-join does not give at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import checkpointed

#: A table of at most so many rows may be sent to every executor.
BROADCAST_ROWS = 200_000
#: Cells of a grid of pieces (`met`) that one task takes, and the most tasks of a join.
CELLS_A_TASK, MOST_TASKS = 8, 10_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, broadcast if a count shows that it is small; else left to the optimizer."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def first_per_key(df: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """One row per key, the first in order (or the first n). Give a tie-break, or the row among equals is any."""
    return df.withColumn("_nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_nth") <= n).drop("_nth")


def trusted_or_own(rows: DataFrame, person: str, canonical: str, confidence: str, least: float) -> DataFrame:
    """Rows of a canonical identity that are the person's own, or whose identity has any row of enough confidence: the
    trusted identities are computed once and joined, instead of a disjunctive subquery per row."""
    trusted = rows.where(F.col(confidence) > least).select(F.col(canonical).alias("_trusted")).distinct()
    joined = rows.join(trusted, rows[canonical] == trusted["_trusted"], "left")
    return joined.where((F.col(person) == F.col(canonical)) | F.col("_trusted").isNotNull()).drop("_trusted")


def by_kind(rows: DataFrame, kind: str, key: str, parents: dict[str, tuple[DataFrame, str]], name: str) -> DataFrame:
    """A polymorphic join: `kind` says which parent table `key` points to; the parent's named column is added."""
    parts = [rows.where(F.col(kind) == k).join(p.select(F.col(pk).alias("_pk"), F.col(name).alias("parent_name")), F.col(key) == F.col("_pk")).drop("_pk") for k, (p, pk) in parents.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def in_any(rows: DataFrame, key: str, sets: list[DataFrame], set_key: str) -> DataFrame:
    """Rows whose key is in any of several tables: a semi-join with their union, not a disjunction of subqueries."""
    keys = sets[0].select(set_key)
    for s in sets[1:]:
        keys = keys.union(s.select(set_key))
    return rows.join(keys.select(F.col(set_key).alias(key)).distinct(), key, "left_semi")


def split_by_reference(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose reference exists, and the others."""
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    return rows.join(known, key, "left_semi"), rows.join(known, key, "left_anti")


def dealt(left: DataFrame, right: DataFrame, keys: list[str], piece: int = 2000, of_right: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables whose rows of a key meet by keys, _left and _right. A key of more than `piece` rows on either side (`of_right`
    on the right one, if given) is dealt to a grid: both sides' rows go to pieces, and every piece of the one meets every piece of the other in a task of
    its own, so that no task gets all pairs of a common key. Tasks are as many as the cells of all grids ask for, however few
    bytes their rows have."""
    count = lambda df, name, n: df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(n)).cast("int").alias(name))
    hot = checkpointed(count(left, "_lefts", piece).join(count(right, "_rights", of_right or piece), keys).where("_lefts > 1 OR _rights > 1"))
    cells = hot.agg(F.sum(F.col("_lefts").cast("long") * F.col("_rights"))).first()[0] or 0
    tasks = min(math.ceil(cells / CELLS_A_TASK), MOST_TASKS)

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        n = lambda c: F.coalesce(c, F.lit(1))
        held = df.join(small(hot), keys, "left").withColumn(own[:-1], F.pmod(F.xxhash64(*df.columns), n(own)).cast("int"))
        held = held.withColumn(other[:-1], F.explode(F.sequence(F.lit(0), n(other) - 1))).drop("_lefts", "_rights")
        return held.repartition(tasks, *keys, "_left", "_right") if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else held

    return side(left, "_lefts", "_rights"), side(right, "_rights", "_lefts")


def met(left: DataFrame, right: DataFrame, keys: list[str], piece: int = 2000) -> DataFrame:
    """The equi-join of two tables (no other columns in common) on keys, common keys `dealt` to many tasks."""
    left, right = dealt(left, right, keys, piece)
    return left.join(right, [*keys, "_left", "_right"]).drop("_left", "_right")


def blocked_pairs(rows: DataFrame, id_: str, keys: Column, most: int | None = None) -> DataFrame:
    """a, b (a < b): rows that share any of their block keys, each pair once; common keys are dealt to many tasks. `most`
    leaves out keys of more rows than that: common keys say little; `common_keys` lists what was left out."""
    exploded = rows.select(F.col(id_).alias("a"), F.explode(F.array_distinct(keys)).alias("key")).where("key <> ''")
    if most is not None:
        exploded = exploded.join(exploded.groupBy("key").count().where(F.col("count") <= most).select("key"), "key", "left_semi")
    return met(exploded, exploded.withColumnRenamed("a", "b"), ["key"]).where("a < b").select("a", "b").distinct()


def phonetic_candidates(asked: DataFrame, known: DataFrame, id_: str, name: str, case: str, day: str, years: int = 2, most: int | None = None) -> DataFrame:
    """id_, candidate, rank: known records of another case, of the same day as the asked one or up to so many years before
    it, whose names share the sound key (rank 0), else the first Double Metaphone code (rank 1). Names are coded once each, and
    records meet in lists (`_lists`) within an eighth of the years: what meets and is no pair is of the first or last of these
    bins, or of the same case. most: only the first of each record by rank, later days, id; these are read off lists by day
    (`_first_of_lists`), and pairs are made only for cases of more than `most` known records.

    Records without a name, a case or a day have no candidates and are none."""
    from ..functions.phonetics import metaphones

    part = lambda df, *c: df.select(F.col(id_).alias(c[0]), F.col(name).alias("_name"), F.col(case).alias(c[1]), F.col(day).cast("date").alias(c[2])).dropna()
    a, b = part(asked, "_a", "_case_a", "_day_a"), part(known, "_b", "_case_b", "_day_b")
    names = a.select("_name").union(b.select("_name")).distinct()
    coded = checkpointed(names.select("_name", F.soundex("_name").alias("sound"), metaphones(F.col("_name"))["first"].alias("code")))
    held, listed = _lists(coded), None
    if most is not None:
        large = checkpointed(b.groupBy(F.col("_case_b").alias("_case_a")).count().where(F.col("count") > most).select("_case_a"))
        listed = _first_of_lists(a.join(large, "_case_a", "left_anti"), b, coded, held, years, most).withColumnRenamed("_a", id_)
        if large.isEmpty():
            return listed
        a = a.join(large, "_case_a", "left_semi")
    bin_ = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01")) * 8 / F.lit(366 * years)).cast("int")
    since = a.join(coded, "_name").withColumn("_since", F.add_months("_day_a", -12 * years))  # once a record, not once a pair
    left = since.select("_a", "_case_a", "_day_a", "_since", F.explode(_asked_lists()).alias("k")).select("*", "k.*").where("key <> ''").drop("k")
    left = left.withColumn("bin", F.explode(F.sequence(bin_("_since"), bin_("_day_a"))))
    right = b.join(held, "_name").select("rank", "key", "other", "_b", "_case_b", "_day_b", bin_("_day_b").alias("bin"))
    near = (F.col("_day_b") <= F.col("_day_a")) & (F.col("_day_b") >= F.col("_since"))
    found = met(left, right, ["rank", "key", "other", "bin"]).where(near & (F.col("_case_a") != F.col("_case_b")))
    if most is not None:
        found = first_per_key(found, ["_a"], F.col("rank"), F.desc("_day_b"), F.col("_b"), n=most)
    found = found.select(F.col("_a").alias(id_), F.col("_b").alias("candidate"), "rank")
    return found if listed is None else found.unionByName(listed)


def phonetic_keys(asked: DataFrame, known: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Both tables with keys, an array of structs: records share one where their names sound alike as in `phonetic_candidates`."""
    from ..functions.phonetics import metaphones

    names = asked.select(F.col(name).alias("_name")).union(known.select(F.col(name).alias("_name"))).distinct()
    coded = checkpointed(names.select("_name", F.soundex("_name").alias("sound"), metaphones(F.col("_name"))["first"].alias("code")))
    left = asked.withColumn("_name", F.col(name)).join(coded, "_name").withColumn("keys", F.filter(_asked_lists(), lambda k: k["key"] != ""))
    held = _lists(coded).groupBy("_name").agg(F.collect_list(F.struct("rank", "key", "other")).alias("keys"))
    return left.drop("_name", "sound", "code"), known.withColumn("_name", F.col(name)).join(held, "_name").drop("_name")


def _lists(coded: DataFrame) -> DataFrame:
    """_name, rank, key, other: the lists that hold a name: that of its sound key, and those of its code but for one other
    sound key, by which records of that sound ask for it."""
    others = coded.select(F.col("sound").alias("other"), "code").where("code <> ''").distinct()
    own = coded.where("sound <> ''").select("_name", F.lit(0).alias("rank"), F.col("sound").alias("key"), F.lit("").alias("other"))
    return checkpointed(own.unionByName(coded.join(others, "code").where("sound <> other").select("_name", F.lit(1).alias("rank"), F.col("code").alias("key"), "other")))


def _asked_lists() -> Column:
    """The two lists in which a record looks for others."""
    of = lambda rank, key, other: F.struct(F.lit(rank).alias("rank"), F.col(key).alias("key"), other.alias("other"))
    return F.array(of(0, "sound", F.lit("")), of(1, "code", F.col("sound")))


def _first_of_lists(a: DataFrame, b: DataFrame, coded: DataFrame, held: DataFrame, years: int, most: int) -> DataFrame:
    """_a, candidate, rank: the first `most` of each asked record, where no case has more than `most` known records. A list
    (`_lists`) goes by day and id: of a day and list the first 2 * most do, for at most `most` of them are of the asked record's
    case. What a day asks of a list are its last 2 * most places up to that day, in two neighbouring blocks."""
    wide, key = 2 * most, ["rank", "key", "other"]
    asked = a.join(coded, "_name").select("_a", "_case_a", "_day_a", "sound", "code")

    first = lambda by: F.row_number().over(W.partitionBy(*key, "_day_b", *by).orderBy("_b"))
    known = b.join(held, "_name").select(*key, "_day_b", "_case_b", "_b").repartition(*key, "_day_b")
    known = known.withColumn("_nth", first(["_case_b"])).where(F.col("_nth") <= most).withColumn("_nth", first([])).where(F.col("_nth") <= wide).drop("_nth")
    place = F.row_number().over(W.partitionBy(*key).orderBy("_day_b", F.desc("_b")))
    known = checkpointed(known.withColumn("place", place).withColumn("block", F.floor((F.col("place") - 1) / wide)))

    days = asked.select(F.explode(_asked_lists()).alias("k"), F.col("_day_a").alias("day")).select("k.*", "day").distinct()
    ends = known.groupBy(*key, F.col("_day_b").alias("day")).agg(F.max("place").alias("last"))
    last = F.max("last").over(W.partitionBy(*key).orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow))
    upto = days.join(ends, [*key, "day"], "full").withColumn("last", last).where("last IS NOT NULL").join(days, [*key, "day"], "left_semi")
    block = F.floor((F.col("last") - 1) / wide)
    near = F.col("place").between(F.col("last") - wide + 1, F.col("last")) & (F.col("_day_b") >= F.add_months("day", -12 * years))
    tops = upto.withColumn("block", F.explode(F.array(block, block - 1))).join(known, [*key, "block"]).where(near)
    tops = checkpointed(tops.groupBy(*key, "day").agg(F.array_sort(F.collect_list(F.struct((-F.col("place")).alias("at"), F.col("_b").alias("candidate"), F.col("_case_b").alias("of"), "rank"))).alias("top")))

    top = lambda rank, *columns: tops.where(F.col("rank") == rank).select(*(F.col(x).alias(y) for x, y in columns), F.col("day").alias("_day_a"), F.col("top").alias(f"_top{rank}"))
    both = asked.join(top(0, ("key", "sound")), ["sound", "_day_a"], "left").join(top(1, ("key", "code"), ("other", "sound")), ["code", "sound", "_day_a"], "left")
    left = lambda c: F.coalesce(F.filter(c, lambda x: x.of != F.col("_case_a")), F.array())
    return both.select("_a", F.explode(F.slice(F.concat(left("_top0"), left("_top1")), 1, most)).alias("c")).select("_a", "c.candidate", "c.rank")


def _edits(length: Column, least: float) -> Column:
    """How many edits leave a text of this length (the longer one) a Levenshtein similarity of `least`."""
    return F.floor(length * F.lit(1 - least) + F.lit(1e-9)).cast("int")


def _without(text: Column, n: int) -> Column:
    """The distinct texts that are left when any n letters (fewer than all) are taken out."""
    left = F.array(F.struct(text.alias("t"), F.lit(1).alias("at")))
    for _ in range(n):
        left = F.flatten(F.transform(left, lambda x: F.transform(F.filter(F.sequence(F.lit(1), F.length(x.t)), lambda i: i >= x.at), lambda i: F.struct(F.concat(F.substring(x.t, F.lit(1), i - 1), F.substring(x.t, i + 1, F.length(x.t))).alias("t"), i.alias("at")))))
    return F.array_distinct(F.transform(left, lambda x: x.t))


def similar_pairs(names: DataFrame, name: str, least: float, most_texts: int = 500) -> DataFrame:
    """a, b (a < b), distance: all pairs of distinct names of a Levenshtein similarity of `least` (over 0.5) or more; none is
    lost. Two names with at most d edits between them are the same once d letters of the longer one, and d less the difference
    in length of the other, are taken out: they meet by what is left. Where that makes more than `most_texts` texts of a name,
    the shorter one is cut in d + 1 segments, some of which the longer one holds unchanged: names meet by segments, and a
    segment that many names share is dealt to many tasks, but all its pairs are compared."""
    distinct = names.select(F.col(name).alias("_n")).where(F.col(name).isNotNull()).distinct().withColumn("_len", F.length("_n"))
    # a short table makes many texts: it goes to all tasks before it does
    distinct = checkpointed(distinct.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_n"))
    edits = lambda n: math.floor(n * (1 - least) + 1e-9)
    longest = lambda d: max(n for n in range(1, math.ceil((d + 1) / (1 - least)) + 1) if edits(n) == d)
    few = 0
    while math.comb(longest(few + 1), few + 1) <= most_texts:
        few += 1
    pairs = _pairs_by_segments(distinct, least, few)
    for d in range(1, few + 1):
        key = lambda n: F.explode(F.transform(_without(F.col("_n"), n), lambda x: F.xxhash64(x))).alias("key")  # noqa: B023, E731
        longer = distinct.where(_edits(F.col("_len"), least) == d).select(F.col("_n").alias("r"), key(d))
        for apart in range(d + 1):
            shorter = distinct.where(_edits(F.col("_len") + apart, least) == d).select(F.col("_n").alias("s"), key(d - apart))
            met_once = (F.col("r") > F.col("s")) if apart == 0 else F.length("r") == F.length("s") + apart
            pairs = pairs.unionByName(longer.join(shorter.hint("merge"), "key").where(met_once).select("r", "s", F.lit(d).alias("d")))
    found = pairs.withColumn("distance", F.levenshtein("r", "s")).where(F.col("distance") <= F.col("d"))
    return found.select(F.least("r", "s").alias("a"), F.greatest("r", "s").alias("b"), "distance").distinct()


def _pairs_by_segments(distinct: DataFrame, least: float, above: int) -> DataFrame:
    """r, s, d: names that may have d edits between them, for all d over `above`."""
    one = F.lit(1)
    # the shorter name: for every d that a partner of its length or more may bring
    longest = F.floor(F.col("_len") / F.lit(least) + F.lit(1e-9)).cast("int")
    index = distinct.select(F.col("_n").alias("s"), F.col("_len").alias("len"), F.explode(F.array_distinct(F.transform(F.sequence("_len", longest), lambda n: _edits(n, least)))).alias("d")).where(F.col("d") > above)
    starts = lambda i, size, parts: F.floor(size * i / parts).cast("int")
    index = index.select("s", "len", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("part"))
    begin, end = starts(F.col("part"), F.col("len"), F.col("d") + 1), starts(F.col("part") + 1, F.col("len"), F.col("d") + 1)
    index = index.select("s", "len", "d", "part", F.expr("s").substr(begin + one, end - begin).alias("text"))
    # the longer name: where segments of every shorter length may stand in it
    probe = distinct.withColumn("d", _edits(F.col("_len"), least)).where(F.col("d") > above).select(F.col("_n").alias("r"), F.col("_len").alias("size"), "d", F.explode(F.sequence(F.greatest(F.col("_len") - F.col("d"), one), F.col("_len"))).alias("len"))
    probe = probe.select("r", "size", "d", "len", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("part"))
    at, until = starts(F.col("part"), F.col("len"), F.col("d") + 1), starts(F.col("part") + 1, F.col("len"), F.col("d") + 1)
    probe = probe.withColumn("n", until - at).withColumn("at", F.explode(F.sequence(F.greatest(at - F.col("d"), F.lit(0)), F.greatest(F.least(at + F.col("d"), F.col("size") - (until - at)), F.lit(0)))))
    probe = probe.select("r", "d", "len", "part", F.col("r").substr(F.col("at") + one, F.col("n")).alias("text")).distinct()
    return met(probe, index, ["d", "len", "part", "text"]).where("r <> s").select("r", "s", "d").distinct()


def name_keys(name: Column) -> Column:
    """Block keys of a lower-case name: the whole of it, its first three letters, its words of more than three letters."""
    words = F.transform(F.filter(F.split(name, " "), lambda w: F.length(w) > 3), lambda w: F.concat(F.lit("w:"), w))
    return F.concat(F.array(F.concat(F.lit("n:"), name), F.concat(F.lit("p:"), F.left(name, F.lit(3)))), words)


def common_keys(rows: DataFrame, id_: str, keys: Column, most: int) -> DataFrame:
    return rows.select(F.col(id_), F.explode(F.array_distinct(keys)).alias("key")).groupBy("key").count().where(F.col("count") > most)


def best_match(rows: DataFrame, text: str, known: DataFrame, name: str, similarity, least: float, parent: str | None = None) -> DataFrame:
    """rows with the most similar name of a table (within the same parent, if one is named) and its score; null below
    `least`. Ties go to the first name. Distinct texts are matched once. similarity: a Jaccard similarity of trigrams; two
    texts of `least` or more must share a trigram among the first n - ceil(least * n) + 1 in a fixed order, so only these
    make candidates."""
    from ..functions.similarity import trigrams

    p = [parent] if parent else []

    def prefixes(df: DataFrame, c: str) -> DataFrame:
        grams = F.array_sort(F.transform(trigrams(F.col(c)), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))
        n = F.size("_grams")
        kept = F.slice("_grams", 1, (n - F.ceil(n * F.lit(least) - F.lit(1e-6)) + 1).cast("int"))
        return df.withColumn("_grams", grams).where(n > 0).withColumn("_gram", F.explode(F.transform(kept, lambda x: x.g))).drop("_grams")

    texts = rows.select(text, *p).where(F.col(text).isNotNull()).distinct()
    b = prefixes(known.select(F.col(name).alias("_name"), *p).distinct(), "_name")
    pairs = prefixes(texts, text).join(small(b), ["_gram", *p]).select(text, *p, "_name").distinct()
    scored = pairs.withColumn("score", similarity(F.col(text), F.col("_name"))).where(F.col("score") >= least)
    best = first_per_key(scored, [text, *p], F.desc("score"), F.col("_name")).withColumnRenamed("_name", "match")
    return rows.join(best, [text, *p], "left")


def containing(texts: DataFrame, text: str, known: DataFrame, part: str) -> DataFrame:
    """Pairs of a text and a known part of three letters or more that it contains: a part is looked up by one three-letter
    string of its own, so no text meets parts that it has nothing of."""
    threes = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3)))
    own = F.array_min(F.transform(threes(F.col(part)), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))["g"]
    keyed = known.where(F.length(part) > 2).withColumn("_three", own)
    cut = texts.where(F.length(text) > 2).withColumn("_three", F.explode(F.array_distinct(threes(F.col(text)))))
    return cut.join(small(keyed), "_three").where(F.col(text).contains(F.col(part))).drop("_three")


def lookup_ladder(rows: DataFrame, text: str, known: DataFrame, raw: str, standard: str, similarity, least: float) -> DataFrame:
    """standard name by exact match, else the longest known name inside the text, else the most similar; and which."""
    low = F.lower(F.trim(F.col(text)))
    k = known.groupBy(F.lower(F.trim(F.col(raw))).alias("_raw")).agg(F.min(standard).alias("_std"))
    texts = rows.select(low.alias("_text")).where("_text IS NOT NULL").distinct()
    exact = texts.join(k, F.col("_text") == F.col("_raw")).select("_text", F.col("_std").alias("_exact"))
    inside = containing(texts, "_text", k, "_raw").groupBy("_text").agg(F.max_by("_std", F.struct(F.length("_raw"), "_raw")).alias("_inside"))
    near = best_match(texts, "_text", k.select(F.col("_raw").alias("_raw2")), "_raw2", similarity, least).join(k, F.col("match") == F.col("_raw")).select("_text", F.col("_std").alias("_near"))
    ladder = texts.join(exact, "_text", "left").join(inside, "_text", "left").join(near, "_text", "left")
    ladder = ladder.select("_text", F.coalesce("_exact", "_inside", "_near").alias("standard_name"), F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_inside").isNotNull(), "contains").when(F.col("_near").isNotNull(), "similar").alias("matched_by"))
    return rows.withColumn("_text", low).join(ladder, "_text", "left").drop("_text")


def _ranked_by_range(rows: DataFrame, key: str, rank: str, first: int) -> DataFrame:
    """rows numbered by key from first on: counts of ranges give offsets, only ranges are sorted."""
    ranges = checkpointed(rows.repartitionByRange(F.col(key)).withColumn("_range", F.spark_partition_id()))
    counts = sorted(ranges.groupBy("_range").count().collect())  # a row per partition
    before = [(c["_range"], first - 1 + sum(x["count"] for x in counts[:i])) for i, c in enumerate(counts)]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "_range int, _before int"))
    nth = F.row_number().over(W.partitionBy("_range").orderBy(key))
    return ranges.withColumn("_nth", nth).join(offsets, "_range").withColumn(rank, F.col("_before") + F.col("_nth")).drop("_range", "_before", "_nth")


def found_or_new(rows: DataFrame, name: str, known: DataFrame, known_name: str, code: str, similarity, least: float, first_new: int) -> DataFrame:
    """Code of the same or a similar known name; distinct other names get new codes from first_new on, by name."""
    matched = best_match(rows, name, known, known_name, similarity, least)
    coded = matched.join(small(known.select(F.col(known_name).alias("match"), F.col(code).alias("_code"))), "match", "left")
    new = _ranked_by_range(coded.where("_code IS NULL").select(name).where(F.col(name).isNotNull()).distinct(), name, "_new", first_new)
    return coded.join(new, name, "left").withColumn("code", F.coalesce("_code", "_new")).withColumn("is_new", F.col("_code").isNull()).drop("_code", "_new", "match", "score")
