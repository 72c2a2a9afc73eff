"""Identity resolution and relationship graphs on customers, parts and their links."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity
from ..functions import text as T
from ..operators import graph, identity, joins
from ..shared import checkpointed
from .base import Registry

R = Registry()


@R.query("""WITH o AS (SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS parent FROM orders GROUP BY 1),
p AS (SELECT c_custkey, lower(c_mktsegment) AS name, lower(parent) AS parent, CASE WHEN c_acctbal > 3000 THEN lower(n_name) END AS locality, lower(r_name) AS district, CASE WHEN n > 8 THEN CAST(n AS VARCHAR) END AS age, CASE WHEN c_acctbal < 6000 THEN CAST(c_nationkey AS VARCHAR) END AS phone
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey LEFT JOIN o ON o_custkey = c_custkey),
k AS (SELECT c_custkey, name || '|' || parent || '|' || locality || '|' || age || '|' || phone AS k1, name || '|' || parent || '|' || locality || '|' || phone AS k2, name || '|' || parent || '|' || district || '|' || age AS k3, name || '|' || phone || '|' || age AS k4, name || '|' || district || '|' || age AS k5 FROM p)
SELECT c_custkey, CASE WHEN k1 IS NOT NULL THEN 1 WHEN k2 IS NOT NULL THEN 2 WHEN k3 IS NOT NULL THEN 3 WHEN k4 IS NOT NULL THEN 4 WHEN k5 IS NOT NULL THEN 5 END AS tier, md5(coalesce(k1, k2, k3, k4, k5)) AS fingerprint FROM k""")
def fingerprint_tiers(t):
    """All five tiers, by what is known of a customer and its orders."""
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderpriority").alias("parent"))
    places = F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    p = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    known = F.when(F.col("c_acctbal") > 3000, F.col("n_name")), F.when(F.col("n") > 8, F.col("n")), F.when(F.col("c_acctbal") < 6000, F.col("c_nationkey"))
    f = identity.person_fingerprint(F.col("c_mktsegment"), F.col("parent"), known[0], F.col("r_name"), known[1], known[2])
    return p.withColumn("f", f).select("c_custkey", "f.tier", "f.fingerprint")


@R.query("""WITH f AS (SELECT c_custkey, c_mktsegment || '|' || c_nationkey AS g, 1 AS n FROM customer)
SELECT g, min(c_custkey) AS canonical_id, array_to_string(list_sort(list(c_custkey)), ',') AS ids, count(*) AS records,
 CASE WHEN count(*) > 5 THEN 'Repeat Offender' WHEN count(*) > 2 THEN 'Multiple Cases' WHEN count(*) = 1 THEN 'Single Case' ELSE 'No Cases' END AS bucket,
 CASE WHEN count(*) > 5 THEN 'Repeat Offender' WHEN count(*) > 1 THEN 'Multiple Cases' WHEN count(*) = 1 THEN 'Single Case' ELSE 'No Cases' END AS bucket_fixed FROM f GROUP BY g""")
def offender_bucket(t):
    """X13 X14"""
    rows = t.customer.select("c_custkey", F.concat_ws("|", "c_mktsegment", "c_nationkey").alias("g"), F.lit(1).alias("n"))
    g = identity.roll_up(rows, ["g"], "c_custkey", "c_custkey", "n")
    return g.select("g", "canonical_id", F.array_join("ids", ",").alias("ids"), "records", identity.offender_bucket(F.col("cases")).alias("bucket"), identity.offender_bucket(F.col("cases"), fixed=True).alias("bucket_fixed"))


@R.query("""SELECT c_custkey, round((2.0 + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END) / 3, 6) AS complete, round(CASE c_custkey % 7 WHEN 1 THEN 0.95 WHEN 2 THEN 0.90 WHEN 3 THEN 0.85 WHEN 4 THEN 0.75 WHEN 5 THEN 0.65 ELSE 0.5 END, 2) AS confidence FROM customer""")
def confidences(t):
    """X13"""
    k = F.col("c_custkey")
    complete = identity.completeness(F.col("c_name"), F.col("c_mktsegment"), F.when(k % 2 == 0, k))
    return t.customer.select("c_custkey", F.round(complete, 6).alias("complete"), identity.confidence(F.nullif(k % 7, F.lit(0)).cast("int"), F.lit(1.0)).alias("confidence"))


@R.query("""WITH a AS (SELECT c_custkey, c_custkey % 30 AS x, c_nationkey AS y FROM customer) SELECT c_custkey,
 round(CASE WHEN x = 0 AND y = 0 THEN 0.0 WHEN x = 0 OR y = 0 THEN 0.3 WHEN abs(x - y) <= 2 THEN 0.8 WHEN abs(x - y) >= 10 THEN 0.0 ELSE 0.8 - (abs(x - y) - 2) * 0.1 END, 6) AS age,
 CASE WHEN c_custkey % 2 = 0 THEN 1.0 ELSE 0.0 END AS phone FROM a""")
def age_and_phone_scores(t):
    """Of two made-up numbers none counts."""
    k = F.col("c_custkey")
    other = F.when(k % 2 == 0, F.concat(F.lit("+91 "), (F.lit(8000000000) + k).cast("string"))).otherwise(F.lit("9999999999"))
    a, b = F.array((F.lit(8000000000) + k).cast("string"), F.lit("9999999999")), F.array(other, F.lit("123"))
    return t.customer.select("c_custkey", F.round(identity.age_score(k % 30, F.col("c_nationkey")), 6).alias("age"), identity.phone_score(a, b).alias("phone"))


@R.query("""WITH p AS (SELECT p_partkey, string_split(lower(p_type), ' ') AS a, string_split(lower(concat(p_type, ' x', p_size % 3)), ' ') AS b FROM part)
SELECT p_partkey, round(2.0 * len(list_intersect(list_distinct(a), list_distinct(b))) / (len(list_distinct(a)) + len(list_distinct(b))), 6) AS dice FROM p""")
def token_dice(t):
    """X3"""
    return t.part.select("p_partkey", F.round(similarity.dice(similarity.words(F.lower("p_type")), similarity.words(F.lower(F.concat("p_type", F.lit(" x"), F.col("p_size") % 3)))), 6).alias("dice"))


def _people(t):
    """Customers, and every fifth again with its words turned round and a misspelling."""
    k = F.col("c_custkey")
    person = lambda name, case: F.struct(name.alias("name"), F.lit("").alias("alias"), (k % 50 + 18).alias("age"), F.lit("Male").alias("gender"), F.array((F.lit(8000000000) + k).cast("string")).alias("phones"), F.concat(F.lit("street "), "c_nationkey").alias("address"), F.col("c_nationkey").cast("string").alias("station"), F.array("c_mktsegment").alias("offence"), F.array().cast("array<string>").alias("associates"), case.alias("case"))
    given = F.translate(F.lpad(k.cast("string"), 6, "0"), "0123456789", "aeioubdgkm")
    first, again = F.concat(given, F.lit(" "), F.lower("c_mktsegment")), F.concat(F.lower("c_mktsegment"), F.lit(" "), given, F.lit("h"))
    return t.customer.select(k.alias("id"), person(first, k).alias("p")), t.customer.where("c_custkey % 5 = 0").select(k.alias("id"), person(again, -k).alias("p"))


@R.query()
def match_scores(t):
    """Every misspelt person against those of the same station whose name has a word of the same sound, but
    for common words; the best score each."""
    known, new = _people(t)
    common = ("building", "automobile", "machinery", "household", "furniture")
    words = F.array_except(similarity.words(T.normal_name(F.col("p.name"))), F.array(*map(F.lit, common)))
    keys = F.array_distinct(F.transform(words, lambda w: F.struct(F.concat_ws(":", F.col("p.station"), similarity.soundex_or_zero(w)).alias("k"))))
    side = lambda df, i, n, **c: df.select(F.col("id").alias(f"_{i}"), F.col("p").alias(i), F.lit(n).alias("_case"), keys.alias("keys"), *(x.alias(f"_{c}") for c, x in c.items()))
    s = identity.likeliest(side(new, "a", 0, **{"from": F.lit(0), "until": F.lit(0)}), side(known, "b", 1, at=F.lit(0)), common)
    return s.groupBy("_a").agg(F.min("_b").alias("known_id"), F.max("score").alias("score")).withColumnRenamed("_a", "new_id")


@R.query("SELECT c_custkey AS record_id, CASE WHEN c_custkey % 10 = 0 THEN 3 WHEN c_custkey % 4 = 0 THEN 0 WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 3 = 1 THEN 2 ELSE 3 END AS tier, c_custkey % 10 <> 0 AND c_custkey % 4 <> 0 AND c_custkey % 3 = 1 AS review FROM customer")
def canonical_identities(t):
    """Placeholders, known ids, adopted, flagged and own identities."""
    k = F.col("c_custkey")
    records = t.customer.select(k.alias("record_id"), F.col("c_nationkey").alias("case_id"), k.alias("accused_id"), identity.canonical_id(F.col("c_name"), F.lit("Male"), F.col("c_nationkey").cast("string")).alias("own_canonical"), (k % 10 == 0).alias("placeholder"))
    scored = t.customer.where("c_custkey % 3 <> 2").select(k.alias("record_id"), F.lit("them").alias("canonical"), F.when(k % 3 == 0, 0.81).otherwise(0.5).alias("score"))
    known = t.customer.where("c_custkey % 4 = 0").select(k.alias("accused_id"), F.lit("known").alias("canonical"))
    return identity.resolve(records, scored, known).select("record_id", "tier", "review")


def _arrivals(t):
    """The first two cases of each customer: a name that is written anew each time, phones and ids that are not always told."""
    nth = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.row_number().over(nth).alias("nth")).where("nth <= 2").join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    k, way = F.col("o_custkey"), F.col("o_orderkey") % 4
    given, family = F.translate(F.lpad(k.cast("string"), 6, "0"), "0123456789", "aeioubdgkm"), F.lower("c_mktsegment")
    name = F.when(F.col("o_orderkey") % 11 == 0, "Unknown person").when(way == 0, F.concat_ws(" ", family, given)).when(way == 1, F.concat(given, F.lit("h "), family)).otherwise(F.concat_ws(" ", given, family))
    person = F.struct(
        name.alias("name"), F.lit("").alias("alias"), (k % 50 + F.year("day") - 1975).alias("age"), F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"), F.when(F.col("o_orderkey") % 3 == 0, F.array((F.lit(8000000000) + k).cast("string"))).otherwise(F.array().cast("array<string>")).alias("phones"),
        F.concat(F.lit("street "), "c_nationkey").alias("address"), F.col("c_nationkey").cast("string").alias("station"), F.array("c_mktsegment").alias("offence"), F.array().cast("array<string>").alias("associates"),
    )
    return o.select(F.col("o_orderkey").alias("record_id"), F.col("o_orderkey").cast("string").alias("case_id"), F.when(F.col("o_orderkey") % 5 == 0, k.cast("string")).alias("accused_id"), "day", person.alias("p"))


@R.query()
def resolved_in_epochs(t):
    """Who is who, year by year, each against the identities of the years before."""
    return identity.resolve_in_epochs(_arrivals(t), common=("building", "automobile", "machinery", "household", "furniture"))


@R.query("SELECT o_custkey, CASE WHEN count(*) FILTER (WHERE o_orderkey % 3 = 0) > 0 THEN 'A' ELSE 'B' END AS branch, count(*) AS people FROM orders GROUP BY o_custkey")
def case_branches(t):
    """X19"""
    return identity.branch(t.orders.select("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("p")), "o_custkey", "p")


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 3 WHEN 0 THEN 'r0' WHEN 1 THEN 'r1' END AS role, CASE l_linenumber % 3 WHEN 0 THEN 'code' WHEN 1 THEN 'normal_code' END AS paired_by FROM lineitem")
def paired_roles(t):
    """X18"""
    n = F.col("l_linenumber")
    people = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.when(n % 3 == 1, "A").otherwise("A-"), n).alias("code"), F.lit("nobody").alias("name"))
    roles = t.lineitem.where(n % 3 != 2).select("l_orderkey", F.concat(F.lit("A-"), n).alias("code"), F.lit("x").alias("name"), F.concat(F.lit("r"), n % 3).alias("role")).distinct()
    return identity.pair_roles(people, roles, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "role", "paired_by")


@R.query("""WITH g AS (SELECT o_custkey, list(o_orderkey) AS ids, count(*) AS n FROM orders GROUP BY 1) SELECT o_custkey, n FROM g WHERE list_contains(ids, 7)""")
def crime_history(t):
    """Who was in a case, and in how many: the case decides first, and only its people are counted."""
    return identity.history(t.orders, "o_custkey", "o_orderkey", 7).agg(F.count(F.lit(1)).alias("n"))


#: Known codes of the words of part names.
_CODES = {"blue": "PL", "cold": "KLT", "hot": "HT", "large": "LRJ", "new": "N", "old": "ALT", "red": "RT", "small": "SML", "anvil": "ANFL", "bolt": "PLT", "gear": "JR", "gizmo": "JSM", "plate": "PLT", "ring": "RNK", "rod": "RT", "widget": "AJT"}
_CODE_SQL = "list_transform(string_split({}, ' '), lambda w: map_extract_value(MAP {{" + ", ".join(f"'{w}': '{c}'" for w, c in _CODES.items()) + "}}, w))"


@R.query(f"""WITH n AS (SELECT DISTINCT l_orderkey, p_partkey, p_name, p_size FROM lineitem JOIN part ON p_partkey = l_partkey),
p AS (SELECT a.l_orderkey, a.p_partkey AS a_key, b.p_partkey AS b_key, CASE a.p_size % 3 WHEN 0 THEN a.p_name WHEN 1 THEN concat(split_part(a.p_name, ' ', 2), ' ', split_part(a.p_name, ' ', 1)) ELSE split_part(a.p_name, ' ', 2) END AS x, b.p_name AS y FROM n a JOIN n b ON a.l_orderkey = b.l_orderkey AND a.p_partkey <> b.p_partkey)
SELECT l_orderkey, a_key, b_key, CASE WHEN x = y THEN 'exact' WHEN list_sort(string_split(x, ' ')) = list_sort(string_split(y, ' ')) THEN 'tokens' WHEN NOT contains(x, ' ') AND list_contains(string_split(y, ' '), x) THEN 'subset'
  WHEN len(list_intersect({_CODE_SQL.format('x')}, {_CODE_SQL.format('y')})) > 0 THEN 'sound' WHEN jaro_winkler_similarity(x, y) >= 0.85 THEN 'likeness' END AS rule FROM p""")
def extracted_name_rules(t):
    """Names as a text gives them (whole, turned round, the last word) against the other names of their case."""
    n = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "p_partkey", "p_name", "p_size").repartition("l_orderkey").distinct()  # cases meet where they lie from here on
    first, last, way = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2)), F.col("p_size") % 3
    a = n.select("l_orderkey", F.col("p_partkey").alias("a_key"), F.when(way == 0, F.col("p_name")).when(way == 1, F.concat_ws(" ", last, first)).otherwise(last).alias("x"))
    pairs = a.join(n.select("l_orderkey", F.col("p_partkey").alias("b_key"), F.col("p_name").alias("y")), "l_orderkey").where("a_key <> b_key")
    rules = checkpointed(pairs.select("x", "y").distinct().withColumn("rule", identity.extracted_matches(F.col("x"), F.col("y"))))  # each pair of names once
    return pairs.join(joins.small(rules), ["x", "y"]).select("l_orderkey", "a_key", "b_key", "rule")


@R.query("SELECT c_custkey, 1 AS c FROM customer UNION ALL SELECT c_custkey, 2 FROM customer WHERE c_custkey % 2 = 0")
def same_case_duplicates(t):
    """Each case has a person and its copy with turned words; every other copy has nothing else in common and stays."""
    given = F.translate(F.lpad(F.col("c_custkey").cast("string"), 6, "0"), "0123456789", "aeioubdgkm")
    row = lambda c, name, phone: t.customer.select("c_custkey", F.lit(c).alias("c"), name.alias("name"), F.array(phone).alias("phones"), F.lit(c).alias("age"), F.lit("m").alias("g"), F.lit("street").alias("ad"))
    own = F.concat(F.lit("80000"), F.lpad(F.col("c_custkey").cast("string"), 5, "0"))
    rows = row(1, F.concat(given, F.lit(" kumar")), own).unionByName(row(2, F.concat(F.lit("kumar "), given), F.when(F.col("c_custkey") % 2 == 0, F.lit("9999999999")).otherwise(own)))
    return identity.same_case_duplicates(rows, "c_custkey", "c", "name", "phones", "age", "g", "ad", -F.col("c")).select("c_custkey", "c")


@R.query("SELECT c_nationkey, c_mktsegment AS name, max(c_acctbal) AS balance, count(*) AS merged FROM customer GROUP BY 1, 2")
def merged_extracted(t):
    """X20"""
    out = identity.merge_extracted(t.customer.select("c_nationkey", F.col("c_mktsegment").alias("name"), F.col("c_acctbal").alias("balance")), ["c_nationkey"], "name", F.col("balance") + 100000, ["balance"])
    return out.select("c_nationkey", "name", "balance", F.col("merged").cast("long").alias("merged"))


ENSEMBLE = """0.25 * (1 - levenshtein(a, b) / greatest(length(a), length(b), 1)::DOUBLE) + 0.25 * tokens + 0.20 * shared / greatest(least(len(x), len(y)), 1)
 + 0.15 * shared / greatest(len(x) + len(y) - shared, 1) + 0.15 * 2.0 * shared / greatest(len(x) + len(y), 1)"""


@R.query(f"""WITH RECURSIVE n AS (SELECT DISTINCT p_brand, lower(p_name) AS p_name FROM part), p AS (SELECT DISTINCT a.p_name AS a, b.p_name AS b FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_name < b.p_name),
w AS (SELECT a, b, list_distinct(string_split(a, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM p), o AS (SELECT *, array_to_string(list_sort(string_split(a, ' ')), ' ') AS p, array_to_string(list_sort(string_split(b, ' ')), ' ') AS q FROM w),
l AS (SELECT p, q, 0 AS j, list_transform(range(0, length(p) + 1), lambda i: 0) AS row FROM (SELECT DISTINCT p, q FROM o)
  UNION ALL SELECT p, q, j + 1, list_reduce(range(1, length(p) + 1), lambda done, i: list_append(done, CASE WHEN substr(p, i, 1) = substr(q, j + 1, 1) THEN row[i] + 1 ELSE greatest(row[i + 1], done[i]) END), [0]) FROM l WHERE j < length(q)),
k AS (SELECT p, q, 2.0 * row[length(p) + 1] / (length(p) + length(q)) AS tokens FROM l WHERE j = length(q)),
s AS (SELECT o.*, tokens, len(list_intersect(x, y))::DOUBLE AS shared FROM o JOIN k ON k.p = o.p AND k.q = o.q)
SELECT a, b, round({ENSEMBLE}, 6) AS score FROM s""")
def ensemble_similarity(t):
    """X15, its string score: distinct names of one brand, each pair scored once."""
    n = t.part.select("p_brand", F.lower("p_name").alias("n")).distinct()
    pairs = n.select("p_brand", F.col("n").alias("a")).join(n.select("p_brand", F.col("n").alias("b")), "p_brand").where("a < b").select("a", "b").distinct()
    return pairs.select("a", "b", F.round(similarity.ensemble(F.col("a"), F.col("b")), 6).alias("score"))


def _relatives(t):
    """Known people, and rows without a fingerprint: every fourth again, with a slip in its name, some without relative."""
    k = F.col("c_custkey")
    given = F.concat(F.translate(F.reverse(F.lpad(k.cast("string"), 9, "0")), "0123456789", "kaoinuremt"), F.lit(" "), F.lower("c_mktsegment"))
    person = lambda name, relative, age: F.struct(name.alias("name"), relative.alias("relative"), F.when(T.blank_to_null(relative).isNotNull(), "Father").alias("relation"), F.when(k % 2 == 0, "Male").otherwise("F").alias("gender"), age.alias("age"), F.concat(F.lit("village "), "c_nationkey").alias("locality"), (F.lit(7000000000) + k).cast("string").alias("phone"))
    father = F.concat(F.lit("father "), F.translate(F.lpad(k.cast("string"), 9, "0"), "0123456789", "kaoinuremt"))
    known = t.customer.select(k.alias("id"), person(given, father, k % 50 + 20).alias("p"))
    again = t.customer.where(k % 4 == 0).select((-k - 1).alias("id"), person(F.concat(given, F.lit("s")), F.when(k % 8 == 0, F.lit(" ")).otherwise(father), k % 50 + 21).alias("p"))
    return known, again


@R.query("""SELECT -c_custkey - 1 AS id, CASE WHEN c_custkey % 8 = 4 THEN c_custkey END AS attached_to, CASE WHEN c_custkey % 8 = 4 THEN CAST(round(0.4 + 0.3 + 0.15 + 0.1 + 0.03 * 0.8 + 0.015 + 0.005, 3) AS DOUBLE) END AS score FROM customer WHERE c_custkey % 4 = 0""")
def attached_people(t):
    """Rows without a fingerprint go to the likeliest known person, or stay on their own; without a relative the
    rest of the weights does not reach what is needed."""
    known, again = _relatives(t)
    return identity.attach(known, again, "id", "p", {c: f"p.{c}" for c in ("name", "relative", "relation", "gender", "age", "locality", "phone")}).select("id", "attached_to", F.round("score", 3).alias("score"))


def _edges(t):
    """person -> case, case -> place; and a person's station."""
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", "o_orderkey", "c_nationkey")
    return graph.edges([(t.orders, "o_custkey", "person", "o_orderkey", "case", "involved", 1.0), (placed, "o_orderkey", "case", "c_nationkey", "place", "occurred_at", 0.5)])


EDGES = "e AS (SELECT DISTINCT concat('person:', o_custkey) AS src, concat('case:', o_orderkey) AS dst, 'involved' AS relation, 1.0 AS strength FROM orders UNION ALL SELECT DISTINCT concat('case:', o_orderkey), concat('place:', c_nationkey), 'occurred_at', 0.5 FROM orders JOIN customer ON c_custkey = o_custkey)"


@R.query(f"WITH {EDGES} SELECT src, dst, relation, CAST(strength AS DOUBLE) AS strength FROM e")
def graph_edges(t):
    """G1"""
    return _edges(t)


@R.query(f"WITH {EDGES}, n AS (SELECT src AS node FROM e UNION SELECT dst FROM e) SELECT node, count(src) AS degree FROM n LEFT JOIN e ON src = node GROUP BY node")
def graph_degree(t):
    """G2"""
    return graph.out_degree(_edges(t))


@R.query(f"WITH {EDGES} SELECT concat(a.src, '>', a.dst, '>', b.dst) AS path FROM e a JOIN e b ON a.dst = b.src WHERE a.src = 'person:7'")
def graph_paths(t):
    """To every place from one person."""
    seven = t.customer.where("c_custkey = 7")
    return graph.simple_paths(_edges(t), seven.select(F.lit("person:7").alias("node")), seven.select(F.concat(F.lit("place:"), "c_nationkey").alias("node"))).select(F.array_join("path", ">").alias("path"))


@R.query(f"""WITH {EDGES}, u AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
n AS (SELECT concat('person:', min(b.c_custkey)) AS node FROM customer a JOIN customer b ON a.c_custkey = 7 AND b.c_nationkey = a.c_nationkey AND b.c_custkey > 7 WHERE b.c_custkey IN (SELECT o_custkey FROM orders))
SELECT concat_ws('>', a.src, a.dst, b.dst, c.dst, d.dst) AS path FROM u a JOIN u b ON b.src = a.dst AND b.dst <> a.src JOIN u c ON c.src = b.dst AND c.dst NOT IN (a.src, a.dst) JOIN u d ON d.src = c.dst AND d.dst NOT IN (a.src, a.dst, b.dst) JOIN n ON d.dst = n.node WHERE a.src = 'person:7'
UNION ALL SELECT concat_ws('>', a.src, a.dst, b.dst) FROM u a JOIN u b ON b.src = a.dst AND b.dst <> a.src JOIN n ON b.dst = n.node WHERE a.src = 'person:7'""")
def graph_links_of_two_people(t):
    """G3 over five nodes: how two people of one place are linked, grown from both sides."""
    e = _edges(t)
    both = e.select("src", "dst").union(e.select("dst", "src"))
    seven = t.customer.where("c_custkey = 7").select(F.col("c_nationkey").alias("n"))
    other = t.customer.where("c_custkey > 7").join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").join(seven, F.col("c_nationkey") == F.col("n")).agg(F.concat(F.lit("person:"), F.min("c_custkey")).alias("node"))
    start = t.customer.where("c_custkey = 7").select(F.lit("person:7").alias("node"))
    return graph.simple_paths(both, start, other, 5).select(F.array_join("path", ">").alias("path"))


@R.query("WITH i AS (SELECT p_partkey AS i FROM part UNION SELECT p_partkey + 1 FROM part WHERE p_partkey % 5 <> 0), k AS (SELECT concat('part:', i) AS node, CAST(floor((i - 1) / 5) AS BIGINT) AS g FROM i) SELECT node, min(node) OVER (PARTITION BY g) AS component FROM k")
def graph_components(t):
    """Chains of five parts."""
    k = F.col("p_partkey")
    chain = t.part.select(k.alias("a"), F.when(k % 5 != 0, k + 1).otherwise(k).alias("b"))
    return graph.components(graph.edges([(chain, "a", "part", "b", "part", "next", 1.0)]))


@R.query(f"""WITH {EDGES}, h AS (SELECT src AS node, count(*) AS n FROM e GROUP BY 1 HAVING count(*) > 3 ORDER BY n DESC, node LIMIT 3), p AS (SELECT dst AS node, count(*) AS n FROM e WHERE starts_with(dst, 'place:') GROUP BY 1 HAVING count(*) > 2 ORDER BY n DESC, node LIMIT 1),
c AS (SELECT count(DISTINCT c_nationkey) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)), r AS (SELECT src AS node, count(*) AS n FROM e WHERE relation = 'involved' GROUP BY 1 HAVING count(*) > 1)
SELECT 'hub' AS pattern, node, n FROM h UNION ALL SELECT 'hotspot', node, n FROM p UNION ALL SELECT 'clusters', NULL, n FROM c WHERE n > 1 UNION ALL SELECT 'repeat', node, n FROM r""")
def graph_patterns(t):
    """A person's cases all lie in its place, so there are as many clusters as places with cases."""
    return graph.patterns(_edges(t), roles=("involved",))


@R.query(f"WITH {EDGES} SELECT src, dst, relation, CAST(strength * CASE WHEN relation = 'involved' THEN 1.5 ELSE 1 END AS DOUBLE) AS weight FROM e ORDER BY weight DESC, src, dst LIMIT 25")
def key_connections(t):
    """G6"""
    return graph.key_connections(_edges(t), 25, {"involved": 1.5}).select("src", "dst", "relation", "weight")


@R.query("SELECT c_custkey, c_name, n FROM (SELECT c_custkey, c_name, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) WHERE lower(c_name) LIKE '%00012%' ORDER BY n DESC, c_name")
def person_search(t):
    """X17"""
    g = t.customer.join(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name", "n")
    return identity.search_by_name(g, "c_name", "00012", "n")


@R.query("SELECT c_custkey, lower(c_mktsegment) IN ('building') AS placeholder FROM customer")
def placeholder_names(t):
    """X8 D23"""
    name = F.when(F.lower("c_mktsegment") == "building", F.lit("Unknown male")).otherwise(T.squeeze(F.col("c_name")))
    return t.customer.select("c_custkey", identity.is_placeholder(name).alias("placeholder"))
