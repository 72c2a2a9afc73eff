"""Joins, set operations and nested shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested, similarity
from ..functions import text as T
from ..operators import aggregates, joins, merge, vectors
from ..shared import checkpointed
from .base import Registry

R = Registry()
DEC = "decimal(18,2)"


@R.query("""SELECT o_orderkey, o_custkey, l_linenumber, l_returnflag FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND (l_suppkey % 5) = (o_custkey % 5)""")
def multi_key_join(t):
    """J3"""
    a, b = t.orders.withColumn("k", F.col("o_custkey") % 5), t.lineitem.withColumn("k", F.col("l_suppkey") % 5)
    return a.join(b, (a["o_orderkey"] == b["l_orderkey"]) & (a["k"] == b["k"])).select("o_orderkey", "o_custkey", "l_linenumber", "l_returnflag")


@R.query("SELECT o_orderkey, o_orderdate FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def unprocessed_cases(t):
    """J7 J8"""
    return t.orders.join(t.lineitem.where("l_quantity > 45").select("l_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey", "o_orderdate")


@R.query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%')")
def persons_with_urgent_case(t):
    """J5"""
    return t.customer.join(t.orders.where(F.col("o_orderpriority").startswith("1")).select("o_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@R.query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey AS person, l_partkey - l_partkey % 3 AS canonical, l_discount * 10 AS confidence FROM lineitem)
SELECT l_orderkey, l_linenumber, person, canonical FROM b WHERE person = canonical OR canonical IN (SELECT canonical FROM b WHERE confidence > 0.85)""")
def trusted_identities(t):
    """The identities with a trusted row are one small join instead of a disjunctive subquery."""
    b = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("person"), (F.col("l_partkey") - F.col("l_partkey") % 3).alias("canonical"), (F.col("l_discount") * 10).alias("confidence"))
    return joins.trusted_or_own(b, "person", "canonical", "confidence", 0.85).select("l_orderkey", "l_linenumber", "person", "canonical")


@R.query("""SELECT o_orderkey, r.last_ship, r.n FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey) r ON r.l_orderkey = o_orderkey""")
def last_run_per_case(t):
    """The lateral aggregate as one aggregation and one join."""
    r = t.lineitem.where("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n"))
    return t.orders.join(r, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", "last_ship", "n")


UUID5 = "concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', substr('89ab', 1 + CAST(concat('0x', substr({h}, 17, 1)) AS INTEGER) % 4, 1), substr({h}, 18, 3), '-', substr({h}, 21, 12))"


@R.query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS ord FROM lineitem)
SELECT l_orderkey, CAST(ord AS INTEGER) AS ord, l_partkey, {UUID5.format(h='sha')} AS surrogate FROM (SELECT *, sha1(unhex(repeat('00', 16)) || encode(concat(l_orderkey, ':', ord))) AS sha FROM x)""")
def explode_items_ordinal(t):
    """Items of a case as an array, then out again with their place."""
    packed = t.lineitem.groupBy("l_orderkey").agg(nested.ordered_list(F.col("l_partkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("items"))
    out = packed.select("l_orderkey", F.posexplode("items").alias("pos", "l_partkey")).withColumn("ord", F.col("pos") + 1)
    return out.select("l_orderkey", "ord", "l_partkey", nested.uuid5("00" * 16, F.concat_ws(":", "l_orderkey", "ord")).alias("surrogate"))


@R.query("SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) - 1 AS INTEGER) AS idx FROM lineitem")
def media_index(t):
    """W1"""
    return aggregates.numbered_from_zero(t.lineitem, ["l_orderkey"], F.col("l_shipdate"), F.col("l_linenumber")).select("l_orderkey", "l_linenumber", "idx")


@R.query("""SELECT l_orderkey, string_agg(concat(l_linenumber, ':', l_partkey, ':', l_returnflag), ';' ORDER BY l_linenumber, l_partkey, l_returnflag) AS items, count(DISTINCT l_returnflag) AS kinds FROM lineitem GROUP BY l_orderkey""")
def nested_items_ordered(t):
    """A10 A11 F38"""
    item = F.struct("l_linenumber", "l_partkey", "l_returnflag")
    g = t.lineitem.groupBy("l_orderkey").agg(nested.ordered_list(item, F.col("l_linenumber"), F.col("l_partkey"), F.col("l_returnflag")).alias("items"), F.size(F.collect_set("l_returnflag")).cast("long").alias("kinds"))
    return g.select("l_orderkey", F.array_join(F.transform("items", lambda x: F.concat_ws(":", x.l_linenumber, x.l_partkey, x.l_returnflag)), ";").alias("items"), "kinds")


@R.query("""WITH c AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, string_agg(concat(l_returnflag, '=', n), ',' ORDER BY l_returnflag) AS by_flag FROM c GROUP BY l_orderkey""")
def status_count_map(t):
    """A12"""
    c = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("l_orderkey").agg(nested.to_map(F.col("l_returnflag"), F.col("n")).alias("m"))
    return m.select("l_orderkey", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e.key, e.value)), ",").alias("by_flag"))


@R.query("""SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""")
def union_registered_unregistered(t):
    """U1 P1 P3"""
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@R.query("""WITH u AS (SELECT c_nationkey AS k, 'customer' AS who FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) SELECT k, string_agg(DISTINCT who, ',' ORDER BY who) AS kinds FROM u GROUP BY k""")
def distinct_over_union(t):
    """U3"""
    u = t.customer.select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("who")).union(t.supplier.select("s_nationkey", F.lit("supplier")))
    return u.groupBy("k").agg(F.array_join(nested.sorted_set(F.col("who")), ",").alias("kinds"))


@R.query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 400000)")
def fetched_not_processed(t):
    """U4"""
    return t.customer.select("c_custkey").join(t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").distinct()


@R.query("""SELECT e.event_id, e.event_type, c_name AS parent_name FROM events e JOIN customer ON c_custkey = user_id WHERE event_type = 'click'
UNION ALL SELECT e.event_id, e.event_type, s_name FROM events e JOIN supplier ON s_suppkey = user_id WHERE event_type = 'purchase'""")
def polymorphic_parents(t):
    """J15"""
    return joins.by_kind(t.events.select("event_id", "event_type", "user_id"), "event_type", "user_id", {"click": (t.customer.withColumnRenamed("c_name", "name"), "c_custkey"), "purchase": (t.supplier.withColumnRenamed("s_name", "name"), "s_suppkey")}, "name").drop("user_id")


@R.query("SELECT event_id FROM events WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') OR user_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def in_either_set(t):
    """J16"""
    a, b = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), t.supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("k"))
    return joins.in_any(t.events, "user_id", [a, b], "k").select("event_id")


@R.query("SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NULL THEN 'parked' ELSE 'ok' END AS state FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size < 40) ON p_partkey = l_partkey")
def fk_park_split(t):
    """J25 T10"""
    ok, parked = joins.split_by_reference(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", t.part.where("p_size < 40"), "p_partkey")
    return ok.withColumn("state", F.lit("ok")).unionByName(parked.withColumn("state", F.lit("parked"))).drop("l_partkey")


@R.query("""WITH i AS (SELECT l_orderkey, string_agg(concat(l_linenumber, '/', p_name), '|' ORDER BY l_linenumber, p_name) AS items FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
c AS (SELECT o_custkey, string_agg(concat(o_orderkey, '[', items, ']'), ' ' ORDER BY o_orderkey) AS cases, count(*) AS n_cases FROM orders JOIN i ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT c_custkey, c_name, n_cases, md5(cases) AS cases_md5 FROM customer JOIN c ON o_custkey = c_custkey""")
def three_levels(t):
    """Children first, then their parents: one aggregation and one join per level."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    i = lines.groupBy("l_orderkey").agg(F.array_join(nested.ordered_list(F.concat_ws("/", "l_linenumber", "p_name"), F.col("l_linenumber"), F.col("p_name")), "|").alias("items"))
    c = t.orders.join(i, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.array_join(nested.ordered_list(F.concat("o_orderkey", F.lit("["), "items", F.lit("]")), F.col("o_orderkey")), " ").alias("cases"), F.count(F.lit(1)).alias("n_cases"))
    return t.customer.join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "n_cases", F.md5("cases").alias("cases_md5"))


TRGM = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr(concat('  ', w, ' '), i, 3)))))"


SIMILARITY = "len(list_intersect({a}, {b})) * 1.0 / (len({a}) + len({b}) - len(list_intersect({a}, {b})))"
#: The distinct part names, and each as it is written by mistake: without its last letter and with another word.
SPELLINGS = "k AS (SELECT DISTINCT lower(p_name) AS name FROM part), w AS (SELECT name AS text FROM k UNION SELECT left(name, length(name) - 1) FROM k UNION SELECT concat('old ', name, ' box') FROM k)"


def _spellings(t):
    k = t.part.select(F.lower("p_name").alias("name")).distinct()
    variants = [F.col("name"), F.expr("left(name, length(name) - 1)"), F.concat(F.lit("old "), "name", F.lit(" box"))]
    return k, k.select(F.explode(F.array(*variants)).alias("text")).distinct()


@R.query(f"""WITH {SPELLINGS}, x AS (SELECT text, name, {TRGM.format(c='text')} AS a, {TRGM.format(c='name')} AS b FROM w, k),
s AS (SELECT text, name, {SIMILARITY.format(a='a', b='b')} AS score FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY round(score, 9) DESC, name) AS n FROM s WHERE round(score, 9) >= 0.3)
SELECT w.text, r.name AS match, round(score, 6) AS score FROM w LEFT JOIN r ON r.text = w.text AND n = 1""")
def trigram_match(t):
    """Spellings against the table of names."""
    score = lambda a, b: F.round(similarity.trigram_similarity(a, b), 9)
    known, texts = _spellings(t)
    return joins.best_match(texts, "text", known, "name", score, 0.3).select("text", "match", F.round("score", 6).alias("score"))


@R.query("""WITH a AS (SELECT n_name AS x, n_regionkey FROM nation) SELECT a.x, b.x AS y, levenshtein(a.x, b.x) AS d FROM a JOIN a b ON a.n_regionkey = b.n_regionkey AND a.x < b.x WHERE levenshtein(a.x, b.x) <= 8""")
def levenshtein_match(t):
    """Pairs within one parent."""
    a = t.nation.select(F.col("n_name").alias("x"), "n_regionkey")
    b = a.withColumnRenamed("x", "y")
    return a.join(b, "n_regionkey").where("x < y").withColumn("d", F.levenshtein("x", "y").cast("long")).where("d <= 8").select("x", "y", "d")


@R.query("""WITH n AS (SELECT c_name AS n FROM customer UNION SELECT s_name FROM supplier UNION SELECT p_name FROM part UNION SELECT left(p_name, length(p_name) - 1) FROM part UNION SELECT replace(p_name, ' ', '') FROM part)
SELECT a.n AS a, b.n AS b, levenshtein(a.n, b.n) AS distance FROM n a JOIN n b ON a.n < b.n AND abs(length(a.n) - length(b.n)) <= 2 WHERE levenshtein(a.n, b.n) <= 0.1 * greatest(length(a.n), length(b.n)) + 1e-9""")
def similar_names(t):
    """All pairs of names with one edit in ten letters or fewer, without comparing all."""
    p = F.col("p_name")
    names = t.customer.select("c_name").union(t.supplier.select("s_name")).union(t.part.select(F.explode(F.array(p, p.substr(F.lit(1), F.length(p) - 1), F.replace(p, F.lit(" "), F.lit(""))))))
    return joins.similar_pairs(names.toDF("n"), "n", 0.9).select("a", "b", F.col("distance").cast("long").alias("distance"))


@R.query("""WITH n AS (SELECT DISTINCT lower(p_name) AS name FROM part UNION SELECT DISTINCT lower(p_type) FROM part UNION SELECT DISTINCT lower(c_mktsegment) FROM customer),
k AS (SELECT DISTINCT name, unnest(list_concat([concat('n:', name), concat('p:', left(name, 3))], list_transform(list_filter(string_split(name, ' '), lambda w: length(w) > 3), lambda w: concat('w:', w)))) AS key FROM n)
SELECT DISTINCT a.name AS a, b.name AS b FROM k a JOIN k b ON a.key = b.key AND a.name < b.name""")
def blocking_pairs(t):
    """Names with the same form, the same first three letters, or a word of more than three letters in common."""
    names = t.part.select(F.lower("p_name").alias("name")).union(t.part.select(F.lower("p_type"))).union(t.customer.select(F.lower("c_mktsegment"))).distinct()
    return joins.blocked_pairs(names, "name", joins.name_keys(F.col("name")))


@R.query("""WITH n AS (SELECT DISTINCT p_brand, p_name FROM part), p AS (SELECT DISTINCT a.p_name AS a, b.p_name AS b FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_name < b.p_name) SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS score FROM p""")
def jaro_winkler_pairs(t):
    """Distinct names of one brand, each pair scored once."""
    return _names_of_one_brand(t).select("a", "b", F.round(similarity.jaro_winkler(F.col("a"), F.col("b")), 6).alias("score"))


def _names_of_one_brand(t):
    n = t.part.select("p_brand", "p_name").distinct()
    return n.select("p_brand", F.col("p_name").alias("a")).join(n.select("p_brand", F.col("p_name").alias("b")), "p_brand").where("a < b").select("a", "b").distinct()


@R.query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS n, count(*) OVER (PARTITION BY key) AS occurrences FROM (SELECT *, user_id AS key FROM events)) SELECT key, event_id, event_type, occurrences FROM t WHERE n = 1""")
def last_of_key(t):
    """T15"""
    rows = t.events.withColumnRenamed("user_id", "key")
    return merge.last_of_key(rows, ["key"], F.struct("ts", "event_id")).select("key", "event_id", "event_type", "occurrences")


VECTORS = "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {score} AS score FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS n FROM s) SELECT query_id, id, {shown} FROM r WHERE n <= 10"


@R.query(VECTORS.format(score="round(list_cosine_similarity(q.v, c.v), 9)", shown="round(score, 6) AS score"))
def vector_topk_cosine(t):
    """The stated queries (ids divisible by 50) against all other rows."""
    return vectors.top_k(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", 10).select("query_id", "id", F.round("score", 6).alias("score"))


@R.query(VECTORS.format(score="-round(list_distance(q.v, c.v), 6)", shown="-score AS distance"))
def vector_topk_l2(t):
    """O5"""
    return vectors.top_k(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", 10, "l2").select("query_id", "id", (-F.col("score")).alias("distance"))


@R.query("""SELECT l_orderkey, len(list_filter(list(l_returnflag), lambda x: x = 'R')) > 0 AS has_returned FROM lineitem GROUP BY l_orderkey""")
def array_membership(t):
    """P10"""
    return t.lineitem.groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "R").alias("has_returned"))


@R.query("SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE (CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END) IS DISTINCT FROM (CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE '1-URGENT' END)")
def null_safe_inequality(t):
    """P9"""
    a, b = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")), F.when(F.col("o_orderkey") % 2 != 0, F.lit("1-URGENT"))
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi").where(~a.eqNullSafe(b)).select("o_orderkey")


@R.query(f"""WITH {SPELLINGS} SELECT text, k.name AS standard_name, CASE WHEN k.name IS NOT NULL THEN 'exact' END AS matched_by FROM w LEFT JOIN k ON k.name = w.text""")
def lookup_exact(t):
    """J24, its first step alone"""
    known, texts = _spellings(t)
    out = texts.join(known, F.col("text") == F.col("name"), "left")
    return out.select("text", F.col("name").alias("standard_name"), F.when(F.col("name").isNotNull(), "exact").alias("matched_by"))


@R.query(f"""WITH {SPELLINGS}, x AS (SELECT text, name, {TRGM.format(c='text')} AS a, {TRGM.format(c='name')} AS b FROM w, k),
i AS (SELECT text, arg_max(name, struct_pack(n := length(name), s := name)) AS name FROM x WHERE contains(text, name) AND length(name) > 2 GROUP BY text),
s AS (SELECT text, name, round({SIMILARITY.format(a='a', b='b')}, 9) AS score FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY score DESC, name) AS n FROM s WHERE score >= 0.5)
SELECT w.text, coalesce(e.name, i.name, r.name) AS standard_name, CASE WHEN e.name IS NOT NULL THEN 'exact' WHEN i.name IS NOT NULL THEN 'contains' WHEN r.name IS NOT NULL THEN 'similar' END AS matched_by
FROM w LEFT JOIN k e ON e.name = w.text LEFT JOIN i ON i.text = w.text LEFT JOIN r ON r.text = w.text AND r.n = 1""")
def lookup_ladder(t):
    """Exact, contained, similar."""
    known, texts = _spellings(t)
    score = lambda a, b: F.round(similarity.trigram_similarity(a, b), 9)
    return joins.lookup_ladder(texts, "text", known.withColumn("std", F.col("name")), "name", "std", score, 0.5)


@R.query(f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN concat('Post ', c_mktsegment) WHEN c_custkey % 10 = 1 THEN concat('NATION_', c_nationkey, '.') ELSE 'NATION_1' END AS station FROM customer),
d AS (SELECT DISTINCT station FROM c), x AS (SELECT station, n_name, n_nationkey, {TRGM.format(c='station')} AS a, {TRGM.format(c='n_name')} AS b FROM d, nation),
m AS (SELECT station, arg_max(n_nationkey, struct_pack(s := round({SIMILARITY.format(a='a', b='b')}, 9), n := -rank)) AS code FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY n_name) AS rank FROM x) WHERE round({SIMILARITY.format(a='a', b='b')}, 9) >= 0.8 GROUP BY station),
n AS (SELECT station, 8999 + row_number() OVER (ORDER BY station) AS code FROM d WHERE station NOT IN (SELECT station FROM m))
SELECT c_custkey, c.station, CAST(coalesce(m.code, n.code) AS BIGINT) AS code, m.code IS NULL AS is_new FROM c LEFT JOIN m ON m.station = c.station LEFT JOIN n ON n.station = c.station""")
def found_or_new_code(t):
    """J23"""
    known = t.nation.select(F.col("n_name").alias("known"), F.col("n_nationkey").alias("code_"))
    k = F.col("c_custkey") % 10
    rows = t.customer.select("c_custkey", F.when(k == 0, F.concat(F.lit("Post "), F.col("c_mktsegment"))).when(k == 1, F.concat(F.lit("NATION_"), "c_nationkey", F.lit("."))).otherwise(F.lit("NATION_1")).alias("station"))
    score = lambda a, b: F.round(similarity.trigram_similarity(a, b), 9)
    return joins.found_or_new(rows, "station", known, "known", "code_", score, 0.8, 9000).select("c_custkey", "station", F.col("code").cast("long").alias("code"), "is_new")


def _soundex_sql(w: str) -> str:
    """Soundex of a word of letters: H and W vanish, equal neighbours count once, vowels part them."""
    coded = f"concat(left(upper({w}), 1), translate(substr(upper({w}), 2), 'HW', ''))"
    digits = f"translate({coded}, 'AEIOUYHWBFPVCGJKQSXZDTLMNR', '00000077111122222222334556')"
    for d in "01234567":
        digits = f"regexp_replace({digits}, '{d}+', '{d}', 'g')"
    return f"left(concat(left(upper({w}), 1), replace(substr({digits}, 2), '0', ''), '000'), 4)"


SOUND_NAMES = "n AS (SELECT DISTINCT lower(p_name) AS name FROM part), v AS (SELECT name FROM n UNION SELECT left(name, length(name) - 1) FROM n UNION SELECT translate(name, 'aeiou', 'eioua') FROM n)"


@R.query(f"""WITH {SOUND_NAMES}, k AS (SELECT name, array_to_string(list_transform(list_distinct(list_filter(string_split(name, ' '), lambda w: w <> '')), lambda w: {_soundex_sql('w')}), '-') AS key FROM v)
SELECT a.name AS a, b.name AS b FROM k a JOIN k b ON a.key = b.key AND a.name < b.name""")
def soundex_block(t):
    """X1, and the sound key of J19: names that sound alike, here each name, without its last letter and with other vowels."""
    n = t.part.select(F.lower("p_name").alias("name")).distinct()
    v = n.union(n.select(F.expr("left(name, length(name) - 1)"))).union(n.select(F.translate("name", "aeiou", "eioua"))).distinct()
    key = F.transform(similarity.words(F.col("name")), similarity.soundex_or_zero)
    return joins.blocked_pairs(v, "name", F.array(F.array_join(key, "-")))


#: Known codes: Double Metaphone of the words that part names begin and end with (where a code starts, a vowel or W counts).
_FIRST_WORDS = {"blue": "PL", "cold": "KLT", "hot": "HT", "large": "LRJ", "new": "N", "old": "ALT", "red": "RT", "small": "SML"}
_LAST_WORDS = {"anvil": "NFL", "bolt": "PLT", "gear": "JR", "gizmo": "JSM", "plate": "PLT", "ring": "RNK", "rod": "RT", "widget": "JT"}
_METAPHONE_SQL = "left(concat({}, {}), 4)".format(*(f"map_extract_value(MAP {{{', '.join(f'{chr(39)}{w}{chr(39)}: {chr(39)}{c}{chr(39)}' for w, c in words.items())}}}, string_split(name, ' ')[{i}])" for i, words in ((1, _FIRST_WORDS), (2, _LAST_WORDS))))
PHONETIC_SQL = f"""WITH f AS (SELECT l_partkey AS id, min(l_orderkey) AS kase FROM lineitem GROUP BY 1),
n AS (SELECT p_partkey AS id, p_name AS name, kase, CAST(o_orderdate AS DATE) AS day, {_METAPHONE_SQL} AS code, {_soundex_sql("replace(p_name, ' ', 'e')")} AS sound FROM part JOIN f ON f.id = p_partkey JOIN orders ON o_orderkey = kase),
p AS (SELECT a.id, b.id AS candidate, CASE WHEN a.sound = b.sound THEN 0 ELSE 1 END AS rank, b.day FROM n a JOIN n b ON (a.sound = b.sound OR a.code = b.code) AND a.kase <> b.kase AND b.day <= a.day AND b.day >= a.day - INTERVAL 2 YEAR)
"""


def _records(t):
    """A record per part: its name, its first case and that case's day."""
    first = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.min("l_orderkey").alias("case"))
    named = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")).join(first, "id")
    return named.join(t.orders.select(F.col("o_orderkey").alias("case"), F.col("o_orderdate").alias("day")), "case")


@R.query(PHONETIC_SQL + "SELECT id, candidate, rank FROM p")
def phonetic_candidates(t):
    """Records of other cases within two years whose names sound alike, by sound key or Double Metaphone; all pairs."""
    r = checkpointed(_records(t))  # both sides, and counts of both
    return joins.phonetic_candidates(r, r, "id", "name", "case", "day")


@R.query(PHONETIC_SQL + "SELECT id, candidate, rank FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank, day DESC, candidate) <= 20")
def ranked_phonetic_candidates(t):
    """The first of each record: same sound key, then same code, the latest first."""
    r = _records(t)
    return joins.phonetic_candidates(r, r, "id", "name", "case", "day", most=20)


@R.query("SELECT DISTINCT lower(trim(r_name)) AS r_name, lower(trim(n_name)) AS n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def hierarchy_names(t):
    """Distinct trimmed names of nested levels."""
    from ..sources.readers import hierarchy

    return hierarchy(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), ["r_name", "n_name"])
