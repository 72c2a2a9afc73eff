"""Enrichment of customers, lines and events against small reference tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import nested, similarity
from ..functions import text as T
from ..operators import branches, enrich, rules, vectors
from .base import Registry
from .relations import UUID5

R = Registry()


@R.query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE lower(r_name) END AS region, CASE c_custkey % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.6::DOUBLE END AS region_confidence,
 CASE WHEN c_custkey % 3 <> 2 AND c_custkey % 5 <> 0 THEN lower(n_name) END AS station FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def address_cascade(t):
    """First the region (exact or similar), then the station within it."""
    known = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name"), F.lower("r_name").alias("region"), "n_name")
    k = F.col("c_custkey")
    raw = t.customer.join(F.broadcast(known.join(t.nation.select("n_name", "n_nationkey"), "n_name").drop("region")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = raw.select("c_custkey", F.when(k % 3 == 0, F.upper("r_name")).when(k % 3 == 1, F.concat("r_name", F.lit(" x"))).otherwise("zzzz").alias("raw_region"), F.when(k % 5 == 0, "qqqq").otherwise(F.col("n_name")).alias("raw_station"))
    first = enrich.resolve_level(rows, "raw_region", known, "r_name", "region", least=0.5)
    return enrich.resolve_level(first, "raw_station", known, "n_name", "station", parent="region", least=0.95).select("c_custkey", "region", "region_confidence", "station")


@R.query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'b' ELSE c_mktsegment END AS perm, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE 'b' END AS pres FROM customer")
def mirrored_slots(t):
    """D7"""
    k = F.col("c_custkey")
    rows = t.customer.select("c_custkey", F.when(k % 3 != 0, F.col("c_mktsegment")).alias("perm"), F.when(k % 3 == 1, F.lit(" ")).otherwise("b").alias("pres"))
    return rows.withColumns(enrich.mirror(["perm"], ["pres"]))


ENDINGS = ("Ramesh", "Lakshmi Devi", "Venkat Reddy", "Sunitha", "Zyx", "Anil Kumar", "Kavya s/o Ravi")


@R.query(f"""WITH p AS (SELECT c_custkey, c_custkey % 4 AS k, lower(split_part([{', '.join(f"'{e}'" for e in ENDINGS)}][1 + c_custkey % {len(ENDINGS)}], ' s/o', 1)) AS who FROM customer),
e AS (SELECT *, CASE WHEN regexp_matches(who, '({'|'.join(enrich.NEUTRAL_ENDS)})$') THEN NULL WHEN regexp_matches(who, '({'|'.join(enrich.MALE_ENDS)})$') THEN 'Male' WHEN regexp_matches(who, '({'|'.join(enrich.FEMALE_ENDS)})$') THEN 'Female' END AS by_end FROM p)
SELECT c_custkey, CASE k WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE by_end END AS value, CASE k WHEN 0 THEN 'given' WHEN 1 THEN 'title' WHEN 2 THEN 'rule' ELSE CASE WHEN by_end IS NOT NULL THEN 'suffix' END END AS source,
 CASE k WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.95::DOUBLE WHEN 2 THEN 0.9::DOUBLE ELSE CASE WHEN by_end IS NOT NULL THEN 0.65::DOUBLE END END AS confidence FROM e""")
def gender_sources(t):
    """D9 D24"""
    k = F.col("c_custkey") % 4
    ending = F.element_at(F.array(*map(F.lit, ENDINGS)), (F.col("c_custkey") % len(ENDINGS) + 1).cast("int"))
    who = F.regexp_replace(ending, " s/o.*", "")
    g = enrich.gender(F.when(k == 0, " F "), F.when(k == 1, F.concat(F.lit("Mr. "), "c_name")).when(k == 2, F.col("c_name")).otherwise(who), F.when(k == 2, F.lit("Female")))
    return t.customer.select("c_custkey", g.alias("g")).select("c_custkey", "g.value", "g.source", "g.confidence")


@R.query("""WITH x AS (SELECT label, i, avg(v) AS m FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i), k AS (SELECT label AS name, list(m ORDER BY i) AS v FROM x GROUP BY label),
s AS (SELECT e.vec_id, k.name, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), k.v), 9) AS s FROM embeddings e, k),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, name DESC) AS n, lead(s) OVER (PARTITION BY vec_id ORDER BY s DESC, name DESC) AS second FROM s)
SELECT vec_id, CASE WHEN s >= 0.2 AND s - second >= 0.01 THEN name END AS match, round(s, 6) AS score FROM r WHERE n = 1""")
def nearest_reference(t):
    """Every row against the mean vector of each label; an ambiguous match stays open."""
    known = vectors.centroids(t.embeddings, "embedding", "label")
    return enrich.nearest_with_margin(t.embeddings, "embedding", known, "v", "label", "vec_id", 0.2, 0.01).select("vec_id", "match", "score")


@R.query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'x' END AS relation, CASE WHEN c_custkey % 3 = 0 THEN 'place' END AS place, concat_ws(',', CASE WHEN c_custkey % 3 = 0 THEN 'place=extracted' END, concat('relation=', CASE WHEN c_custkey % 2 = 0 THEN 'stored' ELSE 'extracted' END)) AS came FROM customer""")
def provenance(t):
    """What is stored decides, extracted values fill gaps; where each field came from."""
    k = F.col("c_custkey")
    stored = t.customer.select("c_custkey", F.when(k % 2 == 0, F.col("c_mktsegment")).alias("relation"), F.lit(" ").alias("place"))
    extracted = t.customer.select("c_custkey", F.lit("x").alias("relation"), F.when(k % 3 == 0, "place").alias("place"))
    out = enrich.with_provenance(stored, extracted, ["c_custkey"], ["relation", "place"])
    return out.select("c_custkey", "relation", "place", F.array_join(F.transform(F.array_sort(F.map_entries("provenance")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("came"))


#: What a case's text says line by line: {n} the line, {m} the next one, {name} the name of its part, {first} its first word. Templates by supplier.
FACTS = ("{name} (A-{n}) was seen", "then {name}, who is said to have come from far away with a bag, met A{m}", "a.{n} fled", "{first} went with A {n}", "nobody knows {name}")


def _facts_sql():
    values = {"{n}": "l_linenumber", "{m}": "l_linenumber + 1", "{name}": "p_name", "{first}": "split_part(p_name, ' ', 1)"}
    part = lambda x: "concat(" + ", ".join(values.get(y, f"'{y}'") for y in re.split(r"(\{\w+\})", x) if y) + ")"
    return f"CASE l_suppkey % {len(FACTS)} {' '.join(f'WHEN {i} THEN {part(x)}' for i, x in enumerate(FACTS))} END"


def _facts():
    values = {"{n}": F.col("l_linenumber"), "{m}": F.col("l_linenumber") + 1, "{name}": F.col("p_name"), "{first}": F.split_part("p_name", F.lit(" "), F.lit(1))}
    texts = [F.concat(*(values[y].cast("string") if y in values else F.lit(y) for y in re.split(r"(\{\w+\})", x) if y)) for x in FACTS]
    return F.element_at(F.array(*texts), (F.col("l_suppkey") % len(FACTS) + 1).cast("int"))


@R.query(f"""WITH l AS (SELECT lineitem.*, p_name, {_facts_sql()} AS s FROM lineitem JOIN part ON p_partkey = l_partkey),
c AS (SELECT o_orderkey AS k, o_orderkey % 11 = 3 AS failed, coalesce(string_agg(s, '; ' ORDER BY l_linenumber, l_partkey, s), '') AS facts FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY o_orderkey),
x AS (SELECT DISTINCT l_orderkey AS k, p_name AS name, l_linenumber AS seq FROM l WHERE l_quantity > 20 AND l_orderkey % 11 <> 5),
t AS (SELECT DISTINCT l_orderkey AS k, concat(l_linenumber, ':', l_partkey) AS id, concat('A-', l_linenumber) AS code, concat('A', l_linenumber) AS plain, CASE WHEN l_linenumber % 2 = 0 THEN p_name END AS name, CASE WHEN l_suppkey % 7 = 0 THEN l_suppkey END AS person FROM l WHERE l_returnflag <> 'R' AND l_orderkey % 4 <> 0),
b AS (SELECT c.*, CASE WHEN t.k IS NULL THEN 'C' WHEN t.known THEN 'A' ELSE 'B' END AS branch FROM c LEFT JOIN (SELECT k, bool_or(person IS NOT NULL) AS known FROM t GROUP BY k) t ON t.k = c.k),
o AS (SELECT * FROM b WHERE branch <> 'A'),
m AS (SELECT o.k, branch, facts, name, seq, CASE WHEN contains(lower(facts), lower(name)) THEN lower(name) WHEN contains(lower(facts), split_part(lower(name), ' ', 1)) THEN split_part(lower(name), ' ', 1) END AS held FROM o JOIN x ON x.k = o.k WHERE NOT failed),
w AS (SELECT *, instr(lower(facts), held) AS i FROM m),
g AS (SELECT *, regexp_extract_all(substr(facts, greatest(i - 30, 1), i + length(held) + 30 - greatest(i - 30, 1)), '(?i)A[-. ]?[0-9]+') AS codes FROM w),
h AS (SELECT g.*, CASE WHEN held IS NOT NULL THEN list_filter(list_transform(codes, lambda z: upper(regexp_replace(z, '[-. ]', '', 'g'))), lambda z: list_contains(plains, z)) END AS own FROM g LEFT JOIN (SELECT k, list(plain) AS plains FROM t GROUP BY k) y ON y.k = g.k),
p AS (SELECT h.k, branch, name, seq, q.id, q.code, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(concat(h.k, '|', name, '|', seq))) AS sha FROM h LEFT JOIN (SELECT k, plain, min(id) AS id, arg_min(code, id) AS code FROM t GROUP BY k, plain) q ON q.k = h.k AND q.plain = h.own[1])
SELECT k AS case_id, branch, coalesce(id, {UUID5.format(h='sha')}) AS accused_id, code AS person_code, name AS full_name, CAST(NULL AS VARCHAR) AS role, CASE WHEN id IS NOT NULL THEN 'paired' WHEN branch = 'B' THEN 'unmatched' ELSE 'text' END AS source FROM p
UNION ALL SELECT t.k, 'B', t.id, t.code, coalesce(t.name, t.code), NULL, 'stub' FROM t JOIN o ON o.k = t.k AND branch = 'B' AND NOT failed WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = t.k AND p.id = t.id)
UNION ALL SELECT k, branch, NULL, NULL, NULL, CASE WHEN failed THEN '{branches.FAILED}' ELSE '{branches.NOBODY}' END, NULL FROM o WHERE (failed OR branch = 'C') AND k NOT IN (SELECT k FROM p)""")
def assembled_people(t):
    """D22, branches B and C: people of a text beside stubs of the table (paired by a code near the name), or without any."""
    l = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    told = l.withColumn("s", _facts()).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(nested.ordered_list(F.col("s"), F.col("l_linenumber"), F.col("l_partkey")).alias("s"))
    cases = t.orders.join(told, "o_orderkey", "left").select(F.col("o_orderkey").alias("case_id"), F.when(F.col("o_orderkey") % 11 == 3, "failed").alias("state"), F.coalesce(F.array_join("s", "; "), F.lit("")).alias("facts"))
    extracted = l.where("l_quantity > 20 AND l_orderkey % 11 <> 5").select(F.col("l_orderkey").alias("case_id"), F.col("p_name").alias("name"), F.col("l_linenumber").alias("seq")).distinct()
    stubs = l.where("l_returnflag <> 'R' AND l_orderkey % 4 <> 0").select(
        F.col("l_orderkey").alias("case_id"), F.concat_ws(":", "l_linenumber", "l_partkey").alias("id"), F.concat(F.lit("A-"), "l_linenumber").alias("code"), F.when(F.col("l_linenumber") % 2 == 0, F.col("p_name")).alias("stub_name"), F.when(F.col("l_suppkey") % 7 == 0, F.col("l_suppkey")).alias("person")
    ).distinct()
    return branches.assembled(cases, extracted, stubs, "case_id", "name", "seq", "facts", "state", "id", "code", "stub_name", "person")


@R.query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity <= 25 AND l_linenumber % 2 = 0 AS sample FROM lineitem")
def sample_rows(t):
    """F33"""
    s = F.when(F.col("l_linenumber") % 2 == 0, "two samples were drawn").otherwise("seized")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", enrich.is_sample(F.col("l_quantity"), s, 25.0).alias("sample"))


@R.query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT (l_linenumber % 3 = 1 AND EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = l.l_orderkey AND x.l_linenumber % 3 = 2))")
def net_weights(t):
    """F32"""
    n = F.col("l_linenumber") % 3
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(n == 1, "gross weight").when(n == 2, "net weight").otherwise("weight").alias("s"))
    return enrich.net_or_gross(rows, ["l_orderkey"], "s").drop("s")


WEIGHT_TEXTS = ("The total gross weight of the material was {q}.5 kg and the net weight was {q} kg. It was sealed", "gross weight was {q} kg", "a gross weight of {q} kg was noted. the net weight is not known", "Gross wt {q} g, actual weight {m} g\nseized {q} g")


def _weight_text():
    part = lambda x: {"{q}": F.col("l_quantity").cast("int").cast("string"), "{m}": (F.col("l_quantity").cast("int") - 1).cast("string")}.get(x, F.lit(x))
    return F.element_at(F.array(*(F.concat(*(part(y) for y in re.split(r"(\{\w\})", x) if y)) for x in WEIGHT_TEXTS)), (F.col("l_suppkey") % 4 + 1).cast("int"))


@R.query("""WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS q, CAST(l_suppkey % 4 AS INTEGER) AS k FROM lineitem),
r AS (SELECT w.*, f.gross, CASE k WHEN 0 THEN CASE WHEN f.gross THEN (q + 0.5) * 1000 ELSE q * 1000 END WHEN 3 THEN CASE WHEN f.gross THEN q ELSE q - 1 END ELSE q * 1000 END AS g FROM w, (VALUES (true), (false)) f(gross))
SELECT l_orderkey, l_linenumber, l_partkey, CAST(g AS DOUBLE) AS weight_g FROM r WHERE NOT (gross AND k IN (0, 3))""")
def gross_beside_net(t):
    """F32: of two weights in one sentence the gross one goes; a gross weight without its net one stays."""
    lines = t.lineitem.withColumn("facts", _weight_text()).withColumn("q", F.col("l_quantity").cast("int").cast("double"))
    gross = F.when(F.col("k") == 0, (F.col("q") + 0.5) * 1000).when(F.col("k") == 3, F.col("q")).otherwise(F.col("q") * 1000)
    net = F.when(F.col("k") == 3, F.col("q") - 1).otherwise(F.col("q") * 1000)
    # a line's text is read once, for both of its weights
    read = lines.withColumn("k", F.col("l_suppkey") % 4).withColumn("sentence", F.try_element_at(rules.sentences(F.col("facts")), F.lit(1))).withColumn("stated", enrich.gross_beside_net(F.col("facts")))
    weights = read.withColumn("weight_g", F.explode(F.array(gross, net)))
    return weights.where(~enrich.is_gross_beside_net(F.col("facts"), F.col("sentence"), F.col("weight_g"), F.col("stated"))).select("l_orderkey", "l_linenumber", "l_partkey", "weight_g")


@R.query("SELECT c_custkey, 'Father' AS relation, 'old man' AS relative, CASE WHEN c_custkey % 2 = 0 THEN 'some place' END AS place FROM customer")
def identity_from_text(t):
    """D26 F17"""
    text = F.concat(F.lit("There "), "c_name", F.lit(" s/o old man"), F.when(F.col("c_custkey") % 2 == 0, " r/o some place, was met").otherwise(", was met"))
    return t.customer.select("c_custkey", enrich.identity_in_text(text, F.col("c_name")).alias("i")).select("c_custkey", "i.relation", "i.relative", "i.place")


@R.query("""SELECT 'arrests' AS target, count(*) AS n FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT 'disposals', count(*) FROM events WHERE value > 50""")
def routed_rows(t):
    """A row may go to several targets."""
    parts = rules.route(t.events, "event_type", {"arrests": F.col("event_type").isin("click", "view"), "disposals": F.col("value") > 50})
    one = lambda name: parts[name].agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("n"))
    return one("arrests").unionByName(one("disposals"))


@R.query("""WITH m AS (SELECT p_type AS raw, min(p_brand) AS category FROM part GROUP BY 1) SELECT l_orderkey, l_linenumber, l_partkey, category FROM lineitem JOIN part ON p_partkey = l_partkey JOIN m ON raw = p_type""")
def category_map(t):
    """A map of names joined as a small table."""
    m = t.part.groupBy("p_type").agg(F.min("p_brand").alias("category"))
    return t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).join(m, "p_type").select("l_orderkey", "l_linenumber", "l_partkey", "category")


@R.query("SELECT c_custkey, round(CASE WHEN c_custkey % 2 = 0 THEN 1.0 ELSE 0.5 END, 6) AS score FROM customer")
def address_likeness(t):
    """Stop words and numbers do not count."""
    a = F.lit("House 12, Alpha street, Beta colony")
    b = F.when(F.col("c_custkey") % 2 == 0, "beta, alpha road 99").otherwise("alpha village near")
    return t.customer.select("c_custkey", F.round(similarity.jaccard(T.address_tokens(a), T.address_tokens(b)), 6).alias("score"))
