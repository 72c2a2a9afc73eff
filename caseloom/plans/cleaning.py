"""Cleaning, scalar rules and classification, on values derived from the tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import dates, nested, similarity, units
from ..functions import text as T
from ..operators import aggregates, rules
from ..operators import attribution as attributions
from .base import Registry

R = Registry()

NAME = "concat('Mr. ', c_name, ' s/o Father', c_nationkey, ' @ al', c_custkey % 7)"


def name(t):
    return t.customer.withColumn("raw", F.concat(F.lit("Mr. "), "c_name", F.lit(" s/o Father"), "c_nationkey", F.lit(" @ al"), F.col("c_custkey") % 7))


@R.query(f"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(split_part(lower({NAME}), '@', 1), '\\bs/o\\b', ' ', 'g'), '\\bmr\\b\\.?', ' ', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS n FROM customer""")
def normal_names(t):
    """F1"""
    return name(t).select("c_custkey", T.normal_name(F.col("raw")).alias("n"))


@R.query("""SELECT c_custkey, c_name AS cleaned FROM customer""")
def clean_full_names(t):
    """remarks around a name are taken off again."""
    remarks = (
        " s/o X, age: 30 yrs, cell: 9876501234 (Absconding) @ zed", ", 25 yrs, Caste: abc, r/o some place, town", " \u2706 9876501234, H.No. 1-23", " (Adhaar No. 1234 5678 9012)", " driver of a lorry, n/o there",
        " (main receiver), d/o Y", " (UT prisoner no. 55), Ph.No: 12345", " owner of bolero vehicle", " CRPF 12th battalion", " and others",
    )
    noisy = F.concat(F.lit("A-"), F.col("c_custkey") % 9 + 1, F.lit(") "), "c_name", F.element_at(F.array(*map(F.lit, remarks)), (F.col("c_custkey") % len(remarks) + 1).cast("int")))
    return t.customer.select("c_custkey", T.clean_full_name(noisy).alias("cleaned"))


@R.query("SELECT c_custkey, concat_ws(' ', c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN concat('@ ', c_custkey) END) AS full_name FROM customer")
def full_names(t):
    """F4"""
    return t.customer.select("c_custkey", T.full_name(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(" "), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string"))).alias("full_name"))


@R.query("SELECT c_custkey, concat('al', c_custkey % 7) AS alias, 'Father' AS relation, concat('Father', c_nationkey) AS relative FROM customer")
def alias_and_relation(t):
    """F5 F6"""
    n = name(t).withColumn("r", T.relation_of(F.col("raw")))
    return n.select("c_custkey", T.alias_of(F.col("raw")).alias("alias"), "r.relation", "r.relative")


@R.query("SELECT c_custkey, array_to_string(list_sort(string_split(trim(regexp_replace(regexp_replace(lower(concat(c_mktsegment, ' ', c_name)), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' ')), ' ') AS key FROM customer")
def order_free_keys(t):
    """F7"""
    return t.customer.select("c_custkey", T.name_key(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("key"))


@R.query("SELECT l_orderkey, l_linenumber, concat('A-', l_linenumber) AS code FROM lineitem")
def person_codes(t):
    """F8 P8"""
    raw = F.concat(F.element_at(F.array(F.lit("A"), F.lit("a-"), F.lit("A."), F.lit("A - 0")), (F.col("l_linenumber") % 4 + 1).cast("int")), F.col("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", T.person_code(raw).alias("code"))


@R.query("SELECT c_custkey, right(concat('91', 9000000000 + c_custkey), 10) AS digits, concat(9000000000 + c_custkey, ', ', 8000000000 + c_custkey) AS phones FROM customer")
def phones(t):
    """F9"""
    a, b = (F.lit(9000000000) + F.col("c_custkey")).cast("string"), (F.lit(8000000000) + F.col("c_custkey")).cast("string")
    return t.customer.select("c_custkey", T.phone_digits(F.concat(F.lit("+91-"), a)).alias("digits"), T.phone_list(F.concat_ws(" / ", a, b, a)).alias("phones"))


@R.query("SELECT c_custkey, concat_ws(', ', c_name, n_name, nullif(trim(CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE c_mktsegment END), '')) AS address, left(c_name, 6) AS short FROM customer JOIN nation ON n_nationkey = c_nationkey")
def addresses(t):
    """F11 F21 P5"""
    j = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", T.address(F.col("c_name"), F.col("n_name"), F.when(F.col("c_custkey") % 2 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment"))).alias("address"), F.left("c_name", F.lit(6)).alias("short"))


@R.query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'filled' END AS v FROM customer")
def fill_if_blank(t):
    """F19 P5"""
    current = F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).otherwise(F.lit("filled"))
    return t.customer.select("c_custkey", T.first_filled(current, F.col("c_mktsegment")).alias("v"))


@R.query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'tar' ELSE NULL END AS ext, CASE WHEN event_type = 'click' THEN concat('crimes/', user_id, '/', event_id) WHEN event_type = 'view' THEN concat('persons/', user_id, '/', event_id) END AS path FROM events")
def file_paths(t):
    """F20 D25"""
    url = F.concat(F.lit("http://h/x/"), "event_id", F.element_at(F.array(F.lit(".pdf?a=1"), F.lit(".TAR"), F.lit("")), (F.col("event_id") % 3 + 1).cast("int")))
    return t.events.select("event_id", T.extension(url).alias("ext"), T.file_path(F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string"), {"click": "crimes", "view": "persons"}).alias("path"))


@R.query("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders WHERE o_orderkey % 4 <> 3 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 3")
def tolerant_dates(t):
    """four spellings of a date, one of them none."""
    d = F.col("o_orderdate")
    raw = F.element_at(F.array(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(d, "yyyy-MM-dd HH:mm:ss"), F.date_format(d, "dd/MM/yyyy"), F.lit("soon")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", dates.parse_tolerant(raw).alias("parsed"))


@R.query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS on_date, true AS is_arrested FROM orders")
def status_flags(t):
    """F29 D10"""
    text = F.concat(F.lit("Arrested on "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" by ps"))
    s = rules.status_flags(text)
    return t.orders.select("o_orderkey", s["on_date"].alias("on_date"), s["is_arrested"].alias("is_arrested"))


UNIT = "CASE CAST(l_quantity AS BIGINT) % 6 WHEN 0 THEN 'Kgs' WHEN 1 THEN 'gms.' WHEN 2 THEN 'Ltr' WHEN 3 THEN 'ml' WHEN 4 THEN 'Nos' ELSE 'heap' END"


@R.query(f"""WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS q, {UNIT} AS u FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE u WHEN 'Kgs' THEN q * 1000.0 WHEN 'gms.' THEN q END AS weight_g, CASE u WHEN 'Ltr' THEN q * 1000.0 WHEN 'ml' THEN q END AS volume_ml, CASE WHEN u IN ('Nos', 'heap') THEN q END AS count_total,
  CASE u WHEN 'Kgs' THEN concat(printf('%.2f', q), ' Kg') WHEN 'gms.' THEN concat(printf('%.2f', q), ' g') WHEN 'Ltr' THEN concat(printf('%.2f', q), ' L') WHEN 'ml' THEN concat(printf('%.2f', q), ' ml') ELSE concat(printf('%.0f', q), ' Units') END AS label FROM u""")
def unit_standardise(t):
    """F30 F31"""
    unit = F.element_at(F.array(*map(F.lit, ("Kgs", "gms.", "Ltr", "ml", "Nos", "heap"))), (F.col("l_quantity").cast("long") % 6 + 1).cast("int"))
    s = t.lineitem.withColumn("s", units.standard_quantity(F.col("l_quantity"), unit, F.lit("unknown"), F.lit(0.0), F.lit("")))
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "s.weight_g", "s.volume_ml", "s.count_total", units.quantity_label(F.col("s.weight_g"), F.col("s.volume_ml"), F.col("s.count_total")).alias("label"))


@R.query("SELECT p_partkey, CAST(p_partkey AS DOUBLE) * 1000 * CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 100000 ELSE 10000000 END AS worth, round(p_size / 30.48, 2) AS feet FROM part")
def money_and_length(t):
    """F34 F35"""
    text = F.concat(F.lit("valued at Rs. "), F.format_number(F.col("p_partkey") * 1000, 0), F.element_at(F.array(F.lit(" only"), F.lit(" lakhs"), F.lit(" crore")), (F.col("p_size") % 3 + 1).cast("int")))
    return t.part.select("p_partkey", units.money_in_text(text).alias("worth"), units.cm_to_feet(F.col("p_size")).alias("feet"))


@R.query("SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) * 1000 END AS n, CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b, CASE WHEN p_size * 4 BETWEEN 1 AND 120 THEN p_size * 4 END AS age FROM part")
def safe_coercion(t):
    """F36 F37"""
    n = F.when(F.col("p_size") % 4 == 0, F.lit("n.a.")).otherwise(F.concat("p_size", F.lit(",000")))
    b = F.element_at(F.array(F.lit("Yes"), F.lit("0"), F.lit("?")), (F.col("p_size") % 3 + 1).cast("int"))
    return t.part.select("p_partkey", units.to_number(n).cast("double").alias("n"), units.to_boolean(b).alias("b"), units.valid_age(F.col("p_size") * 4).alias("age"))


@R.query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'object' AS kind, concat('{\"type\":\"', event_type, '\",\"user\":', user_id, '}') AS built FROM events")
def json_access(t):
    """F38 F39 F41"""
    built = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")))
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), nested.json_kind(F.col("props")).alias("kind"), built.alias("built"))


@R.query("SELECT c_custkey, NULL::VARCHAR AS a, c_name AS b, c_mktsegment AS d FROM customer")
def blank_json_fields(t):
    """Fields from JSON, blanks as null, and two structs as one."""
    j = t.customer.select("c_custkey", F.from_json(F.to_json(F.struct(F.lit("  ").alias("A"), F.col("c_name").alias("B"))), "A string, B string").alias("j"), F.struct(F.col("c_mktsegment").alias("d")).alias("k"))
    m = j.withColumn("j", nested.blank_fields_to_null("j", ["A", "B"])).withColumn("m", nested.merge_structs("j", "k", ["A", "B"], ["d"]))
    return m.select("c_custkey", F.col("m.A").alias("a"), F.col("m.B").alias("b"), F.col("m.d").alias("d"))


@R.query("SELECT c_custkey, 2 AS n, concat('f', c_custkey) AS first FROM customer")
def media_lists(t):
    """F43 F45"""
    ids = nested.media_list(F.array(F.concat(F.lit(" f"), "c_custkey"), F.lit(""), F.concat(F.lit("f"), "c_custkey"), F.lit("z"), F.lit(None).cast("string")))
    return t.customer.select("c_custkey", F.size(ids).alias("n"), F.element_at(ids, 1).alias("first"))


@R.query("""SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'Small' WHEN 1 THEN 'Small' WHEN 2 THEN 'Commercial' WHEN 3 THEN 'Cultivation' WHEN 4 THEN 'Small' WHEN 5 THEN 'Intermediate' WHEN 6 THEN 'Commercial' END AS class FROM part""")
def section_class(t):
    """F10 D1 D2"""
    raw = F.element_at(F.array(*map(F.lit, ("8(c) NDPSA", "29", "8(c) r/w 20(b)(ii)(C)", "20(a)(i), 8c", "27(A)", "20(b)(ii)(B), 8(c)", "21-b, 22(c)", "none"))), (F.col("p_size") % 8 + 1).cast("int"))
    return t.part.select("p_partkey", rules.highest_class(rules.section_tokens(raw)).alias("class"))


@R.query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'PT' WHEN 1 THEN 'UI' WHEN 2 THEN 'UI' WHEN 3 THEN 'Chargesheeted' WHEN 4 THEN 'Compounded' ELSE 'Other' END AS state,
 CASE o_orderkey % 6 WHEN 0 THEN 'Absconding' WHEN 1 THEN 'Arrested' WHEN 2 THEN 'Arrested' WHEN 3 THEN 'Absconding' WHEN 4 THEN 'Issued Notice' ELSE 'Unknown' END AS person FROM orders""")
def status_map(t):
    """D3 P4"""
    at = (F.col("o_orderkey") % 6 + 1).cast("int")
    case = F.element_at(F.array(*map(F.lit, ("PT Cases", "New", "Under Trial", "Chargesheet Created", "compounded", "Other"))), at)
    person = F.element_at(F.array(*map(F.lit, ("Arrest Related/41A CrPC Pending", "ARRESTED", "Surrendered in court", "Absconding", "41A Cr.P.C notice", "free"))), at)
    return t.orders.select("o_orderkey", rules.case_state(case).alias("state"), rules.person_status(person).alias("person"))


@R.query("""SELECT c_custkey, CASE WHEN r_name <> 'ASIA' THEN 'international' WHEN n_nationkey % 2 = 0 THEN 'native state' WHEN c_custkey % 5 = 0 THEN 'inter state' END AS domicile FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def domicile_class(t):
    """D4"""
    places = F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    j = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    state = F.when(F.col("n_nationkey") % 2 == 0, "Home ").when(F.col("c_custkey") % 5 == 0, "Other").otherwise("Nowhere")
    return j.select("c_custkey", rules.domicile(state, F.lit(" "), F.lit(None).cast("string"), F.col("r_name"), F.lit("x"), "asia", "home", ["other"]).alias("domicile"))


ROLE_TEXTS = ("Supplied ganja", "was SELLING it near the school", "driver of the crime vehicle", "tested positive", "manufactured at home", "funded the deal", "gave them shelter", "was present", "mastermind of the gang", "caught with a packet", "packed and sold it")
ONE_TEXT = "[{}][1 + (l_linenumber + l_partkey) % {}]"


def one_text(texts):
    return F.element_at(F.array(*map(F.lit, texts)), ((F.col("l_linenumber") + F.col("l_partkey")) % len(texts) + 1).cast("int"))


def one_text_sql(texts):
    return ONE_TEXT.format(", ".join("'" + x.replace("'", "''") + "'" for x in texts), len(texts))


def held_sql(text, words):
    return f"coalesce(len(list_filter([{', '.join(chr(39) + w + chr(39) for w in words)}], lambda w: contains(lower({text}), w))) > 0, false)"


@R.query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {one_text_sql(ROLE_TEXTS)} AS text FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE {' '.join(f"WHEN {held_sql('text', words)} THEN '{name}'" for name, words in rules.ROLES)} ELSE 'unknown' END AS role, l_quantity < 18 AS minor FROM x""")
def role_and_minor(t):
    """D12 D13"""
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", rules.role(one_text(ROLE_TEXTS)).alias("role"), rules.is_minor(F.col("l_quantity").cast("int"), F.lit("")).alias("minor"))


SEIZURE_TEXTS = ("seized 2 kg ganja and consumed", "tested positive for ganja", "they sold to a buyer", "he spoke of ganja", "matchbox and ganja residue, test kit used and item seized. Later", "ganja in a matchbox was seized", "Apprehended with ganja", "")


@R.query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, {one_text_sql(SEIZURE_TEXTS)} AS s, CASE WHEN l_linenumber % 2 = 0 THEN 'contraband was recovered' ELSE 'nothing' END AS whole FROM lineitem),
m AS (SELECT *, {held_sql('s', rules.SEIZED)} AS seized, {held_sql('whole', rules.SEIZED)} AS elsewhere, {held_sql('s', rules.USED)} AS used, {held_sql('s', rules.SOLD)} AS sold, {held_sql('s', rules.EQUIPMENT)} AS tools,
  regexp_matches(lower(s), '({'|'.join(rules.SEIZURE_OF)})[^.\\n]{{0,80}}\\bganja\\b|\\bganja\\b[^.\\n]{{0,80}}({'|'.join(rules.SEIZURE_OF)})') AS joined FROM x),
r AS (SELECT *, CASE WHEN used AND NOT seized THEN 'CONSUMPTION_ONLY' WHEN sold AND NOT seized THEN 'SALE_ONLY' WHEN NOT seized AND NOT elsewhere AND trim(s) <> '' THEN 'NO_SEIZURE' WHEN tools AND NOT joined THEN 'EQUIPMENT' END AS reason FROM m)
SELECT l_orderkey, l_linenumber, l_partkey, reason IS NULL AS keep, reason FROM r""")
def seizure_filter(t):
    """P12"""
    whole = F.when(F.col("l_linenumber") % 2 == 0, "contraband was recovered").otherwise("nothing")
    f = rules.seizure_filter(one_text(SEIZURE_TEXTS), whole, F.lit("ganja"))
    return t.lineitem.withColumn("f", f).select("l_orderkey", "l_linenumber", "l_partkey", "f.keep", "f.reason")


@R.query("""SELECT p_partkey, p_type FROM part WHERE lower(p_type) NOT IN (SELECT lower(p_type) FROM part WHERE p_partkey < 3) AND NOT contains(lower(p_brand), '#3')""")
def without_ignored(t):
    """P13"""
    return rules.without_ignored(t.part.withColumn("both", F.col("p_type")), "both", t.part.where("p_partkey < 3"), "p_type").where(~F.lower("p_brand").contains("#3")).select("p_partkey", "p_type")


@R.query("""SELECT c_custkey, c_custkey % 6 IN (0, 4) AS keep, CASE c_custkey % 6 WHEN 1 THEN 'EMPTY_NAME' WHEN 2 THEN 'UNKNOWN_PERSON_PATTERN' WHEN 3 THEN 'POLICE_OFFICIAL' WHEN 4 THEN 'SUPPLIER_CONTEXT' WHEN 5 THEN 'ASSOCIATE_ONLY' END AS reason FROM customer""")
def creation_gate(t):
    """P14 F17 F18"""
    k = F.col("c_custkey") % 6
    who = F.when(k == 1, F.lit(" ")).when(k == 3, F.lit("constable ram")).otherwise(F.lit("ram"))
    text = F.when(k == 2, F.lit("one unknown was there")).when(k == 4, F.lit("it was purchased from ram")).when(k == 5, F.lit("ram, a friend of A-1")).otherwise(F.lit("ram was there"))
    return t.customer.withColumn("g", rules.creation_gate(who, text, F.lit(False))).select("c_custkey", "g.keep", "g.reason")


@R.query("""SELECT o_orderkey, concat_ws(',', CASE WHEN NOT (o_totalprice > 1000) THEN 'price' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END) AS errors FROM orders WHERE NOT (o_totalprice > 1000) OR o_orderstatus NOT IN ('F', 'O')""")
def validation_errors(t):
    """P15"""
    from ..operators.merge import violations

    v = violations(t.orders, {"price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus").isin("F", "O")})
    return v.select("o_orderkey", F.array_join("errors", ",").alias("errors"))


@R.query(r"""SELECT doc_id, CASE WHEN regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])(?:the|la)(?:$|[^\p{L}\p{N}_])') THEN 100 ELSE 0 END + CASE WHEN regexp_matches(lower(text), 'license') THEN 80 ELSE 0 END + CASE WHEN regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])(?:of)(?:$|[^\p{L}\p{N}_])') THEN 15 ELSE 0 END + CASE WHEN regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])(?:de)(?:$|[^\p{L}\p{N}_])') THEN 15 ELSE 0 END AS score FROM documents""")
def text_relevance(t):
    """P16"""
    return t.documents.select("doc_id", T.relevance(F.col("text"), ("the", "la"), ("license",), ("of", "de")).cast("int").alias("score"))


@R.query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS packets, 2.5 AS each, 'kg' AS unit FROM lineitem""")
def packet_rows(t):
    """D14"""
    text = F.concat(F.lit("Seized "), F.col("l_quantity").cast("int"), F.lit(" packets of ganja weighing 2.5 Kg each"))
    e = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.explode(rules.packets(text)).alias("p"))
    return e.select("l_orderkey", "l_linenumber", "l_partkey", "p.packets", "p.each", "p.unit")


@R.query("""WITH w AS (SELECT unnest(string_split_regex(lower(text), '[^a-zA-Z0-9_]+')) AS keyword FROM documents) SELECT DISTINCT keyword FROM w WHERE length(keyword) > 2""")
def keyword_base(t):
    """The words of all documents."""
    return rules.keyword_base(t.documents, "text")


WORD_SQL = r"regexp_matches(lower(s), '(?:^|[^\p{L}\p{N}_])(?:%s)(?:$|[^\p{L}\p{N}_])')"


@R.query(f"""WITH p AS (SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '\\S')) AS parts FROM documents),
k AS (SELECT doc_id, text, parts, list_filter(parts, lambda s: CASE WHEN {WORD_SQL % 'the|la'} THEN 100 ELSE 0 END + CASE WHEN regexp_matches(lower(s), 'license') THEN 80 ELSE 0 END + {' + '.join(f"CASE WHEN {WORD_SQL % w} THEN 15 ELSE 0 END" for w in ('of', 'de', 'and', 'und'))} >= 50) AS kept FROM p)
SELECT doc_id, CAST(len(parts) AS INTEGER) AS sections, CAST(CASE WHEN len(parts) <= 1 THEN len(parts) ELSE len(kept) END AS INTEGER) AS kept, md5(CASE WHEN len(parts) <= 1 THEN text ELSE array_to_string(list_transform(kept, lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), chr(10) || chr(10)) END) AS kept_md5 FROM k""")
def relevant_sections(t):
    """Of a text's sections (here lines) those of a relevance of 50 or more stay; a text of one section stays as it is."""
    r = T.relevant_sections(F.col("text"), r"\n", ("the", "la"), ("license",), ("of", "de", "and", "und"))
    return t.documents.select("doc_id", r.alias("r")).select("doc_id", "r.sections", "r.kept", F.md5("r.kept_text").alias("kept_md5"))


@R.query(r"""WITH k AS (SELECT DISTINCT unnest(string_split(lower(p_type), ' ')) AS w FROM part UNION SELECT 'the' UNION SELECT 'tion'), d AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '\W+')) AS w FROM documents)
SELECT doc_id, best AS keyword FROM documents LEFT JOIN (SELECT d.doc_id AS id, arg_max(d.w, struct_pack(n := length(d.w), w := d.w)) AS best FROM d JOIN k ON k.w = d.w GROUP BY 1) ON id = doc_id""")
def longest_keyword(t):
    """The longest word of the part types that a document holds."""
    words = t.part.select(F.explode(F.split(F.lower("p_type"), " ")).alias("w")).distinct()
    return rules.longest_keyword(t.documents.select("doc_id", "text"), "text", words.union(t.spark.createDataFrame([("the",), ("tion",)], "w string")), "w").select("doc_id", "keyword")


@R.query("""WITH g AS (SELECT l_orderkey, l_returnflag, max(CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END) AS flagged, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_returnflag, flagged = 1 OR q >= 60 AS is_large FROM lineitem l JOIN g ON g.l_orderkey = l.l_orderkey AND g.l_returnflag = l.l_returnflag""")
def commercial_flag(t):
    """A20"""
    out = aggregates.flag_groups(t.lineitem, ["l_orderkey", "l_returnflag"], F.col("l_quantity") == 50, F.col("l_quantity").cast("decimal(18,2)"), F.lit(60))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "is_large")


@R.query("""WITH g AS (SELECT l_orderkey, sum(l_quantity) AS q, max(l_extendedprice) AS w FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(round(CAST(l.l_quantity / q * w AS DECIMAL(38,10)), 2) AS DOUBLE) AS share FROM lineitem l JOIN g ON g.l_orderkey = l.l_orderkey""")
def worth_allocation(t):
    """A21"""
    return aggregates.allocate(t.lineitem, ["l_orderkey"], "l_quantity", "l_extendedprice", "share").select("l_orderkey", "l_linenumber", "l_partkey", "share")


@R.query("""SELECT l_orderkey, l_returnflag, max(l_discount) AS l_discount, arg_min(l_shipdate, struct_pack(d := -l_discount, n := l_linenumber, p := l_partkey)) AS l_shipdate, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS sources, count(*) AS merged FROM lineitem GROUP BY 1, 2""")
def dedup_consolidate(t):
    """A25"""
    out = aggregates.consolidate(t.lineitem, ["l_orderkey", "l_returnflag"], "l_discount", ["l_shipdate"], "l_linestatus", F.struct("l_linenumber", "l_partkey"))
    return out.select("l_orderkey", "l_returnflag", "l_discount", "l_shipdate", F.array_join("sources", ",").alias("sources"), F.col("merged").cast("long").alias("merged"))


@R.query("""SELECT l_orderkey, l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q, arg_min(l_shipdate, struct_pack(n := l_linenumber, p := l_partkey, d := l_shipdate)) AS l_shipdate FROM lineitem GROUP BY 1, 2""")
def sum_merge(t):
    """A26"""
    rows = t.lineitem.withColumn("q", F.col("l_quantity").cast("decimal(18,2)"))
    return aggregates.sum_merge(rows, ["l_orderkey", "l_returnflag"], "q", ["l_shipdate"], F.struct("l_linenumber", "l_partkey", "l_shipdate")).withColumn("q", F.col("q").cast("double"))


@R.query("""WITH b AS (SELECT l_orderkey, l_linenumber AS n, l_quantity AS q, false AS total FROM lineitem UNION ALL SELECT l_orderkey, 0, sum(l_quantity) + CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 50 END, true FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, n, q, total FROM b WHERE NOT (total AND l_orderkey % 2 = 0)""")
def redundant_totals(t):
    """A27"""
    items = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"), F.lit(False).alias("total"))
    totals = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).select("l_orderkey", F.lit(0).alias("n"), (F.col("q") + F.when(F.col("l_orderkey") % 2 == 0, 0).otherwise(50)).alias("q"), F.lit(True).alias("total"))
    return aggregates.drop_redundant_totals(items.unionByName(totals), ["l_orderkey"], "q", "total", 0.0001)


@R.query("""WITH k AS (SELECT unnest(list_distinct(string_split(lower(p_type), ' '))) AS token, p_brand AS label FROM part), c AS (SELECT token, label, count(*) AS n FROM k GROUP BY 1, 2), s AS (SELECT token, sum(n) AS total FROM c GROUP BY 1)
SELECT c.token, label, n, round(n * 1.0 / total, 6) AS share FROM c JOIN s ON s.token = c.token WHERE n >= 3 AND n * 1.0 / total >= 0.03""")
def token_shares(t):
    """A22"""
    return aggregates.token_shares(t.part, F.lower("p_type"), "p_brand", 3, 0.03).withColumn("share", F.round("share", 6))


@R.query("WITH i AS (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, unnest(regexp_extract_all(text, '{p}')) AS value FROM documents" for k, p in rules.IDENTIFIERS.items()) + ") SELECT kind, count(*) AS n, count(DISTINCT value) AS distinct_values FROM i GROUP BY kind")
def identifiers(t):
    """Q4: identifiers in documents, counted by kind."""
    return t.documents.select(F.explode(rules.identifiers(F.col("text"))).alias("i")).groupBy("i.kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("i.value").alias("distinct_values"))


@R.query("SELECT c_custkey, true AS valid FROM customer")
def valid_names(t):
    """D23 F15"""
    return t.customer.select("c_custkey", T.valid_person_name(T.title_case(F.concat(F.lit("ram "), "c_name"), ("PS",))).alias("valid"))


@R.query("SELECT doc_id, length(strip_accents(text)) AS n, md5(strip_accents(text)) AS md5 FROM documents")
def accent_free(t):
    """F13"""
    return t.documents.select("doc_id", similarity.strip_accents("text").alias("plain")).select("doc_id", F.length("plain").cast("long").alias("n"), F.md5("plain").alias("md5"))


@R.query("SELECT c_custkey, concat(CASE c_custkey % 3 WHEN 0 THEN 'rm' WHEN 1 THEN 'raamu' ELSE 'plain' END, ' ', c_name) AS latin FROM customer")
def latin_names(t):
    """names in Devanagari, Telugu and Latin letters."""
    indic = F.element_at(F.array(F.lit("\u0930\u092e"), F.lit("\u0c30\u0c3e\u0c2e\u0c41"), F.lit("plain")), (F.col("c_custkey") % 3 + 1).cast("int"))
    return t.customer.select("c_custkey", T.latin(F.concat_ws(" ", indic, "c_name")).alias("latin"))


#: What is told about an item: {n} its line, {m} the next one, {q} an amount, {name} the name of its part. Templates by supplier.
ITEM_TEXTS = (
    "seized {q} kg ganja from A-{n}", "ganja {q} g was recovered from {name}", "A-{n} and a{m} were caught with {q} kg", "seized from the possession of A1 to A{n}", "seized {q} kg, of which he sold half to A.{n}",
    "all of them were smoking ganja", "ganja was found behind a {name}s shop", "bought from {name}, and seized with A - {m}", "nothing to see at A-{n}", "they tested positive for ganja", "AA-{n} and A-{n}x are no codes; {name} is", "A-{n} who sold one packet to A-{m}",
)


def item_text_sql():
    by = " ".join(f"WHEN {i} THEN " + "concat('" + x.replace("{n}", "', l_linenumber, '").replace("{m}", "', l_linenumber + 1, '").replace("{q}", "', CAST(l_quantity AS INTEGER), '").replace("{name}", "', p_name, '") + "')" for i, x in enumerate(ITEM_TEXTS))
    return f"CASE l_suppkey % {len(ITEM_TEXTS)} {by} END"


def item_text():
    values = {"{n}": F.col("l_linenumber"), "{m}": F.col("l_linenumber") + 1, "{q}": F.col("l_quantity").cast("int"), "{name}": F.col("p_name")}
    part = lambda x: values[x].cast("string") if x in values else F.lit(x)
    texts = [F.concat(*map(part, re.split(r"(\{\w+\})", x))) for x in ITEM_TEXTS]
    return F.element_at(F.array(*texts), (F.col("l_suppkey") % len(texts) + 1).cast("int"))


DEALT_SQL = f"\\b({'|'.join(attributions.DEALT)})\\s"
ATTRIBUTION_SQL = f"""WITH i AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {item_text_sql()} AS s, CASE WHEN l_suppkey % {len(ITEM_TEXTS)} = 8 THEN 'no_drugs_detected' ELSE 'Ganja' END AS item, row_number() OVER () AS id FROM lineitem JOIN part ON p_partkey = l_partkey),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS nth, count(*) OVER (PARTITION BY l_orderkey) AS people FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R')),
spot AS (SELECT id, l_orderkey, s, unnest(list_filter(range(1, length(s) + 1), lambda x: regexp_matches(substr(s, x), '^[Aa]\\s*[-.]?\\s*[0-9]+\\b') AND NOT (x > 1 AND regexp_matches(substr(s, x - 1, 1), '\\w')))) AS x FROM i WHERE NOT regexp_matches(lower(s), '\\ba\\s*[-.]?\\s*[0-9]+\\s+to\\s+a\\s*[-.]?\\s*[0-9]+\\b')),
code AS (SELECT DISTINCT id, l_orderkey, CAST(regexp_extract(substr(s, x), '[0-9]+') AS BIGINT) AS n FROM spot WHERE NOT regexp_matches(lower(substr(s, greatest(1, x - 100), x - greatest(1, x - 100))), '{DEALT_SQL}')),
by_code AS (SELECT code.id, min(p.nth) AS nth FROM code JOIN p ON p.l_orderkey = code.l_orderkey AND p.l_linenumber = code.n GROUP BY code.id, code.n),
word AS (SELECT i.id, i.s, p.nth, w, list_filter(w, lambda x: contains(lower(i.s), x)) AS held FROM i JOIN (SELECT *, list_filter(string_split(lower(p_name), ' '), lambda x: length(x) > 2) AS w FROM p) p ON p.l_orderkey = i.l_orderkey WHERE i.id NOT IN (SELECT id FROM by_code)),
place AS (SELECT id, nth, s, instr(lower(s), held[1]) AS x FROM word WHERE len(held) >= least(2, len(w))),
found AS (SELECT id, nth FROM by_code UNION ALL SELECT id, nth FROM place WHERE NOT regexp_matches(lower(substr(s, greatest(1, x - 100), x - greatest(1, x - 100))), '{DEALT_SQL}')),
per AS (SELECT id, count(*) AS n, min(nth) AS nth FROM found GROUP BY id),
sized AS (SELECT l_orderkey, max(people) AS people FROM p GROUP BY l_orderkey),
rule AS (SELECT i.*, sized.people, per.nth, CASE WHEN sized.people IS NULL THEN 'orphan' WHEN upper(item) = 'NO_DRUGS_DETECTED' THEN 'nothing_found' WHEN per.n = 1 THEN 'individual' WHEN per.n > 1 THEN 'collective'
  WHEN sized.people > 1 AND regexp_matches(lower(s), '{'|'.join(attributions.USE)}') AND regexp_matches(lower(s), '{'|'.join(attributions.ALL)}') THEN 'collective_use' ELSE 'first_person' END AS attribution
  FROM i LEFT JOIN per ON per.id = i.id LEFT JOIN sized ON sized.l_orderkey = i.l_orderkey)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, CASE WHEN p.nth IS NOT NULL THEN concat(p.l_linenumber, '/', p.l_partkey) END AS person, attribution FROM rule r LEFT JOIN p ON p.l_orderkey = r.l_orderkey AND (attribution IN ('nothing_found', 'collective_use') OR p.nth = CASE attribution WHEN 'individual' THEN r.nth ELSE 1 END)"""


@R.query(ATTRIBUTION_SQL)
def attribution(t):
    """Items go to those whom their sentence names by code or name, or to the first of the case, to all, to nobody."""
    lines = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey").withColumn("person", F.concat_ws("/", "l_linenumber", "l_partkey"))
    people = lines.where("l_returnflag <> 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "person", F.concat(F.lit("A"), "l_linenumber").alias("code"), "p_name").distinct()
    items = lines.select("l_orderkey", "l_linenumber", "l_partkey", item_text().alias("sentence"), F.when(F.col("l_suppkey") % len(ITEM_TEXTS) == 8, "no_drugs_detected").otherwise("Ganja").alias("item"))
    out = attributions.attribute(items, people, "l_orderkey", "sentence", "person", "code", "p_name", ["l_linenumber", "l_partkey"], "item")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "person", "attribution")
