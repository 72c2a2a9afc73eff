"""Incremental maintenance: two snapshots of orders, and events as runs, failures and late references."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import merge
from ..sources import readers
from .base import Registry

R = Registry()
OLD = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_totalprice AS price, o_orderdate AS changed FROM orders WHERE o_orderkey % 10 <> 0"
NEW = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice AS price, o_orderdate + INTERVAL 1 DAY * (CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE 1 END) AS changed FROM orders WHERE o_orderkey % 3 <> 0"
BOTH = f"WITH o AS ({OLD}), n AS ({NEW}), j AS (SELECT coalesce(o.k, n.k) AS k, o.k AS ok, n.k AS nk, o.status AS os, n.status AS ns, o.price AS op, n.price AS np, o.changed AS oc, n.changed AS nc FROM o FULL JOIN n ON o.k = n.k)"
ACTION = "CASE WHEN nk IS NULL THEN 'keep' WHEN ok IS NULL THEN 'insert' WHEN {same} THEN 'no_change' ELSE 'update' END AS action"


def snapshots(t):
    k = F.col("o_orderkey")
    old = t.orders.where(k % 10 != 0).select(k.alias("k"), F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("changed"))
    day = F.when(k % 5 == 0, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    new = t.orders.where(k % 3 != 0).select(k.alias("k"), F.when(k % 4 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("price"), day.alias("changed"))
    return old, new


@R.query(f"{BOTH} SELECT k, CASE WHEN nk IS NULL THEN os ELSE ns END AS status, coalesce(np, op) AS price, {ACTION.format(same='os IS NOT DISTINCT FROM ns AND op IS NOT DISTINCT FROM np')} FROM j")
def upsert_if_changed(t):
    """T5 P9 S9 S10"""
    return merge.merge(*snapshots(t), ["k"], ["status", "price"])


@R.query(f"{BOTH} SELECT k, coalesce(ns, os) AS status, coalesce(np, op) AS price, {ACTION.format(same='os IS NOT DISTINCT FROM coalesce(ns, os) AND op IS NOT DISTINCT FROM np')} FROM j")
def upsert_preserving(t):
    """A new null never overwrites."""
    return merge.merge(*snapshots(t), ["k"], ["status", "price"], keep_old_where_null=True)


@R.query(f"{BOTH} SELECT k, CASE WHEN ok IS NULL OR nc > oc THEN ns ELSE os END AS status, CASE WHEN ok IS NULL OR nc > oc THEN nc ELSE oc END AS changed, {ACTION.format(same='nc <= oc')} FROM j")
def upsert_if_newer(t):
    """T7"""
    return merge.merge(*snapshots(t), ["k"], ["status", "changed"], newer="changed")


@R.query("""SELECT l_orderkey AS parent, l_linenumber AS n, l_partkey AS v FROM lineitem WHERE l_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, 0, o_custkey FROM orders WHERE o_orderkey % 5 = 0""")
def replace_children(t):
    """T8"""
    old = t.lineitem.select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("v"))
    new = t.orders.where(F.col("o_orderkey") % 5 == 0).select(F.col("o_orderkey").alias("parent"), F.lit(0).alias("n"), F.col("o_custkey").alias("v"))
    return merge.replace_children(old, new, "parent")


@R.query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey + 1000000, s_name FROM supplier")
def insert_or_ignore(t):
    """T9"""
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = old.unionByName(t.supplier.select((F.col("s_suppkey") + 1000000).alias("id"), F.col("s_name").alias("name")))
    return merge.insert_missing(old, new, ["id"])


@R.query("SELECT DISTINCT user_id AS c_custkey, true AS is_stub FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def person_stubs(t):
    """T9"""
    return merge.stubs(t.events, "user_id", t.customer.where("c_custkey % 2 = 0"), "c_custkey")


@R.query(f"WITH o AS ({OLD}), n AS ({NEW}) SELECT o.k, o.status AS old_value, n.status AS new_value FROM o JOIN n ON o.k = n.k WHERE o.status IS DISTINCT FROM n.status")
def changed_values(t):
    """D5"""
    return merge.changed_only(*snapshots(t), "k", "status")


#: What each priority has still to fetch: from its high-water mark (its latest finished order) to the latest order of all.
TO_FETCH = "r AS (SELECT o_orderpriority, CAST(max(o_orderdate) FILTER (WHERE o_orderstatus = 'F' AND o_custkey % 7 = 0) AS DATE) - INTERVAL 40 DAY AS a, CAST((SELECT max(o_orderdate) FROM orders) AS DATE) AS b FROM orders GROUP BY 1), s AS (SELECT o_orderpriority, CAST(a AS DATE) AS a, b FROM r)"


def _to_fetch(t):
    day = F.col("o_orderdate").cast("date")
    mark = t.orders.groupBy("o_orderpriority").agg(F.date_sub(F.max(F.when((F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 7 == 0), day)), 40).alias("a"))
    return mark.join(F.broadcast(t.orders.agg(F.max(day).alias("b"))))  # one row


@R.query(f"""WITH {TO_FETCH}, c AS (SELECT o_orderpriority, b, unnest(range(0, date_diff('day', a, b) // 4 + 1)) AS i, a FROM s),
d AS (SELECT o_orderpriority, CAST(i AS INTEGER) AS chunk, CAST(a + 4 * CAST(i AS INTEGER) AS DATE) AS chunk_start, b FROM c)
SELECT o_orderpriority, chunk, chunk_start, least(CAST(chunk_start + 4 AS DATE), b) AS chunk_end FROM d WHERE chunk = 0 OR date_diff('day', chunk_start, least(CAST(chunk_start + 4 AS DATE), b)) >= 1""")
def date_chunks(t):
    """From the high-water mark of each priority on."""
    return merge.date_chunks(_to_fetch(t), "a", "b").drop("a", "b")


@R.query(f"""WITH {TO_FETCH}, c AS (SELECT o_orderpriority, b, unnest(range(0, date_diff('day', a, b) // 5 + 1)) AS i, a FROM s),
d AS (SELECT o_orderpriority, CAST(i AS INTEGER) AS chunk, CAST(b - 5 * CAST(i AS INTEGER) AS DATE) AS chunk_end, a FROM c)
SELECT o_orderpriority, chunk, greatest(CAST(chunk_end - 4 AS DATE), a) AS chunk_start, chunk_end FROM d""")
def date_chunks_backwards(t):
    """T2"""
    return merge.date_chunks_backwards(_to_fetch(t), "a", "b").drop("a", "b")


@R.query("SELECT greatest(max(o_orderdate), max(o_orderdate + INTERVAL 2 DAY), TIMESTAMP '1992-01-01') AS high_water_mark FROM orders")
def high_water_mark(t):
    """T3"""
    rows = t.orders.select(F.col("o_orderdate").cast("timestamp").alias("created"), (F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).cast("timestamp").alias("modified"))
    return merge.high_water_mark(rows, "created", "modified", "1992-01-01")


@R.query("""SELECT module, greatest(coalesce(old, new), coalesce(new, old)) AS until FROM (SELECT o_orderpriority AS module, max(o_orderdate) FILTER (WHERE o_orderstatus <> 'P' AND o_orderpriority < '4') AS old,
  max(o_orderdate) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority > '1') AS new FROM orders GROUP BY 1) WHERE coalesce(old, new) IS NOT NULL""")
def run_checkpoints(t):
    """T4: what was fetched of each priority before, moved on by the runs since."""
    ends = lambda rows: rows.groupBy(F.col("o_orderpriority").alias("module")).agg(F.max("o_orderdate").alias("until"))
    return merge.checkpoints(ends(t.orders.where("o_orderstatus <> 'P' AND o_orderpriority < '4'")), ends(t.orders.where("o_orderstatus = 'P' AND o_orderpriority > '1'")))


@R.query("""WITH q AS (SELECT event_id, user_id AS key, CAST(event_id % 6 AS INTEGER) AS attempts, event_id % 11 = 0 AS resolved FROM events), k AS (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey % 3 = 0),
t AS (SELECT q.*, NOT resolved AND attempts < 5 AS due, c_custkey IS NOT NULL AS found FROM q LEFT JOIN k ON c_custkey = key)
SELECT event_id, key, CAST(attempts + CASE WHEN due THEN 1 ELSE 0 END AS INTEGER) AS attempts, resolved OR (due AND found) AS resolved,
  CASE WHEN resolved OR (due AND found) THEN 'resolved' WHEN attempts + CASE WHEN due THEN 1 ELSE 0 END >= 5 THEN 'given_up' ELSE 'parked' END AS state FROM t""")
def retry_queue(t):
    """T10"""
    q = t.events.select("event_id", F.col("user_id").alias("key"), (F.col("event_id") % 6).cast("int").alias("attempts"), (F.col("event_id") % 11 == 0).alias("resolved"))
    return merge.park_and_retry(q, t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key")), "key")


@R.query("""WITH p AS (SELECT user_id, min(ts) AS came FROM events WHERE event_type = 'signup' GROUP BY 1),
w AS (SELECT event_id, e.user_id, greatest(CAST(ceil((epoch_us(came) - epoch_us(ts)) / 7200000000.0) AS INTEGER), 0) AS looks FROM events e LEFT JOIN p ON p.user_id = e.user_id WHERE event_type = 'purchase')
SELECT event_id, user_id, CASE WHEN looks <= 5 THEN looks ELSE 5 END AS attempts, CASE WHEN looks <= 5 THEN 'resolved' ELSE 'given_up' END AS state FROM w""")
def retried_rows(t):
    """Purchases wait for the sign-up of their user, looked for every two hours, five times at most."""
    of = lambda kind: t.events.where(F.col("event_type") == kind)
    return merge.retried(of("purchase"), of("signup"), "event_id", "user_id", "ts", 7200)


RUNS = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'complete' END AS status, o_orderdate + INTERVAL 1 DAY * CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE 1 END AS completed_at FROM orders WHERE o_orderkey % 2 = 0"


@R.query(f"""WITH r AS ({RUNS}), d AS (SELECT o_orderkey, max(completed_at) AS done FROM r WHERE status = 'complete' GROUP BY 1)
SELECT o.o_orderkey FROM orders o LEFT JOIN d ON d.o_orderkey = o.o_orderkey WHERE (done IS NULL OR o_orderdate > done) AND o_orderdate >= TIMESTAMP '1996-01-01'""")
def pending_cases(t):
    """T11 S3 P11"""
    k = F.col("o_orderkey")
    day = F.when(k % 5 == 0, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    log = t.orders.where(k % 2 == 0).select("o_orderkey", F.when(k % 3 == 0, "failed").otherwise("complete").alias("status"), day.alias("completed_at"))
    return merge.pending(t.orders, "o_orderkey", "o_orderdate", log, F.lit("1996-01-01").cast("timestamp_ntz")).select("o_orderkey")


@R.query("""WITH l AS (SELECT user_id, event_id AS run_id, ts AS started_at, CASE WHEN event_type = 'view' THEN 'in_progress' ELSE 'complete' END AS status FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY started_at DESC, run_id DESC) AS nth FROM l)
SELECT user_id, run_id, CASE WHEN status = 'in_progress' AND epoch(TIMESTAMP '2024-02-01') - epoch(started_at) > 48 * 3600 THEN 'failed' ELSE status END AS status FROM n WHERE nth = 1""")
def run_states(t):
    """T13"""
    log = t.events.select("user_id", F.col("event_id").alias("run_id"), F.col("ts").cast("timestamp").alias("started_at"), F.when(F.col("event_type") == "view", "in_progress").otherwise("complete").alias("status"))
    return merge.run_states(log, "user_id", F.lit("2024-02-01").cast("timestamp"), 48).select("user_id", "run_id", "status")


@R.query("SELECT user_id, count(*) AS attempts, max(ts) AS last_failure FROM events WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') <= 10 GROUP BY user_id HAVING count(*) >= 3")
def quarantined_keys(t):
    """T14"""
    return merge.quarantined(t.events.select("user_id", F.col("ts").alias("failed_at")), "user_id", 3, F.lit("2024-02-01").cast("date"), 10)


@R.query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate - INTERVAL 1 YEAR END, o_orderdate) AS o_orderdate FROM orders")
def legacy_dates(t):
    """T18"""
    legacy = t.orders.where("o_orderkey % 4 = 0").select("o_orderkey", (F.col("o_orderdate") - F.expr("INTERVAL 1 YEAR")).alias("reg_dt"))
    return merge.remap_dates(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", legacy, {"o_orderdate": "reg_dt"})


@R.query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS extra FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def evolved_columns(t):
    """Additive schemas: what a side lacks is null."""
    return merge.evolve(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("extra")))


FILES = "SELECT o_orderkey AS parent, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN [] ELSE [concat('f', o_orderkey), 'g'] END AS ids FROM orders"


@R.query(f"""WITH f AS ({FILES}) SELECT 'case' AS source_type, 'copy' AS source_field, parent AS parent_id, ids IS NOT NULL AS has_field, coalesce(len(ids), 0) = 0 AS is_empty, CAST(i AS INTEGER) AS file_index, CASE WHEN len(ids) > 0 THEN ids[i + 1] END AS file_id
FROM (SELECT *, unnest(CASE WHEN len(ids) > 0 THEN range(0, len(ids)) ELSE [0] END) AS i FROM f)""")
def file_references(t):
    """S12 J11"""
    return readers.file_references(_with_files(t), "case", "copy", "parent", "ids")


def _with_files(t):
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("parent"), F.when(k % 3 == 1, F.array().cast("array<string>")).when(k % 3 == 2, F.array(F.concat(F.lit("f"), k), F.lit("g"))).alias("ids"))


@R.query(f"""WITH f AS ({FILES}) SELECT parent AS parent_id, CAST(i AS INTEGER) AS file_index, CASE WHEN len(ids) > 0 THEN ids[i + 1] END AS file_id
FROM (SELECT *, unnest(CASE WHEN len(ids) > 0 THEN range(0, len(ids)) ELSE [0] END) AS i FROM f) WHERE parent % 2 <> 0""")
def new_file_rows(t):
    """What is stored already (even parents) is left out, repeated deliveries count once."""
    found = readers.file_references(_with_files(t), "case", "copy", "parent", "ids")
    return readers.new_file_rows(found.unionByName(found), found.where("parent_id % 2 = 0")).select("parent_id", "file_index", "file_id")


@R.query("SELECT event_type, count(*) AS files, count(DISTINCT user_id) AS parents, count(*) FILTER (WHERE value > 50) AS downloaded FROM events GROUP BY event_type")
def files_summary(t):
    """M7"""
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("files"), F.countDistinct("user_id").alias("parents"), F.count_if(F.col("value") > 50).alias("downloaded"))


@R.query("SELECT c_custkey AS id, c_name AS name, n_name AS place, concat('c_acctbal=', printf('%.2f', c_acctbal), ';c_mktsegment=', c_mktsegment) AS leftover FROM customer JOIN nation ON n_nationkey = c_nationkey")
def documents_to_tables(t):
    """Fields of flat documents go to two tables, all others to a map."""
    docs = t.customer.withColumn("c_acctbal", F.format_string("%.2f", "c_acctbal"))
    parts = readers.split_document(docs, "c_custkey", {"person": {"name": "c_name"}, "address": {"place": "c_nationkey"}})
    rest = parts["leftover"].select("c_custkey", F.array_join(F.transform(F.array_sort(F.map_entries("fields")), lambda e: F.concat_ws("=", e.key, e.value)), ";").alias("leftover"))
    joined = parts["person"].join(parts["address"], "c_custkey").join(rest, "c_custkey").join(F.broadcast(t.nation), F.col("place") == F.col("n_nationkey"))
    return joined.select(F.col("c_custkey").alias("id"), "name", F.col("n_name").alias("place"), "leftover")


@R.query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def fields_from_json(t):
    """P2 P2b"""
    return readers.fields_from_json(t.events.select("event_id", "event_type", "props"), "props", "k bigint", {"k": "k"})


@R.query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'court' ELSE c_mktsegment END AS court FROM customer")
def coalesced_keys(t):
    """Nested or flat key, the word null as missing."""
    k = F.col("c_custkey")
    row = t.customer.select(k, F.struct(F.when(k % 3 == 1, "court").when(k % 3 == 0, "NULL").alias("courtName")).alias("takenOnFile"), F.when(k % 3 != 0, F.col("c_mktsegment")).alias("COURT_NAME"))
    return row.select("c_custkey", F.coalesce(T.null_word_to_null(F.col("takenOnFile.courtName")), T.null_word_to_null(F.col("COURT_NAME"))).alias("court"))
