"""Analytic reports: a case is an order, a person a customer, a station a nation, a district a region; items are lines."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregates, joins
from .base import Registry

R = Registry()
AS_OF = "1998-01-01"
DEC = "decimal(18,2)"


def as_of():
    return F.lit(AS_OF).cast("date")


@R.query(f"""
WITH items AS (SELECT l_orderkey, count(*) AS n_items, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, c_name, n_name, r_name, CAST(extract(year FROM o_orderdate) AS INTEGER) AS case_year, n_items, quantity, flags,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Pending' ELSE 'Unknown' END AS status,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS elapsed_days,
  CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') > CASE WHEN quantity > 100 THEN 180 ELSE 60 END THEN 'Overdue'
       WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') > CASE WHEN quantity > 100 THEN 165 ELSE 45 END THEN 'Due Soon' ELSE 'Within Limit' END AS sla
FROM orders JOIN items ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def case_overview(t):
    """One row per case with its items, place, state and due date."""
    items = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.col("l_quantity").cast(DEC)).cast("double").alias("quantity"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"))
    places = F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))  # a fixed number of nations
    joined = t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    day = F.col("o_orderdate").cast("date")
    status = F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "P", "Pending").otherwise("Unknown")
    return joined.select("o_orderkey", "c_name", "n_name", "r_name", F.year("o_orderdate").alias("case_year"), "n_items", "quantity", "flags", status.alias("status"), F.datediff(as_of(), day).alias("elapsed_days"), dates.sla_bucket(day, as_of(), dates.sla_days(F.col("quantity") > 100)).alias("sla"))


@R.query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def cases_by_status(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@R.query("SELECT n_name, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 10")
def cases_by_station_top(t):
    """A1 J1 O1"""
    per = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return per.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n").orderBy(F.desc("n"), "n_name").limit(10)


@R.query("SELECT r_name, count(*) AS n, count(DISTINCT o_custkey) AS persons FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def cases_by_region(t):
    places = F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name"))
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(places, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("persons"))


@R.query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') OR o_orderstatus IS NULL GROUP BY o_orderpriority")
def open_cases_by_priority(t):
    """P6"""
    return t.orders.where(F.col("o_orderstatus").isin("O", "P") | F.col("o_orderstatus").isNull()).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@R.query("""SELECT count(DISTINCT o_orderkey) AS cases, count(DISTINCT o_custkey) AS persons, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS worth, min(l_quantity) AS least, max(l_quantity) AS most, round(avg(l_quantity), 6) AS mean
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def case_stats_global(t):
    """Lines are added up per case first, so distinct cases and people are counted over rows of cases."""
    q = F.col("l_quantity")
    items = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("worth"), F.min(q).alias("least"), F.max(q).alias("most"), F.sum(q).alias("total"), F.count(q).alias("n"))
    j = t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.agg(F.countDistinct("o_orderkey").alias("cases"), F.countDistinct("o_custkey").alias("persons"), F.sum("worth").cast("double").alias("worth"), F.min("least").alias("least"), F.max("most").alias("most"), F.round(F.sum("total") / F.sum("n"), 6).alias("mean"))


@R.query("SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, count(*) AS n FROM orders GROUP BY 1")
def cases_by_month(t):
    return t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@R.query("SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS y, CAST(extract(quarter FROM o_orderdate) AS INTEGER) AS q, count(*) AS n FROM orders GROUP BY 1, 2")
def cases_by_quarter(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.count(F.lit(1)).alias("n"))


@R.query("SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS y, count(*) AS total, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS pending, count(*) FILTER (WHERE o_orderstatus = 'F') AS closed FROM orders GROUP BY 1")
def cases_by_year_conditional(t):
    """A5 A6"""
    return t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))


@R.query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-06-30' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def cases_in_range(t):
    """P6 O1 O2"""
    return t.orders.where(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp"), F.lit("1996-06-30").cast("timestamp"))).select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc_nulls_last("o_orderdate"), "o_orderkey").limit(100)


@R.query(f"""SELECT 'last_30_days' AS span, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{AS_OF}' - 30 AND CAST(o_orderdate AS DATE) <= DATE '{AS_OF}'
UNION ALL SELECT 'last_6_months', count(*) FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{AS_OF}' - INTERVAL 6 MONTH AND CAST(o_orderdate AS DATE) <= DATE '{AS_OF}'
UNION ALL SELECT 'last_2_years', count(*) FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{AS_OF}' - INTERVAL 24 MONTH AND CAST(o_orderdate AS DATE) <= DATE '{AS_OF}'""")
def cases_recent(t):
    """Three spans in one pass over the table."""
    day = F.col("o_orderdate").cast("date")
    one = t.orders.agg(F.count_if(dates.in_last_days(day, as_of(), 30)).alias("a"), F.count_if(dates.in_last_months(day, as_of(), 6)).alias("b"), F.count_if(dates.in_last_months(day, as_of(), 24)).alias("c"))
    return one.selectExpr("stack(3, 'last_30_days', a, 'last_6_months', b, 'last_2_years', c) AS (span, n)")


@R.query("""SELECT o_custkey, count(*) AS n_cases, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY o_custkey HAVING count(*) > 1 ORDER BY n_cases DESC, o_custkey LIMIT 50""")
def repeat_offenders(t):
    """A7 A15 O1"""
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_cases"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ", ").alias("priorities")).where("n_cases > 1").orderBy(F.desc("n_cases"), "o_custkey").limit(50)


@R.query("SELECT DISTINCT p_partkey, p_name FROM part WHERE p_name ILIKE '%1%' OR p_brand ILIKE '%brand#2%' OR p_type ILIKE '%steel%'")
def search_any_column(t):
    """P7 A14"""
    return t.part.where(F.col("p_name").ilike("%1%") | F.col("p_brand").ilike("%brand#2%") | F.col("p_type").ilike("%steel%")).select("p_partkey", "p_name").distinct()


@R.query("SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '(?i)^customer[-#.]?0*[0-9]*5$')")
def search_by_pattern(t):
    """P8"""
    return t.customer.where(F.col("c_name").rlike("(?i)^customer[-#.]?0*[0-9]*5$")).select("c_custkey", "c_name")


@R.query("""SELECT p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS worth, count(*) AS items, min(l_quantity) AS least, max(l_quantity) AS most FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type ORDER BY worth DESC, p_type LIMIT 20""")
def worth_by_category(t):
    """A3 O1: lines are summed by part before the join."""
    per = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("w"), F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
    return per.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(F.sum("w").cast("double").alias("worth"), F.sum("n").alias("items"), F.min("lo").alias("least"), F.max("hi").alias("most")).orderBy(F.desc("worth"), "p_type").limit(20)


FAN_OUT = """WITH e AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id)
SELECT o_custkey, count(DISTINCT o_orderkey) AS cases, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS worth FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey {more} GROUP BY o_custkey"""


@R.query(FAN_OUT.format(more="LEFT JOIN events ON user_id = o_custkey"))
def profile_fan_out_literal(t):
    """J26 as it is written there: the sum counts each item once per event."""
    items = t.lineitem.select("l_orderkey", F.col("l_extendedprice").cast(DEC).alias("w"))
    return t.orders.join(items, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(t.events.select("user_id"), F.col("user_id") == F.col("o_custkey"), "left").groupBy("o_custkey").agg(F.countDistinct("o_orderkey").alias("cases"), F.sum("w").cast("double").alias("worth"))


@R.query(FAN_OUT.format(more=""))
def profile_fan_out_safe(t):
    """J26 with every side summed before it is joined."""
    items = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("w"))
    return t.orders.join(items, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("o_custkey").agg(F.countDistinct("o_orderkey").alias("cases"), F.sum("w").cast("double").alias("worth"))


@R.query("SELECT l_returnflag, count(*) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM lineitem), 6) AS share FROM lineitem GROUP BY l_returnflag HAVING count(*) * 1.0 / (SELECT count(*) FROM lineitem) >= 0.25")
def dominant_values(t):
    """A24"""
    return aggregates.dominant(t.lineitem, "l_returnflag", 0.25).withColumn("share", F.round("share", 6))


@R.query("""WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, arg_max(o_orderpriority, struct_pack(n := n, l := length(o_orderpriority), v := o_orderpriority)) AS usual_priority FROM c GROUP BY o_custkey""")
def usual_value(t):
    """A19"""
    return aggregates.mode(t.orders, ["o_custkey"], "o_orderpriority", "usual_priority")


@R.query("""SELECT count(*) AS runs, count(*) FILTER (WHERE value > 10) AS succeeded, round(100.0 * count(*) FILTER (WHERE value > 10) / count(*), 2) AS success_pct, CAST(sum(event_id) AS BIGINT) AS items, round(sum(event_id) * 3600.0 / sum(3600), 2) AS items_per_hour FROM events""")
def batch_metrics(t):
    """Each event is a run of one hour."""
    runs = t.events.select("ts", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("te"), (F.col("value") > 10).alias("ok"), "event_id")
    return aggregates.batch_metrics(runs, "ts", "te", "ok", "event_id")


@R.query("""SELECT 'orders' AS table_name, count(DISTINCT o_custkey) AS parents, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(DISTINCT l_orderkey), count(*) FROM lineitem UNION ALL SELECT 'events', count(DISTINCT user_id), count(*) FROM events""")
def coverage_counts(t):
    """A17 U2"""
    return aggregates.coverage({"orders": (t.orders, "o_custkey"), "lineitem": (t.lineitem, "l_orderkey"), "events": (t.events, "user_id")})


@R.query("SELECT 'text' AS column_name, count(nullif(trim(text), '')) AS filled FROM documents UNION ALL SELECT 'lang', count(nullif(trim(lang), '')) FROM documents UNION ALL SELECT 'source', count(nullif(trim(source), '')) FROM documents")
def null_profile(t):
    """A18"""
    return aggregates.non_null_profile(t.documents, ["text", "lang", "source"])


@R.query("""SELECT o_custkey, o_orderkey AS latest_case, o_orderdate AS latest_date FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def latest_case_per_person(t):
    """max_by combines before the shuffle, a window would move every row."""
    return t.orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")).select("o_custkey", F.col("m.o_orderkey").alias("latest_case"), F.col("m.o_orderdate").alias("latest_date"))


@R.query("""SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'view' THEN NULL ELSE ts END DESC NULLS LAST, event_id) AS n FROM events) WHERE n = 1""")
def distinct_on_latest(t):
    """A13"""
    when = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("ts"))
    return joins.first_per_key(t.events, ["user_id"], when.desc_nulls_last(), F.col("event_id")).select("user_id", "event_id", "event_type", "ts")


@R.query("""SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS last_closed, count(*) AS n FROM orders GROUP BY o_custkey""")
def conditional_max(t):
    """A16"""
    return t.orders.groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("last_closed"), F.count(F.lit(1)).alias("n"))


@R.query(f"""SELECT c_custkey, CAST(floor(date_sub('month', min(CAST(o_orderdate AS DATE)), DATE '{AS_OF}') / 12) AS INTEGER) AS years_known FROM customer JOIN orders ON o_custkey = c_custkey WHERE CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' GROUP BY c_custkey""")
def years_since_first_case(t):
    """F26"""
    first = t.orders.where(F.col("o_orderdate").cast("date") <= as_of()).groupBy("o_custkey").agg(F.min(F.col("o_orderdate").cast("date")).alias("first"))
    return t.customer.join(first, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", dates.years_between(F.col("first"), as_of()).alias("years_known"))


@R.query("""WITH m AS (SELECT n_regionkey, s_suppkey, s_acctbal FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT n_regionkey, s_suppkey, s_acctbal, nth FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY s_acctbal DESC, s_suppkey) AS nth FROM m) WHERE nth <= 3""")
def cap_by_score(t):
    """O8"""
    m = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return m.withColumn("nth", F.row_number().over(W.partitionBy("n_regionkey").orderBy(F.desc("s_acctbal"), "s_suppkey"))).where("nth <= 3").select("n_regionkey", "s_suppkey", "s_acctbal", "nth")


@R.query("""SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END, l_linenumber, l_returnflag) AS n FROM lineitem) WHERE n = 1""")
def primary_row(t):
    """The row of the preferred code, else the first by number."""
    rank = F.when(F.col("l_returnflag") == "A", 0).otherwise(1)
    return t.lineitem.groupBy("l_orderkey").agg(F.min(F.struct(rank.alias("r"), "l_linenumber", "l_returnflag")).alias("m")).select("l_orderkey", "m.l_linenumber", "m.l_returnflag")


@R.query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 100 AND o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 50")
def keyset_page(t):
    """S3 O6 O7"""
    from ..sources.readers import keyset_page as page

    return page(t.orders, "o_orderkey", 100, 50, F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")


@R.query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (1, 7, 42)")
def point_lookup(t):
    """S2"""
    from ..sources.readers import keyed

    return keyed(t.customer, "c_custkey", [1, 7, 42]).select("c_custkey", "c_name", "c_mktsegment")
