"""Nested serving views: one row per case, per person in a case, and per person, each child aggregated before it is joined.

Cases are orders, people customers, a case's items lines, its place nation and region. Nested values are arrays of
structs, in a defined order; the queries show them as text so that they compare.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, nested
from ..operators import joins, views
from ..shared import shared_dir
from .base import Registry

R = Registry()
AS_OF = "1998-01-01"


def items_of_cases(t) -> DataFrame:
    """case_id, items array<struct(n, part, quantity, flag)>, kinds, counts map<flag, n>, quantity: one grouping."""
    item = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"))
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("case_id")).agg(nested.ordered_list(item, F.col("l_linenumber"), F.col("l_partkey"), F.col("l_shipdate")).alias("items"), nested.sorted_set(F.col("l_returnflag")).alias("kinds"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))
    of_kind = F.transform("kinds", lambda k: F.size(F.filter("items", lambda x: x.flag == k)).cast("long"))
    return g.withColumn("counts", F.map_from_arrays("kinds", of_kind))


def places(t) -> DataFrame:
    """A fixed number of nations."""
    return F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("station"), F.col("r_name").alias("district")))


def case_view(t) -> DataFrame:
    """Cases with at least one item: place, people, items, counts, days until due."""
    person = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    c = t.orders.select(F.col("o_orderkey").alias("case_id"), "o_custkey", F.col("o_orderdate").cast("date").alias("registered"), F.col("o_orderstatus").alias("state"))
    c = c.join(items_of_cases(t), "case_id").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(places(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    days = dates.sla_days(F.col("quantity") > 100)
    return c.select("case_id", "registered", "state", "station", "district", F.array(person).alias("people"), "items", "kinds", "counts", "quantity", F.date_add("registered", days).alias("due"), dates.sla_bucket(F.col("registered"), F.lit(AS_OF).cast("date"), days).alias("sla"))


def person_view(t) -> DataFrame:
    """People with their cases in order, the number of large ones, and the suppliers as people known from texts only."""
    per_case = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))
    one = F.struct(F.col("o_orderkey").alias("case_id"), F.col("o_orderdate").cast("date").alias("registered"), "quantity")
    cases = t.orders.join(per_case, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(nested.ordered_list(one, F.col("o_orderdate"), F.col("o_orderkey")).alias("cases"), F.count_if(F.col("quantity") > 100).alias("large"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"))
    known = t.customer.join(cases, F.col("c_custkey") == F.col("o_custkey")).select(F.lit("registered").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "cases", "large", "latest")
    text_only = t.supplier.select(F.lit("text_only").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return known.unionByName(text_only, allowMissingColumns=True).withColumns({"cases": F.coalesce("cases", F.array().cast(known.schema["cases"].dataType)), "large": F.coalesce("large", F.lit(0))})


ITEMS = "SELECT l_orderkey, string_agg(concat(l_linenumber, ':', l_partkey, ':', CAST(l_quantity AS BIGINT), l_returnflag), ' ' ORDER BY l_linenumber, l_partkey, l_shipdate) AS items, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS kinds, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity FROM lineitem GROUP BY 1"


@R.query(f"""WITH i AS ({ITEMS}), f AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), m AS (SELECT l_orderkey, string_agg(concat(l_returnflag, n), ',' ORDER BY l_returnflag) AS counts FROM f GROUP BY 1)
SELECT o_orderkey AS case_id, n_name AS station, r_name AS district, concat(c_custkey, c_name) AS people, md5(i.items) AS items, kinds, counts, CAST(quantity AS DOUBLE) AS quantity, CAST(CAST(o_orderdate AS DATE) + CASE WHEN quantity > 100 THEN 180 ELSE 60 END AS DATE) AS due
FROM orders JOIN i ON i.l_orderkey = o_orderkey JOIN m ON m.l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def view_cases(t):
    """M1 A10 A12 F25"""
    return _shown(case_view(t))


def _shown(v: DataFrame) -> DataFrame:
    return v.select("case_id", "station", "district", F.array_join(F.transform("people", lambda p: F.concat(p["id"], p["name"])), ",").alias("people"), F.md5(F.array_join(F.transform("items", lambda x: F.concat(x["n"], F.lit(":"), x["part"], F.lit(":"), x["quantity"].cast("long"), x["flag"])), " ")).alias("items"), F.array_join("kinds", ",").alias("kinds"), F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e.key, e.value)), ",").alias("counts"), F.col("quantity").cast("double").alias("quantity"), "due")


class _Part:
    """Tables of which orders and lines are a part."""

    def __init__(self, t, orders: DataFrame, lineitem: DataFrame) -> None:
        self._t, self.orders, self.lineitem = t, orders, lineitem

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(self._t, name)


@R.query(R.sql["view_cases"])
def view_cases_after_changes(t):
    """The view as it was before some orders and lines came, brought up to date by rewriting the folders of the
    cases that they belong to; the same as a view built anew."""
    path = f"{shared_dir(t.spark)}/case-view-{uuid.uuid4().hex}"
    late_orders, late_lines = F.col("o_orderkey") % 7 == 0, F.col("l_linenumber") == 3
    views.store(case_view(_Part(t, t.orders.where(~late_orders), t.lineitem.where(~late_lines))), "case_id", path, 16)
    changed = views.changed_parents([(t.orders.where(late_orders), "o_orderkey"), (t.lineitem.where(late_lines), "l_orderkey")])
    of = lambda df, c, keys: df.join(keys, F.col(c) == F.col("case_id"), "left_semi")
    views.refresh_changed(path, "case_id", changed, lambda keys: case_view(_Part(t, of(t.orders, "o_orderkey", keys), of(t.lineitem, "l_orderkey", keys))), 16)
    return _shown(t.spark.read.parquet(path))


KINDS = ("click", "error", "login", "purchase", "view")
#: Lists of a case as text: (name, what is listed, in which order, where).
CHILD_SQL = {
    "items": ("lineitem", "l_orderkey", "concat(l_linenumber, ':', l_partkey, ':', CAST(l_quantity AS BIGINT))", "l_linenumber, l_partkey, l_shipdate", "true"), "seizures": ("lineitem", "l_orderkey", "concat(l_partkey, '@', CAST(l_shipdate AS DATE))", "l_shipdate, l_partkey", "l_returnflag = 'R'"),
    "chargesheets": ("lineitem", "l_orderkey", "concat(l_suppkey, '/', year(l_shipdate))", "l_shipdate, l_suppkey", "l_linestatus = 'F'"), **{k: ("visits", "o_orderkey", "event_id", "event_id", f"event_type = '{k}'") for k in KINDS},
}


@R.query("WITH visits AS (SELECT o_orderkey, event_id, event_type FROM orders JOIN events ON user_id = o_custkey AND value > 50), "
    + ", ".join(f"{n}_l AS (SELECT {key} AS k, string_agg({value}, ' ' ORDER BY {order}) AS {n} FROM {table} WHERE {where} GROUP BY 1)" for n, (table, key, value, order, where) in CHILD_SQL.items())
    + """, d AS (SELECT l_orderkey AS k, string_agg(concat(l_linestatus, '=', n), ',' ORDER BY l_linestatus) AS disposals FROM (SELECT l_orderkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1)
SELECT o_orderkey AS case_id, c_name AS person, coalesce(disposals, '') AS disposals, """
    + ", ".join(f"coalesce({n}, '') AS {n}" for n in CHILD_SQL)
    + " FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN d ON d.k = o_orderkey " + " ".join(f"LEFT JOIN {n}_l ON {n}_l.k = o_orderkey" for n in CHILD_SQL))
def view_full_cases(t):
    """M1 with all its kinds of children: items, seizures, chargesheets, disposals by state, and lists by kind of document."""
    day, c = F.col("l_shipdate").cast("date"), F.col
    children = {
        "items": views.Children(t.lineitem, "l_orderkey", F.concat_ws(":", "l_linenumber", "l_partkey", c("l_quantity").cast("long")), (c("l_linenumber"), c("l_partkey"), c("l_shipdate")), c("l_linestatus")),
        "seizures": views.Children(t.lineitem.where("l_returnflag = 'R'"), "l_orderkey", F.concat_ws("@", "l_partkey", day), (c("l_shipdate"), c("l_partkey"))),
        "chargesheets": views.Children(t.lineitem.where("l_linestatus = 'F'"), "l_orderkey", F.concat_ws("/", "l_suppkey", F.year("l_shipdate")), (c("l_shipdate"), c("l_suppkey"))),
    }
    visits = t.orders.join(t.events.where("value > 50"), F.col("user_id") == F.col("o_custkey")).select("o_orderkey", "event_id", "event_type")
    children |= {k: views.Children(visits.where(c("event_type") == k), "o_orderkey", c("event_id").cast("string"), (c("event_id"),)) for k in KINDS}
    cases = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(c("o_orderkey").alias("case_id"), c("c_name").alias("person"))
    v = views.with_children(cases, "case_id", children)
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("items_counts")), lambda e: F.concat_ws("=", e.key, e.value)), ",")
    return v.select("case_id", "person", counts.alias("disposals"), *(F.array_join(n, " ").alias(n) for n in CHILD_SQL))


@R.query(f"SELECT o_orderkey AS case_id, c_custkey AS person_id, c_name AS name, n_name AS station, o_orderstatus AS state, count(*) OVER (PARTITION BY c_custkey) AS cases_of_person FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def view_people_in_cases(t):
    """M2: one row per person and case."""
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cases_of_person"))
    j = t.orders.join(t.customer.join(n, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey"), F.col("o_custkey") == F.col("c_custkey")).join(places(t), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("o_orderkey").alias("case_id"), F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"), "station", F.col("o_orderstatus").alias("state"), "cases_of_person")


@R.query("""WITH q AS (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity FROM lineitem GROUP BY 1),
c AS (SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY o_orderdate, o_orderkey) AS cases, count(*) FILTER (WHERE quantity > 100) AS large, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS latest FROM orders JOIN q ON l_orderkey = o_orderkey GROUP BY 1)
SELECT 'registered' AS kind, c_custkey AS id, c_name AS name, cases, large, latest FROM customer JOIN c ON o_custkey = c_custkey UNION ALL SELECT 'text_only', s_suppkey, s_name, '', 0, NULL FROM supplier""")
def view_people(t):
    """M3 U1 J13"""
    return person_view(t).select("kind", "id", "name", F.array_join(F.transform("cases", lambda c: c.case_id.cast("string")), ",").alias("cases"), "large", "latest")


@R.query("""SELECT l_orderkey AS case_id, c_custkey AS person_id, n_name AS station, md5(string_agg(concat('{"part":', l_partkey, ',"flag":"', l_returnflag, '"}'), ',' ORDER BY l_linenumber, l_partkey, l_returnflag)) AS drugs FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3""")
def view_search_people(t):
    """Flat, with its items as JSON."""
    item = F.struct(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))
    i = t.lineitem.groupBy("l_orderkey").agg(nested.ordered_list(item, F.col("l_linenumber"), F.col("l_partkey"), F.col("l_returnflag")).alias("items"))
    j = t.orders.join(i, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(places(t), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("o_orderkey").alias("case_id"), F.col("c_custkey").alias("person_id"), "station", F.md5(F.array_join(F.transform("items", lambda x: F.to_json(x)), ",")).alias("drugs"))


@R.query("""SELECT o_orderkey AS case_id, CAST(o_orderdate AS DATE) AS registered, concat('[{"id":', c_custkey, ',"name":"', c_name, '"}]') AS people FROM orders JOIN customer ON c_custkey = o_custkey WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def view_search_cases(t):
    """M5 J5"""
    with_items = t.orders.join(t.lineitem.select("l_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    j = with_items.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(F.col("o_orderkey").alias("case_id"), F.col("o_orderdate").cast("date").alias("registered"), F.to_json(F.array(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))).alias("people"))


@R.query("SELECT l_orderkey AS case_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_shipdate) AS INTEGER) AS ord, l_partkey AS part, l_returnflag AS flag FROM lineitem")
def view_items_flat(t):
    """The nested items out again, one row each with its place."""
    return items_of_cases(t).select("case_id", F.posexplode("items").alias("pos", "x")).select("case_id", (F.col("pos") + 1).alias("ord"), "x.part", "x.flag")


@R.query("""SELECT o_custkey AS person_id, o_orderkey AS case_id, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS n FROM orders) WHERE n = 1""")
def largest_case_per_person(t):
    """J10 A13"""
    return joins.first_per_key(t.orders, ["o_custkey"], F.desc_nulls_last("o_totalprice"), F.col("o_orderkey")).select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("case_id"), "o_totalprice")
