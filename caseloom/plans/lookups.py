"""Questions about one case or person, people with all their records, extracted items, and what readers and writers give."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import extraction, lookups, search
from ..shared import shared_dir
from ..sources import readers
from .base import Registry

R = Registry()

PLACES = "customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"


@R.query(f"SELECT c_custkey, c_name, n_name, r_name, CASE WHEN r_name = 'ASIA' THEN 'home' ELSE 'abroad' END AS domicile, o_orderkey, o_orderdate FROM {PLACES} LEFT JOIN orders ON o_custkey = c_custkey WHERE c_custkey IN (7, 11)")
def person_details(t):
    """By person id, with domicile and cases."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    j = lookups.about(t.customer, "c_custkey", [7, 11], (places, "n_nationkey", "c_nationkey"), (t.orders, "o_custkey", "c_custkey"))
    return j.select("c_custkey", "c_name", "n_name", "r_name", F.when(F.col("r_name") == "ASIA", "home").otherwise("abroad").alias("domicile"), "o_orderkey", "o_orderdate")


@R.query("SELECT o_orderkey, c_custkey, c_name, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderkey IN (1, 7, 20)")
def case_people(t):
    """The people of a case."""
    return lookups.about(t.orders, "o_orderkey", [1, 7, 20], (t.customer, "c_custkey", "o_custkey"), (t.nation, "n_nationkey", "c_nationkey")).select("o_orderkey", "c_custkey", "c_name", "n_name")


@R.query("SELECT o_orderkey, l_linenumber, l_partkey, p_name, l_quantity, s_name FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE o_orderkey IN (1, 7, 20)")
def case_items(t):
    """Items and where they came from."""
    return lookups.about(t.orders, "o_orderkey", [1, 7, 20], (t.lineitem, "l_orderkey", "o_orderkey"), (t.part, "p_partkey", "l_partkey"), (t.supplier, "s_suppkey", "l_suppkey")).select("o_orderkey", "l_linenumber", "l_partkey", "p_name", "l_quantity", "s_name")


@R.query("SELECT o_orderkey, o_orderstatus, count(l_partkey) AS items, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, count(DISTINCT l_returnflag) AS kinds FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey IN (1, 7, 20) GROUP BY 1, 2")
def case_summary(t):
    """One row per case."""
    j = lookups.about(t.orders, "o_orderkey", [1, 7, 20], (t.lineitem, "l_orderkey", "o_orderkey"))
    return j.groupBy("o_orderkey", "o_orderstatus").agg(F.count("l_partkey").alias("items"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"), F.countDistinct("l_returnflag").alias("kinds"))


@R.query("SELECT c_custkey, c_name FROM customer WHERE 8000000000 + c_custkey = 8000000042")
def person_by_phone(t):
    """By a phone number, however it is written."""
    phones = F.array(F.concat(F.lit("+91-"), (F.lit(8000000000) + F.col("c_custkey")).cast("string")), F.lit("n/a"))
    return lookups.with_number(t.customer, phones, "0091 8000000042").select("c_custkey", "c_name")


@R.query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(c_name) LIKE '%0042%' OR lower(c_mktsegment) LIKE '%mach%'")
def person_by_any_text(t):
    """A text in any column."""
    return lookups.any_holds(t.customer, ["c_name"], "0042").unionByName(lookups.any_holds(t.customer, ["c_mktsegment"], "MACH")).distinct().select("c_custkey", "c_name", "c_mktsegment")


@R.query("SELECT o_custkey, count(DISTINCT o_orderkey) AS cases, count(DISTINCT l_partkey) AS items, string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) AS states FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 3")
def people_with_records(t):
    """People with what is linked to them."""
    records = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return lookups.identities(records, "o_custkey", {"cases": "o_orderkey", "items": "l_partkey"}, {"states": "o_orderstatus"}, 3)


@R.query("""WITH p AS (SELECT c_custkey, c_custkey - c_custkey % 4 AS canonical FROM customer) SELECT a.c_custkey, b.c_custkey AS linked, o_orderkey FROM p a JOIN p b ON a.canonical = b.canonical AND a.c_custkey <> b.c_custkey LEFT JOIN orders ON o_custkey = b.c_custkey WHERE a.c_custkey = 6""")
def linked_identities(t):
    """The other records of a person's canonical identity, with their cases."""
    p = t.customer.select("c_custkey", (F.col("c_custkey") - F.col("c_custkey") % 4).alias("canonical"))
    own = p.where("c_custkey = 6")
    other = p.select(F.col("c_custkey").alias("linked"), "canonical")
    j = own.join(other, "canonical").where("linked <> c_custkey")
    return j.join(t.orders, F.col("o_custkey") == F.col("linked"), "left").select("c_custkey", "linked", "o_orderkey")


def _texts(t):
    """A text per order that tells line by line who had how much."""
    line = lambda x: F.concat(F.lit("A-"), x.l_linenumber, F.when(x.l_linenumber % 3 == 0, " was questioned, and tested positive for ganja 5 gms").otherwise(F.concat(F.lit(" was apprehended and "), x.l_quantity.cast("int"), F.lit(" kg ganja was seized"))))
    # only numbers are shuffled and held; lines are made of them afterwards
    lines = F.transform(F.collect_list(F.struct("l_linenumber", "l_quantity")), lambda x: F.struct(x.l_linenumber.alias("l_linenumber"), line(x).alias("s")))
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_sort(lines)["s"], ". ").alias("facts"))


@R.query("""SELECT DISTINCT l_orderkey, concat('A-', l_linenumber) AS person_code, 'Cannabis' AS item, CAST(CAST(l_quantity AS INTEGER) * 1000 AS DOUBLE) AS weight_g, sum(w) OVER (PARTITION BY l_orderkey) >= 100000 AS is_large
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, CAST(l_quantity AS INTEGER) * 1000 AS w FROM lineitem WHERE l_linenumber % 3 <> 0)""")
def seized_items(t):
    """The chain from texts to amounts per person; use without a seizure gives nothing."""
    names = t.spark.createDataFrame([("ganja", "Cannabis"), ("charas", "Charas")], "raw string, standard string")
    return extraction.seized_items(_texts(t), "l_orderkey", "facts", names, "raw", "standard", large_g=100_000.0).select("l_orderkey", "person_code", "item", "weight_g", "is_large")


@R.query("SELECT l_orderkey, count(*) AS segments, count(DISTINCT l_linenumber) AS people FROM lineitem GROUP BY 1")
def person_segments(t):
    """The text of each person of a case."""
    return extraction.segment_counts(_texts(t), "l_orderkey", "facts")


def _folder(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@R.query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_orderkey % 5 <> 4")
def landed_responses(t):
    """Responses as they land, some of them failed ones."""
    path = _folder(t, "responses")
    part = F.col("o_orderkey") % 5
    answers = t.orders.groupBy(F.floor(F.col("o_orderkey") / 50).alias("w"), (part == 4).alias("failed")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))).alias("data"))
    answers.select((~F.col("failed")).alias("status"), "data").write.json(path)
    return readers.api_records(t.spark, path, "id: long, price: double", multi_line=False).select(F.col("id").alias("o_orderkey"), "price")


@R.query("SELECT DISTINCT n_name AS state, r_name AS district FROM nation JOIN region ON r_regionkey = n_regionkey")
def csv_lookup(t):
    """A small table written as CSV with blanks, repeats and padding, and read as a lookup."""
    path = _folder(t, "csv")
    table = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit(" "), "n_name").alias("state"), F.col("r_name").alias("district"))
    readers.export_csv(table.union(table).union(t.region.select(F.lit(" "), "r_name")), path)
    return readers.lookup_csv(t.spark, path, "state string, district string")


@R.query("SELECT 'broken' AS name, 'failed' AS state, CAST(NULL AS BIGINT) AS n UNION ALL SELECT 'people', 'ok', count(*) FROM customer UNION ALL SELECT 'cases', 'ok', count(*) FROM orders")
def refreshed_views(t):
    """Views are rebuilt and replaced; one that fails does not stop the others."""
    folder = _folder(t, "views")
    builders = {"people": lambda _: t.customer, "cases": lambda _: t.orders, "broken": lambda _: t.customer.select("no_such_column")}
    for _ in range(2):  # the second run replaces the first
        state = readers.refresh(t.spark, builders, folder)
    out = None
    for name, how in state.items():
        n = t.spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n")) if how == "ok" else t.spark.range(1).select(F.lit(None).cast("long").alias("n"))
        one = n.select(F.lit(name).alias("name"), F.lit(how.split(":")[0]).alias("state"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@R.query("SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE contains(lower(text), 'apache license') OR contains(lower(source), 'site1')")
def indexed_search(t):
    """Substrings in either of two columns, found by stored runs of three letters; only texts that may hold them are read."""
    path = _folder(t, "postings")
    search.write_postings(t.documents, "doc_id", ["text", "source"], path)
    return search.search(t.documents, "doc_id", path, {"text": "Apache License", "source": "SITE1"}).select("doc_id", F.md5("text").alias("text_md5"))
