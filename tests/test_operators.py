"""Golden cases of single operators, and readers, writers and streams."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from caseloom.functions import dates, nested, similarity, text, units
from caseloom.operators import attribution, graph, identity, joins, merge, rules
from caseloom.sources import readers
from caseloom.streaming import incremental


def values(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


def test_uuid5_is_that_of_the_standard(spark):
    names = ["a", "", "Ünïcode|3"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(nested.uuid5(identity.NAMESPACE, F.col("n"))).collect()
    assert [r[0] for r in got] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_trigram_similarity_of_the_manual(spark):
    assert round(values(spark, similarity.trigram_similarity(F.lit("word"), F.lit("two words")))[0], 4) == 0.3636


@pytest.mark.parametrize(("raw", "expected"), [("8c", "Small"), ("20(b)(ii)(C)", "Commercial"), ("20(a)", "Cultivation"), ("27(A)", "Small"), ("20(b)(ii)(B)", "Intermediate"), ("8(c), 20(b)(ii)(C), 20(a)", "Cultivation"), (None, None)])
def test_section_classes(spark, raw, expected):
    assert values(spark, rules.highest_class(rules.section_tokens(F.lit(raw).cast("string"))))[0] == expected


def test_codes_in_sentences(spark):
    assert values(spark, text.person_codes(F.lit("seized from A-1 and a2, later A.01")))[0] == ["A-1", "A-2"]


def test_attribution_falls_back_to_the_first_person(spark):
    items = spark.createDataFrame([(1, "seized at the spot"), (1, "found with A-3"), (2, "nobody")], "case long, sentence string")
    people = spark.createDataFrame([(1, "A-3", None, 3), (1, "A-1", None, 1), (1, "A-2", None, 2)], "case long, code string, name string, seq long")
    got = {(r.sentence, r.person, r.attribution) for r in attribution.attribute(items, people, "case", "sentence", "code", "code", "name", ["seq"]).collect()}
    assert got == {("seized at the spot", "A-1", "first_person"), ("found with A-3", "A-3", "individual"), ("nobody", None, "orphan")}


def test_merge_of_every_kind_of_row(spark):
    schema = "k string, v string"
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), (None, "4"), ("e", "5")], schema)
    new = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None), (None, "8"), ("n", "7")], schema)
    full = {r.k: (r.v, r.action) for r in merge.merge(old, new, ["k"], ["v"]).collect()}
    assert full == {"a": ("1", "no_change"), "b": ("9", "update"), "c": (None, "update"), None: ("8", "update"), "e": ("5", "keep"), "n": ("7", "insert")}
    kept = {r.k: (r.v, r.action) for r in merge.merge(old, new, ["k"], ["v"], keep_old_where_null=True).collect()}
    assert kept["c"] == ("3", "no_change")


def test_scores_stay_explainable(spark):
    person = "struct<name:string,alias:string,age:int,gender:string,phones:array<string>,address:string,station:string,offence:array<string>,associates:array<string>>"
    p = lambda name, age, phones, address: (name, None, age, "Male", phones, address, "s1", ["x"], [])
    pairs = [
        ("same", p("Ravi Kumar", 30, ["8123456780"], "temple road alpha"), p("Kumar Ravi", 31, ["8123456780"], "temple road alpha")),
        ("other", p("Ravi Kumar", 30, ["8123456780"], "temple road alpha"), p("John Smith", 60, ["7123456789"], "market beta")),
        ("name only", p("Zoravar Beniwal", None, [], None), p("Zoravar Beniwal", None, [], None)),
    ]
    got = {r.k: r.score for r in identity.match_score(identity.evidence(spark.createDataFrame(pairs, f"k string, a {person}, b {person}"))).collect()}
    assert got["same"] >= identity.ADOPT and got["other"] < identity.REVIEW and got["name only"] <= 0.64


def test_blocked_pairs_name_what_they_leave_out(spark):
    rows = spark.createDataFrame([(i, "hot" if i < 6 else "k") for i in range(8)], "id long, key string")
    assert {(r.a, r.b) for r in joins.blocked_pairs(rows, "id", F.array("key"), most=3).collect()} == {(6, 7)}
    assert [r.key for r in joins.common_keys(rows, "id", F.array("key"), 3).collect()] == ["hot"]


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("x", "y")], "src string, dst string")
    got = {r.node: r.component for r in graph.components(e).collect()}
    assert set(got.values()) == {"n000", "x"} and len(got) == 63


def test_dates_and_units(spark):
    r = values(spark, dates.parse_tolerant(F.lit("03/02/2024")).cast("string"), dates.parse_tolerant(F.lit("soon")), units.money_in_text(F.lit("worth Rs. 1,50,000/-")), units.quantity_label(F.lit(1500.0), F.lit(None), F.lit(None)), units.valid_age(F.lit("130")), units.money_in_text(F.lit("Rs 2 lakhs")))
    assert r["c0"].startswith("2024-02-03") and list(r)[1:] == [None, 150000.0, "1.50 Kg", None, 200000.0]


def test_identifiers_are_found_and_redacted(spark):
    r = values(spark, rules.identifiers(F.lit("mail a.b@c.org or 9123456780")), rules.redact(F.lit("mail a.b@c.org or 9123456780")))
    assert {(x.kind, x.value) for x in r[0]} == {("email", "a.b@c.org"), ("phone", "9123456780")} and r[1] == "mail <email> or <phone>"


def test_landed_responses_and_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"status": True, "data": [{"ID": "1", "NAME": " "}, {"ID": "2", "NAME": "x"}]}))
    (tmp_path / "in" / "b.json").write_text(json.dumps({"status": False, "data": [{"ID": "3", "NAME": "y"}]}))
    records = readers.api_records(spark, str(tmp_path / "in"), "ID string, NAME string")
    assert {(r.ID, r.NAME) for r in records.select("ID", text.blank_to_null(F.col("NAME")).alias("NAME")).collect()} == {("1", None), ("2", "x")}
    readers.write_table(records, str(tmp_path / "t"), ["ID"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    readers.export_csv(records, str(tmp_path / "c"))
    assert readers.lookup_csv(spark, str(tmp_path / "c"), "ID string, NAME string").count() == 2
    said = readers.refresh(spark, {"good": lambda s: s.range(3), "bad": lambda s: s.table("nowhere")}, str(tmp_path / "v"))
    assert said["good"] == "ok" and said["bad"].startswith("failed") and spark.read.parquet(str(tmp_path / "v" / "good")).count() == 3


def test_stream_of_files_is_merged_into_a_table(spark, tmp_path):
    schema = "k long, v string, at long"
    state = {"n": 0}

    def write(df, number):
        df.write.mode("overwrite").parquet(str(tmp_path / f"table-{number}"))
        state["n"] = number

    spark.createDataFrame([(1, "old", 0)], schema).write.parquet(str(tmp_path / "table-0"))
    read = lambda: spark.read.parquet(str(tmp_path / f"table-{state['n']}")).select("k", "v", "at")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    each = incremental.upsert_into(read, lambda df, number: write(df, number + 1), ["k"], ["v", "at"], "at")
    incremental.run_available(incremental.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), str(tmp_path / "cp"), each)
    assert {(r.k, r.v) for r in read().collect()} == {(1, "b"), (2, "c")}


def test_windowed_counts_of_a_stream(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", "event_id").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    stream = incremental.first_seen(incremental.file_stream(spark, str(tmp_path / "in"), df.schema), "ts", ["event_id"])
    out = incremental.windowed_counts(df, "ts", ["event_type"], "value")
    assert stream.isStreaming and out.agg(F.sum("n")).first()[0] == df.count()


def test_new_codes_are_numbered_over_ranges(spark):
    names = [f"n{i * 7919 % 1000:04d}" for i in range(1000)]
    rows = spark.createDataFrame([(n,) for n in [*names, "known one", None]], "name string").repartition(3)
    known = spark.createDataFrame([("known one", 5)], "known string, code_ int")
    out = joins.found_or_new(rows, "name", known, "known", "code_", similarity.trigram_similarity, 0.8, 9000)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.name: (r.code, r.is_new) for r in out.collect()}
    assert got == {n: (9000 + i, True) for i, n in enumerate(sorted(names))} | {"known one": (5, False), None: (None, True)}


@pytest.mark.parametrize(("raw", "expected"), [
    ("Ravi Kumar s/o Ramu, cell: 9876543210", "Ravi Kumar"), ("A-2) Ravi Kumar", "Ravi Kumar"), ("Ravi (Absconding)", "Ravi"), ("Ravi, Age: 30 yrs", "Ravi"), ("Ravi, 30 yrs.", "Ravi"), ("Ravi Caste: x", "Ravi"), ("Ravi ph. no.: 12345", "Ravi"),
    ("Ravi (Adhaar No. 1234 5678 9012)", "Ravi"), ("Ravi H.No. 1-2", "Ravi"), ("Ravi H/No 12", "Ravi"), ("Ravi and others", "Ravi"), ("Ravi (bulk receiver) Kumar", "Ravi Kumar"), ("Ravi owner of vehicle AB 12", "Ravi"), ("Ravi driver of auto", "Ravi"),
    ("under trial prisoner at x, Ravi", "Ravi"), ("Ravi (UT prisoner no. 12)", "Ravi"), ("Ravi CRPF 39 battalion", "Ravi"), ("Ravi r/o town, street", "Ravi"), ("Ravi N/o village", "Ravi"), ("Ravi (alias Babu)", "Ravi (alias Babu)"), ("s/o Ramu", "s/o Ramu"), ("Hno Rodriguez", "Hno Rodriguez"), (None, None),
])
def test_full_names_without_remarks(spark, raw, expected):
    assert values(spark, text.clean_full_name(F.lit(raw).cast("string")))[0] == expected


@pytest.mark.parametrize(("raw", "expected"), [("found selling and packed it", "peddler"), ("tested positive", "consumer"), ("in-charge of it", "organizer_kingpin"), ("the driver", "supplier"), ("growing plants", "manufacturer"), ("in possession", "peddler"), (None, "unknown"), ("nothing", "unknown")])
def test_roles(spark, raw, expected):
    assert values(spark, rules.role(F.lit(raw).cast("string")))[0] == expected


def test_indic_letters():
    letters = text.indic_letters()
    assert letters["क"] == "k" and letters["ా"] == "aa" and letters["्"] == "" and letters["०"] == " "


def test_a_person_is_attached_only_to_a_likely_one(spark):
    person = "struct<name:string,relative:string,relation:string,gender:string,age:int,locality:string,phone:string>"
    known = spark.createDataFrame([(1, ("ravi kumar", "ramu", "Father", "Male", 30, "alpha", "8123456780")), (2, ("ravi varma", "somu", "Father", "Male", 50, "beta", None))], f"id long, p {person}")
    rows = spark.createDataFrame([(-1, ("ravi kumarr", "ramu", "father", "m", 31, "alpha", "+91 8123456780")), (-2, ("ravi", None, None, None, None, None, None)), (-3, (None, None, None, None, None, None, None))], f"id long, p {person}")
    got = {r.id: r.attached_to for r in identity.attach(known, rows, "id", "p", {c: f"p.{c}" for c in identity.ATTACH}).collect()}
    assert got == {-1: 1, -2: None, -3: None}
