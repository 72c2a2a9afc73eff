"""Phonetic candidates, attribution of items, and branches, on cases with doubt in them."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from caseloom.functions.phonetics import double_metaphone
from caseloom.operators import attribution, branches, joins


@pytest.mark.parametrize(
    ("name", "codes"),
    [
        ("Thompson", ("TMPS", "TMPS")), ("Smith", ("SM0", "XMT")), ("Schmidt", ("XMT", "SMT")), ("Catherine", ("K0RN", "KTRN")), ("Katherine", ("K0RN", "KTRN")), ("Jose", ("HS", "HS")), ("Michael", ("MKL", "MXL")), ("Caesar", ("SSR", "SSR")),
        ("Xavier", ("SF", "SFR")), ("Laugh", ("LF", "LF")), ("Bough", ("P", "P")), ("Chianti", ("KNT", "KNT")), ("Bacci", ("PX", "PX")), ("Accident", ("AKST", "AKST")), ("Tagliaro", ("TKLR", "TLR")), ("Filipowicz", ("FLPT", "FLPF")),
        ("Breaux", ("PR", "PR")), ("Rajesh", ("RJX", "RJX")), ("Krishna", ("KRXN", "KRXN")), ("Lakshmi", ("LKXM", "LKXM")), ("Sugar", ("XKR", "SKR")), ("Island", ("ALNT", "ALNT")), ("school", ("SKL", "SKL")), ("Schneider", ("XNTR", "SNTR")),
        ("cabrillo", ("KPRL", "KPR")), ("gallegos", ("KLKS", "KKS")), ("focaccia", ("FKX", "FKX")), ("architect", ("ARKT", "ARKT")), ("ghost", ("KST", "KST")), ("danger", ("TNJR", "TNKR")), ("Zhao", ("J", "J")), ("", ("", "")), (None, ("", "")), ("12 ?", ("", "")),
        ("widget", ("AJT", "FJT")), ("new", ("N", "NF")), ("old widget", ("ALTJ", "ALTJ")), ("José", ("HS", "HS")),
    ],
)
def test_double_metaphone(name, codes):
    assert double_metaphone(name) == codes


@pytest.mark.parametrize("piece", [1, 7, 5000])
def test_met_is_a_join(spark, piece):
    r = random.Random(4)
    left = [(r.choice(["hot"] * 9 + list("abcde")), i) for i in range(150)]
    right = [(r.choice(["hot"] * 9 + list("bcdef")), i) for i in range(120)]
    got = joins.met(spark.createDataFrame(left, "k string, x long"), spark.createDataFrame(right, "k string, y long"), ["k"], piece)
    assert sorted(map(tuple, got.select("k", "x", "y").collect())) == sorted((k, x, y) for k, x in left for j, y in right if k == j)


def test_phonetic_candidates(spark):
    rows = [
        (1, "Smith", "c1", date(2020, 1, 1)), (2, "Smyth", "c2", date(2021, 12, 31)), (3, "Schmidt", "c3", date(2021, 12, 31)), (4, "Smith", "c4", date(2022, 1, 2)), (5, "Smith", "c4", date(2022, 1, 2)), (6, None, "c5", date(2022, 1, 2)),
        (7, "", "c6", date(2022, 1, 2)), (8, "Smith", None, date(2022, 1, 2)), (9, "Smith", "c7", None), (10, "Katherine", "c8", date(2024, 2, 29)), (11, "Catherine", "c9", date(2022, 2, 28)), (12, "Catherine", "c9", date(2022, 3, 1)), (13, "Gary", "c1", date(2024, 3, 1)), (14, "Jerry", "c2", date(2024, 3, 1)),
    ]
    df = spark.createDataFrame(rows, "id long, name string, case string, day date")
    got = {tuple(r) for r in joins.phonetic_candidates(df, df, "id", "name", "case", "day").collect()}
    # Smith and Smyth share a sound key, so do Smith and Schmidt (S530); Katherine and Catherine only share a code
    assert got == {(2, 1, 0), (3, 1, 0), (2, 3, 0), (3, 2, 0), (4, 2, 0), (4, 3, 0), (5, 2, 0), (5, 3, 0), (10, 12, 1), (10, 11, 1)}
    ranked = joins.phonetic_candidates(df, df, "id", "name", "case", "day", most=1)
    assert {(r.id, r.candidate) for r in ranked.collect()} == {(2, 3), (3, 2), (4, 2), (5, 2), (10, 12)}
    assert joins.phonetic_candidates(df.limit(0), df, "id", "name", "case", "day").count() == 0


@pytest.mark.parametrize(
    ("sentence", "codes"),
    [
        ("A-1 has 6 Kg of Ganja", ["A-1"]), ("seized from A-1 and a.2", ["A-1", "A-2"]), ("seized 6 Kg and sold to A-3", []), ("seized from A1, sold to A-3", ["A-1"]), ("265 g from possession of A2 to A4", []), ("A-2 purchased it from A-1", ["A-2", "A-1"]),
        ("A-2 made a purchase from A-1", ["A-2"]), ("AA-1 and A-2x", []), ("sold " + "z" * 120 + " A 7", ["A-7"]), (None, []),
    ],
)
def test_codes_in(sentence, codes):
    assert attribution.codes_in(sentence) == codes


@pytest.mark.parametrize("piece", [1, 2000])
def test_attribution(spark, piece):
    people = [("k", "p1", "A-1", "Raju Kumar", 1), ("k", "p2", "A2", "Sita", 2), ("k", "p3", "a.3", "Ram Raju Bose", 3), ("k", "p4", "A-3", "Bo", 4), ("solo", "q1", None, None, 1), (None, "n", "A-1", "Nobody", 1)]
    items = [
        ("k", "seized from A-2", "Ganja", None, None, "p2 individual"), ("k", "seized from sita", "Ganja", None, None, "p2 individual"), ("k", "raju was there", "Ganja", None, None, "p1 first_person"), ("k", "Raju, Kumar and Sita had it", "Ganja", None, None, "p1 collective"),
        ("k", "A-1 and A-2 and A-9", "Ganja", None, None, "p1 collective"), ("k", "from A-1 to A-3", "Ganja", None, None, "p1 first_person"), ("k", "of A-1 to A-3", "Ganja", None, None, "p1 first_person"), ("k", "bought from Sita", "Ganja", None, None, "p1 first_person"),
        ("k", "all accused were smoking", "Ganja", None, None, "p1 collective_use,p2 collective_use,p3 collective_use,p4 collective_use"), ("k", "x", "no_drugs_detected", None, None, "p1 nothing_found,p2 nothing_found,p3 nothing_found,p4 nothing_found"), ("k", None, None, None, None, "p1 first_person"),
        ("k", "A-1", "Ganja", ["none", "with A-2", "A-1 sold"], None, "p2 individual"), ("k", "A-1", "Ganja", None, "A 3", "p3 individual"), ("k", "A-1", "Ganja", [], "x", "p1 individual"), ("solo", "they smoked, all of them", "Ganja", None, None, "q1 first_person"), ("none", "A-1", "Ganja", None, None, "None orphan"), (None, "A-1", "Ganja", None, None, "None orphan"),
    ]
    who = spark.createDataFrame(people, "case string, person string, code string, name string, nth int")
    what = spark.createDataFrame([(i, *x) for i, x in enumerate(items)], "id int, case string, sentence string, item string, sources array<string>, ref string, expected string")
    for df in (what, what.limit(0)):
        out = attribution.attribute(df, who, "case", "sentence", "person", "code", "name", ["nth"], "item", "sources", "ref", piece)
        got = out.groupBy("id", "expected").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", F.coalesce("person", F.lit("None")), "attribution"))), ",").alias("got")).collect()
        assert [(r.id, r.got) for r in got if r.got != r.expected] == []
        assert len(got) == (len(items) if df is what else 0)


@pytest.mark.parametrize("few", [0, 16])
def test_few_people_need_no_automaton(monkeypatch, few):
    made, automaton = [], attribution.ahocorasick.Automaton
    monkeypatch.setattr(attribution, "FEW", few, raising=False)
    monkeypatch.setattr(attribution.ahocorasick, "Automaton", lambda: made.append(1) or automaton())
    case = attribution._Case()
    for person, name in (("p1", "Raju Kumar"), ("p2", "Sita"), ("p3", "Ram Raju Bose"), ("p4", "Bo")):
        case.add(person, None, name)
    assert [case.named(s) for s in ("raju was there", "Raju, BOSE and sita", "bought from Sita", "Kumar's Raju, sold to Sita", "")] == [[], [1, 2], [], [0], []]
    assert len(made) == (not few)


def test_items_move_once_to_their_people(spark):
    items, people = spark.createDataFrame([("k", "A-1", {"a": 1})], "case string, s string, m map<string, int>"), spark.createDataFrame([("k", "p", "A1", "x", 1)], "case string, person string, code string, name string, nth int")
    out = attribution.attribute(items, people, "case", "s", "person", "code", "name", ["nth"])
    assert out.collect() == [("k", "A-1", {"a": 1}, "individual", "p")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_item" not in plan and "array<string> AS sources" not in plan  # no second join, no lists on the way to Python


def test_codes_near_names(spark):
    text = "Yesterday RAJU KUMAR (A-2) met a.4; far, far away behind the hills and far from here lives Sita with A 5"
    rows = [("Raju Kumar",), ("raju bose",), ("Sita",), ("Nobody",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "n string").select(branches.codes_near(F.lit(text), F.col("n"))).collect()]
    assert got == [["A2", "A4"], ["A2", "A4"], ["A5"], None, None, None]


def test_a_text_is_lowered_and_searched_once_for_a_name(spark):
    df = spark.createDataFrame([("Raju (A-2) met a.4", "raju")], "t string, n string").select(branches.codes_near(F.col("t"), F.col("n")).alias("c"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("lower(t#") == 1
    assert df.first().c == ["A2", "A4"]


def test_branches(spark):
    cases = [("a", "Raju A-1", None), ("b", "Raju (A-1) and, from very far behind the hills, Sita", None), ("c", "Raju A-1", None), ("d", "", None), ("e", None, "failed"), ("f", "x", "failed"), ("g", "", None)]
    extracted = [("a", "Raju", "1"), ("b", "Raju", "1"), ("b", "Sita far", None), ("b", None, "3"), ("c", "Raju", "1"), ("f", "Raju", "1")]
    stubs = [("a", 1, "A-1", None, 77), ("b", 2, "A1", "R.", None), ("b", 3, "A-3", " ", None), ("b", 4, None, None, None), ("f", 5, "A-1", None, None), ("g", 6, "A-6", "Gita", None)]
    out = branches.assembled(
        spark.createDataFrame(cases, "k string, t string, s string"), spark.createDataFrame(extracted, "k string, n string, q string"), spark.createDataFrame(stubs, "k string, id long, code string, stub string, person long"), "k", "n", "q", "t", "s", "id", "code", "stub", "person"
    ).collect()
    got = [(r.k, r.branch, r.full_name, r.person_code, r.role, r.source, r.accused_id if r.source in ("paired", "stub") else None) for r in out if r.full_name or r.role]
    expected = [
        ("b", "B", "Raju", "A1", None, "paired", "2"), ("b", "B", "Sita far", None, None, "unmatched", None), ("b", "B", "A-3", "A-3", None, "stub", "3"), ("b", "B", "Unknown", None, None, "stub", "4"), ("c", "C", "Raju", None, None, "text", None),
        ("d", "C", None, None, branches.NOBODY, None, None), ("e", "C", None, None, branches.FAILED, None, None), ("f", "B", None, None, branches.FAILED, None, None), ("g", "B", "Gita", "A-6", None, "stub", "6"),
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)
