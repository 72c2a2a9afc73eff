"""Items out of texts: whose an amount is, what it is of, and what does not count."""

import pytest
from pyspark.sql import functions as F

from caseloom.functions import text as T
from caseloom.operators import enrich, extraction, merge, rules
from caseloom.plans import lookups


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_amounts(spark):
    found = one(spark, extraction.amounts(F.lit("had 2.5 Kgs ganja, 10 ml oil and 300gms of charas in 4 bags, not 5 gold")))
    assert [(a.quantity, a.unit) for a in found] == [(2.5, "kgs"), (10.0, "ml"), (300.0, "gms")] and found[0].told == "2.5 Kgs ganja, "
    assert one(spark, extraction.amounts(F.lit("nothing"))) == [] and one(spark, extraction.amounts(F.lit(None).cast("string"))) is None


def test_segments_of_any_length(spark):
    text = "Then A-1 had 1 kg and " + "z " * 900 + "hid 2 kg; A2 to A 4 had 5 kg. a.5"
    rows = spark.createDataFrame([("k", text), ("n", None), ("e", "")], "k string, t string")
    got = [(r.person_code, r.joint, len(r.segment)) for r in extraction.segments(rows, "k", "t").orderBy("ord").collect()]
    assert [x[:2] for x in got] == [("A-1", False), ("A-2", False), ("A-4", True), ("A-5", False)] and got[0][2] > 1800


def test_segment_counts_without_a_group(spark):
    texts = [("k", "Then A-1 had 1 kg; A2 to A 4 had 5 kg. a.2 ran"), ("k", "A-1 ran"), ("n", None), ("e", ""), ("x", "nobody")]
    rows = spark.createDataFrame(texts, "k string, t string")
    out = extraction.segment_counts(rows, "k", "t")
    assert sorted((r.k, r.segments, r.people) for r in out.collect()) == [("k", 1, 1), ("k", 4, 3)]
    assert out.dtypes[1:] == [("segments", "bigint"), ("people", "bigint")]


def test_texts_are_made_after_the_shuffle(spark):
    """What person_segments and seized_items deal out and hold are numbers, and texts are grouped once."""
    plan = lookups.R.queries["person_segments"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 2 and "partial_collect_list" in plan
    assert not any("apprehended" in x for x in plan.split("Exchange", 1)[1].splitlines())


def test_seized_items(spark):
    names = spark.createDataFrame([("ganja", "Cannabis"), ("charas", "Charas"), ("hash", "Charas")], "raw string, standard string")
    texts = [
        ("a", "A-1 was apprehended with 2 kg ganja and 5 g charas. A-2 smoked 3 g ganja and tested positive"), ("b", "A-1 to A-2 were seized with 9 kg ganja"), ("c", "Ganja recovered from A-1, the gross weight was 2.5 kg and the net weight was 2 kg"),
        ("d", "Seized 3 packets of 2 kg each of ganja"), ("e", None), ("f", "A-7 had gold seized, 5 kg"),
    ]
    out = extraction.seized_items(spark.createDataFrame(texts, "k string, t string"), "k", "t", names, "raw", "standard", large_g=5000.0)
    got = {(r.k, r.person_code, r.item, r.weight_g, r.is_large) for r in out.collect()}
    assert {x for x in got if x[0] != "c"} == {("a", "A-1", "Cannabis", 2000.0, False), ("a", "A-1", "Charas", 5.0, False), ("d", None, "Cannabis", 6000.0, True)}
    assert extraction.seized_items(spark.createDataFrame(texts[:1], "k string, t string"), "k", "t", names, "raw", "standard", names.limit(1).select(F.lit("cannabis").alias("n"))).select("item").distinct().collect()[0][0] == "Charas"


@pytest.mark.parametrize(
    ("text", "near"),
    [("seized ganja", True), ("ganja was seized", True), ("seized. ganja", False), ("seized " + "x" * 72 + " ganja", True), ("seized " + "x" * 90 + " ganja", False), ("ganja " + "x" * 78 + " seized", True), ("ganja " + "x" * 80 + " seized", False), ("ganjas seized", False), ("", False), (None, False)],
)
def test_near_in_clause(spark, text, near):
    assert one(spark, rules._near_in_clause(F.lit(text).cast("string"), F.lit("ganja"), ("seized",), 80)) == near
    assert one(spark, rules._near_in_clause(F.lit(text).cast("string"), F.lit(""), ("seized",), 80)) is False


def test_gross_beside_net(spark):
    text = F.lit("Total gross weight was 2.592 kilograms and the net weight was 2.398 kilograms. The gross wt of another was 3 kg")
    both, alone = F.lit("the gross weight was 2.592 kilograms and so on"), F.lit("it was 2.592 kilograms")
    checks = [(both, 2592.0, True), (both, 2398.0, False), (alone, 2592.0, False), (F.lit("gross wt of another was 3 kg"), 3000.0, False), (both, None, False)]
    assert [one(spark, enrich.is_gross_beside_net(text, s, F.lit(w).cast("double"))) for s, w, _ in checks] == [x for *_, x in checks]


def test_relevant_sections(spark):
    def kept(text):
        return tuple(one(spark, T.relevant_sections(F.lit(text).cast("string"), r"\n", ("ganja",), ("ndps",), ("kg", "seized", "bag", "sale"))))

    assert kept("no\n\n kg seized bag sale \nGanja here\n ") == ("kg seized bag sale\n\nGanja here", 3, 2)
    assert kept("nothing at all") == ("nothing at all", 1, 1) and kept("a\nb") == ("", 2, 0) and kept(None) == (None, 0, 0) and kept("") == ("", 0, 0)


def test_longest_keyword_of_repeated_texts(spark):
    rows = spark.createDataFrame([(1, "the longest Word wins"), (2, "the longest Word wins"), (3, "nothing"), (4, None), (5, "")], "id int, t string")
    words = spark.createDataFrame([("word",), ("WORD",), ("the",), ("",), (None,)], "w string")
    assert {r.id: r.keyword for r in rules.longest_keyword(rows, "t", words, "w").collect()} == {1: "word", 2: "word", 3: None, 4: None, 5: None}


def test_chunks_of_ranges(spark):
    ranges = spark.sql("SELECT * FROM VALUES ('x', DATE'2024-01-01', DATE'2024-01-12'), ('y', DATE'2024-01-02', DATE'2024-01-02'), ('z', DATE'2024-01-03', DATE'2024-01-01'), ('n', NULL, DATE'2024-01-01') t(k, a, b)")
    forward = [(r.k, r.chunk_start.day, r.chunk_end.day) for r in merge.date_chunks(ranges, "a", "b").orderBy("k", "chunk").collect()]
    assert forward == [("x", 1, 5), ("x", 5, 9), ("x", 9, 12), ("y", 2, 2)]
    back = [(r.k, r.chunk_start.day, r.chunk_end.day) for r in merge.date_chunks_backwards(ranges, "a", "b").orderBy("k", "chunk").collect()]
    assert back == [("x", 8, 12), ("x", 3, 7), ("x", 1, 2), ("y", 2, 2)]
