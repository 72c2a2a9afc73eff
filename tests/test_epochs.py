"""Identities in the order in which records came, against a plain loop over the same scores."""

from datetime import date

from pyspark.sql import functions as F

from caseloom.functions.phonetics import double_metaphone
from caseloom.operators import identity

PERSON = "struct<name: string, alias: string, age: int, gender: string, phones: array<string>, address: string, station: string, offence: array<string>, associates: array<string>>"


def test_epochs_against_a_loop(spark):
    def person(name, age=30, phone=None, station="s1"):
        return (name, "", age, "Male", [phone] if phone else [], "12 mill road", station, ["theft"], [])

    rows = [
        (1, "c1", None, date(2020, 2, 1), person("Raju Kumar", 30, "8000000001")), (2, "c2", None, date(2021, 3, 1), person("Raju Kumaar", 31, "8000000001")), (3, "c3", None, date(2021, 4, 1), person("Kumar Raju", 31)), (4, "c4", "acc", date(2020, 5, 1), person("Sita Devi", 25)),
        (5, "c5", "acc", date(2021, 6, 1), person("Seetha", 26)), (6, "c6", None, date(2022, 7, 1), person("Unknown person")), (7, "c7", None, date(2022, 8, 1), person("Raju Kumar", 32, "8000000001", "s2")), (8, "c8", None, date(2025, 8, 1), person("Raju Kumar", 35, None, "s3")),
        (9, "c9", None, None, person("Raju Kumar", 30, "8000000001", "s4")), (10, "c10", None, date(2022, 9, 1), person("Roju Kamar", 60, None, "s5")), (11, "c1", None, date(2021, 2, 1), person("Raju Kumar", 30, None, "s6")),
    ]
    schema = f"record_id long, case_id string, accused_id string, day date, p {PERSON}"
    df = spark.createDataFrame(rows, schema)
    got = {r.record_id: (r.canonical_person_id, r.tier) for r in identity.resolve_in_epochs(df).collect()}
    again = {r.record_id: (r.canonical_person_id, r.tier) for r in identity.resolve_in_epochs(spark.createDataFrame(rows[::-1], schema).repartition(7)).collect()}
    assert got == again

    x, y = df.select(F.col("record_id").alias("i"), F.col("p").alias("a")), df.select(F.col("record_id").alias("j"), F.col("p").alias("b"))
    score = {(r.i, r.j): r.score for r in identity.match_score(identity.evidence(x.crossJoin(y))).collect()}
    own = {r.record_id: (r.c, r.s, r.h) for r in df.select("record_id", identity.canonical_id(F.col("p.name"), F.col("p.gender"), F.col("p.station")).alias("c"), F.soundex("p.name").alias("s"), identity.is_placeholder(F.col("p.name")).alias("h")).collect()}
    window = lambda d: -1 if d is None else (d - date(1970, 1, 1)).days // 365
    resolved, plain = {}, {}
    for w in sorted({window(r[3]) for r in rows}):
        now = {}
        for i, case, accused, day, p in (r for r in rows if window(r[3]) == w):
            alike = [
                j for j, c, _, d, q in rows
                if j in resolved and day and d and d <= day and d >= day.replace(year=day.year - 2) and c != case and not own[j][2] and (own[i][1] == own[j][1] or double_metaphone(p[0])[0] == double_metaphone(q[0])[0])
            ]
            ids = [resolved[j] for j, _, a, _, _ in rows if j in resolved and accused and a == accused]
            best = max(((score[i, j], resolved[j]) for j in alike), default=(None, None))
            if own[i][2]:
                now[i] = (None, 3)
            elif ids:
                now[i] = (min(ids), 0)
            elif best[0] is not None and best[0] >= identity.ADOPT:
                now[i] = (best[1], 1)
            else:
                now[i] = (own[i][0], 2 if best[0] is not None and best[0] >= identity.REVIEW else 3)
        plain |= now
        resolved |= {i: c or got[i][0] for i, (c, _) in now.items()}
    assert {i: (c if i != 6 else None, t) for i, (c, t) in got.items()} == plain
    assert got[2] == (got[1][0], 1) and got[7][1] == 1 and got[5] == (got[4][0], 0) and got[8][1] == 3 and len({got[i][0] for i in (6, 8, 9)}) == 3
    assert identity.resolve_in_epochs(df.limit(0)).count() == 0


def test_the_best_of_many_candidates_is_not_the_latest(spark):
    """More than 200 later candidates sound alike; the same person, with the same phone, came before all of them."""
    made = lambda i, name, phone, day, case: (i, case, None, day, (name, "", 30, "Male", [phone] if phone else [], "12 mill road", "s1", ["theft"], []))
    rows = [made(0, "Raju Kumar", "8000000001", date(2020, 1, 1), "c0"), *(made(i, "Rajiv Kamr", None, date(2020, 2, 1), f"c{i}") for i in range(1, 301)), made(999, "Raju Kumar", "8000000001", date(2021, 1, 15), "c999")]
    df = spark.createDataFrame(rows, f"record_id long, case_id string, accused_id string, day date, p {PERSON}")
    got = {r.record_id: r for r in identity.resolve_in_epochs(df).collect()}
    assert got[999].tier == 1 and got[999].match_score == 1.0 and got[999].canonical_person_id == got[0].canonical_person_id


def test_likeliest_against_all_pairs(spark):
    """All of the highest scores among a person's candidates, over names, sets and gaps of many kinds."""
    import random

    r = random.Random(5)
    some = lambda values, most: r.sample(values, r.randint(0, most))
    names = ["Raju Kumar", "Kumar Raju", "Raju Kumaar", "Rajiv Kumr", "Ram", "Rom", "Rum", "Mr Ram Kumar s/o Shyam", "", "!!", "Kumar", "Rajendra Prasad Singh", "Rajender Singh", None]
    person = lambda: (r.choice(names), r.choice(["", "Ram", "Raju", None]), r.choice([0, 20, 21, 29, 40, None]), r.choice(["Male", "male", "F", None]), some(["8000000001", "8000000002", "123"], 2), r.choice(["12 mill road near temple", "temple gate", None]), r.choice(["s1", "s2", None]), some(["theft", "fraud"], 2), some(["x", "y"], 1))
    rows = [(i, person(), f"c{r.randrange(20)}", r.randrange(100)) for i in range(120)]
    df = spark.createDataFrame(rows, f"i long, p {PERSON}, case string, at long")
    keys = F.array(F.struct(F.lit("k").alias("k")))
    asked = df.select(F.col("i").alias("_a"), F.col("p").alias("a"), F.col("case").alias("_case"), (F.col("at") - 50).alias("_from"), (F.col("at") - 1).alias("_until"), keys.alias("keys"))
    known = df.select(F.col("i").alias("_b"), F.col("p").alias("b"), F.col("case").alias("_case"), F.col("at").alias("_at"), keys.alias("keys"))
    pairs = asked.withColumnRenamed("_case", "x").join(known.withColumnRenamed("_case", "y"), (F.col("x") != F.col("y")) & F.col("_at").between(F.col("_from"), F.col("_until")))
    scores = {(p._a, p._b): p.score for p in identity.match_score(identity.evidence(pairs), common=("kumar",)).collect()}
    best = {}
    for (a, _), s in scores.items():
        best[a] = max(best.get(a, 0.0), s)
    got = {(p._a, p._b): p.score for p in identity.likeliest(asked, known, ("kumar",)).collect()}
    assert got == {p: s for p, s in scores.items() if s == best[p[0]]}
    least = {(p._a, p._b): p.score for p in identity.likeliest(asked, known, ("kumar",), 0.7).collect()}
    assert {p for p, s in least.items() if s >= 0.7} == {p for p, s in got.items() if s >= 0.7} and {p[0]: s for p, s in least.items()} == best


def test_match_scores_of_few_pairs(spark, monkeypatch):
    """All pairs of a key were scored and dealt with both people; now only what can be the best is."""
    from caseloom.plans import registry

    made, evidence = [], identity.evidence
    monkeypatch.setattr(identity, "evidence", lambda pairs: made.append(pairs) or evidence(pairs))
    rows = registry.QUERIES["match_scores"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 300 and made[0].count() < 1.2 * len(rows)
