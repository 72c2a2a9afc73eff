"""From what a text tells of people to rows of a case, by what the case's table knows already.

Three pipelines and a union: A, where the table knows who its people are, only fills gaps (`enrich.with_provenance`); B, where it
has stubs without a person, pairs extracted people to stubs by the code that stands near their name; C, without any
stub, gives people an id of their own. What failed or found nothing leaves a row that says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested
from ..functions import text as T
from ..shared import checkpointed
from .identity import NAMESPACE

FAILED, NOBODY = "LLM_EXTRACTION_FAILED", "NO_ACCUSED_IN_TEXT"
#: How near a code stands to a name, in characters.
NEAR = 30
_CODE = r"(?i)(A[-.\s]?\d+)"


def plain_code(c: Column) -> Column:
    """"A - 1", "a.1" and "A1" are one code."""
    return F.upper(F.regexp_replace(c, r"[-.\s]", ""))


def synthetic_id(case: Column, name: Column, seq: Column) -> Column:
    """The same for the same case, name and number."""
    low = lambda c: F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    return nested.uuid5(NAMESPACE, F.concat_ws("|", case.cast("string"), low(name), low(seq)))


def codes_near(text: Column, name: Column, reach: int = NEAR) -> Column:
    """Plain codes within so many characters of a name's first mention, in order. A name that the text does not hold is looked
    up by its first words, as many as the text holds; none without any."""
    words = F.split(F.lower(F.trim(name)), r"\s+")
    starts = F.transform(F.reverse(F.sequence(F.lit(1), F.size(words))), lambda n: F.array_join(F.slice(words, 1, n), " "))

    def near(low: Column, held: Column) -> Column:
        window = lambda at: F.substring(text, F.greatest(at - reach, F.lit(1)), F.least(at - 1, F.lit(reach)) + F.length(held) + reach)
        return F.when(held.isNotNull(), T.once(F.position(held, low), lambda at: F.transform(F.regexp_extract_all(window(at), F.lit(_CODE), 1), plain_code)))

    # what is bound is made once, not wherever it stands
    return T.once(F.lower(text), lambda low: T.once(F.try_element_at(F.filter(starts, lambda s: (s != "") & F.contains(low, s)), F.lit(1)), lambda held: near(low, held)))


def _best(extracted: DataFrame, texts: DataFrame, stubs: DataFrame, case: str, name: str, text: str, stub: str, code: str) -> DataFrame:
    """case, name, _s (stub, code): names that are paired. A case's text moves once, to all its names."""
    named = extracted.select(case, name).where(F.col(name).isNotNull()).groupBy(case).agg(F.collect_set(name).alias("_names"))
    near = texts.join(named, case).select(case, F.explode(F.transform("_names", lambda n: F.struct(n.alias("n"), codes_near(F.col(text), n).alias("codes")))).alias("x"))
    each = near.select(case, F.col("x.n").alias(name), F.posexplode("x.codes").alias("_at", "_plain"))
    own = stubs.groupBy(case, plain_code(F.col(code)).alias("_plain")).agg(F.min(F.struct(F.col(stub).alias("stub"), F.col(code).alias("code"))).alias("_s"))
    return each.join(own, [case, "_plain"]).groupBy(case, name).agg(F.min_by("_s", "_at").alias("_s"))


def assembled(cases: DataFrame, extracted: DataFrame, stubs: DataFrame, case: str, name: str, seq: str, text: str, state: str, stub: str, code: str, stub_name: str, person: str) -> DataFrame:
    """The rows of branches B and C: case, branch, accused_id, person_code, full_name, role, source.

    cases has a text and the state of its extraction per case ("failed", else it ran); extracted its people (case, name, seq);
    stubs what the table has (id, code, name, and a person id where it knows one: such cases are branch A and have no rows
    here). source says where an id comes from: paired (a stub's, by a code near the name), unmatched (synthetic beside
    stubs), stub (a stub that no extracted person was paired with: a row of its own), text (synthetic, without stubs). A failed extraction
    leaves one row with the role FAILED, one without people a row with the role NOBODY, unless stubs stand in."""
    kinds = stubs.groupBy(case).agg(F.max(F.col(person).isNotNull()).alias("_known"))
    branch = F.when(F.col("_known"), "A").when(F.col("_known").isNotNull(), "B").otherwise("C")
    own = cases.join(kinds, case, "left").withColumn("branch", branch).drop("_known").where("branch <> 'A'")
    own = own.select(case, "branch", (F.coalesce(F.col(state), F.lit("")) == "failed").alias("_failed"), text)
    # only a case of B that did not fail has anybody to pair: its pairs are kept, for its rows and for its other stubs
    asked = own.where("branch = 'B' AND NOT _failed")
    best = checkpointed(_best(extracted.join(asked.select(case), case, "left_semi"), asked, stubs, case, name, text, stub, code))
    heads, people = own.drop(text), extracted.select(case, name, seq, F.lit(True).alias("_told"))
    # a case with nobody, or that failed, has one row without a person
    some = heads.join(people.withColumnRenamed(case, "_case"), (F.col(case) == F.col("_case")) & ~F.col("_failed"), "left").drop("_case").join(best, [case, name], "left")
    some = some.where("_told OR _failed OR branch = 'C'")  # a case of B has stubs in its place
    found, told, nothing = F.col("_s").isNotNull(), F.col("_told").isNotNull(), F.lit(None).cast("string")
    rows = some.select(
        case, "branch", F.when(found, F.col("_s.stub").cast("string")).when(told, synthetic_id(F.col(case), F.col(name), F.col(seq))).alias("accused_id"), F.col("_s.code").alias("person_code"), F.col(name).alias("full_name"),
        F.when(F.col("_failed"), FAILED).when(~told, NOBODY).alias("role"), F.when(found, "paired").when(~told, nothing).when(F.col("branch") == "B", "unmatched").otherwise("text").alias("source"),
    )
    left = stubs.join(heads.where("branch = 'B' AND NOT _failed").select(case), case, "left_semi").join(best.select(case, F.col("_s.stub").alias(stub)).distinct(), [case, stub], "left_anti")
    shown = F.coalesce(T.blank_to_null(F.col(stub_name)), T.blank_to_null(F.col(code)), F.lit("Unknown"))
    filled = left.select(case, F.lit("B").alias("branch"), F.col(stub).cast("string").alias("accused_id"), F.col(code).alias("person_code"), shown.alias("full_name"), nothing.alias("role"), F.lit("stub").alias("source"))
    return rows.unionByName(filled)
