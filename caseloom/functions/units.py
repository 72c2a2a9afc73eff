"""Quantities: units, human-readable amounts, money in text, safe coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of units, by kind and by the factor to grams, millilitres or pieces.
UNITS = {
    ("weight", 1.0): ("g", "gm", "gms", "gram", "grams", "grm", "grms", "gr"),
    ("weight", 1000.0): ("kg", "kgs", "kilogram", "kilograms", "kilo", "kilos"),
    ("weight", 0.001): ("mg", "milligram", "milligrams"),
    ("volume", 1000.0): ("l", "ltr", "ltrs", "liter", "liters", "litre", "litres"),
    ("volume", 1.0): ("ml", "milliliter", "milliliters", "millilitre", "millilitres"),
    ("count", 1.0): ("no", "nos", "number", "numbers", "piece", "pieces", "pcs", "tablet", "tablets", "pill", "pills", "strip", "strips", "box", "boxes", "packet", "packets", "bottle", "bottles", "unit", "units", "plant", "plants", "vial", "vials", "capsule", "capsules"),
}
FORMS = {"solid": "weight", "powder": "weight", "paste": "weight", "liquid": "volume", "oil": "volume", "syrup": "volume", "tablet": "count", "pill": "count", "plant": "count"}
#: Rupees a gram above which a weight "in grams" marked "wg" is read as kilograms.
ABSURD_PRICE = 1000


def standard_quantity(quantity: Column, unit: Column, form: Column, worth: Column, sentence: Column) -> Column:
    """struct(weight_g, weight_kg, volume_ml, volume_l, count_total): one kind of measure only; an unknown unit goes by
    the form, then counts; nothing at all is a weight of 0."""
    q = F.coalesce(quantity.cast("double"), F.lit(0.0))
    u = F.regexp_replace(F.lower(F.coalesce(unit, F.lit("unknown"))), "[^a-z]", "")
    f = F.regexp_replace(F.lower(F.coalesce(form, F.lit("unknown"))), "[^a-z]", "")
    known = F.create_map(*(x for (k, y), names in UNITS.items() for n in names for x in (F.lit(n), F.struct(F.lit(k).alias("kind"), F.lit(y).alias("factor")))))
    forms = F.create_map(*(F.lit(x) for pair in FORMS.items() for x in pair))
    found = F.try_element_at(known, u)
    absurd = u.isin(*UNITS["weight", 1.0]) & (q > 0) & (worth / q > ABSURD_PRICE) & F.coalesce(F.lower(sentence).rlike("wg|w/g"), F.lit(False))
    factor = F.when(F.coalesce(absurd, F.lit(False)), 1000.0).otherwise(F.coalesce(found["factor"], F.lit(1.0)))
    kind = F.coalesce(found["kind"], F.when(q > 0, F.coalesce(F.try_element_at(forms, f), F.lit("count"))), F.lit("weight"))
    # one array element, so that the look-up is not repeated in each field
    one = F.array(F.struct(kind.alias("kind"), (q * factor).alias("base")))
    of = lambda x, k, by=1.0: F.when(x.kind == k, x.base / by)
    fields = lambda x: F.struct(of(x, "weight").alias("weight_g"), of(x, "weight", 1000).alias("weight_kg"), of(x, "volume").alias("volume_ml"), of(x, "volume", 1000).alias("volume_l"), of(x, "count").alias("count_total"))
    return F.element_at(F.transform(one, fields), 1)


def quantity_label(weight_g: Column, volume_ml: Column, count_total: Column) -> Column:
    """As people write it: Kg from 1 kg on, L from 1 l on, else g, ml or units."""
    show = lambda c, unit: F.concat(F.format_string("%.2f", c), F.lit(f" {unit}"))
    return (
        F.when(weight_g >= 1000, show(weight_g / 1000, "Kg")).when(weight_g > 0, show(weight_g, "g")).when(volume_ml >= 1000, show(volume_ml / 1000, "L"))
        .when(volume_ml > 0, show(volume_ml, "ml")).when(count_total > 0, F.concat(F.format_string("%.0f", count_total), F.lit(" Units"))).otherwise("N/A")
    )


def cm_to_feet(c: Column) -> Column:
    return F.round(c / 30.48, 2)


def money_in_text(c: Column) -> Column:
    """The first amount after Rs, INR or the rupee sign; lakh and crore are multiplied out."""
    found = F.regexp_extract(c, r"(?i)(?:rs\.?|inr|₹)\s*([\d,]+(?:\.\d+)?)", 1)
    scale = F.lower(F.regexp_extract(c, r"(?i)(?:rs\.?|inr|₹)\s*[\d,]+(?:\.\d+)?\s*(lakhs?|crores?)?", 1))
    factor = F.when(scale.startswith("lakh"), 1e5).when(scale.startswith("crore"), 1e7).otherwise(1.0)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit("")).cast("double") * factor)


def to_number(c: Column, kind: str = "decimal(18,6)") -> Column:
    """Commas and blanks are no digits; what is no number is null."""
    return F.regexp_replace(c, r"[,\s]", "").try_cast(kind)


def to_boolean(c: Column) -> Column:
    low = F.lower(F.trim(c.cast("string")))
    return F.when(low.isin("true", "t", "yes", "y", "1"), True).when(low.isin("false", "f", "no", "n", "0"), False)


def valid_age(c: Column) -> Column:
    age = c.cast("string").try_cast("int")
    return F.when(age.between(1, 120), age)
