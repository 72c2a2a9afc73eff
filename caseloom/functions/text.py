"""Text cleaning as native column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words before a name, and words that lead to a relative's name.
HONORIFICS = ("mr", "mrs", "ms", "dr", "sri", "smt", "shri", "kumari", "md", "mohd")
RELATIONS = {"s/o": "Father", "d/o": "Father", "w/o": "Husband"}
#: Labels of remarks in a full name, by how far the remark reaches.
TO_THE_END = ("r/o", "n/o", "owner of vehicle", "owner of bolero vehicle", "driver of", "crpf")
TO_THE_COMMA = ("s/o", "d/o", "w/o", "caste:")
WITH_A_NUMBER = ("cell:", "ph no:", "\u2706", "adhaar no", "h no", "h/no", "ut prisoner no")
IN_BRACKETS = ("receiver", "drug peddler")
#: Words that say nothing about which address it is.
ADDRESS_STOP_WORDS = ("india", "dist", "district", "mandal", "village", "post", "road", "street", "lane", "colony", "nagar", "near", "house", "flat", "door", "north", "south", "east", "west", "and", "the")


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def null_word_to_null(c: Column) -> Column:
    """Blank, and the word "null" in any case, are missing."""
    filled = blank_to_null(c)
    return F.when(F.lower(filled) != "null", filled)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


#: Latin letters for the names of Indic letters, vowels before consonants.
INDIC = {
    "A": "a", "AA": "aa", "I": "i", "II": "ii", "U": "u", "UU": "uu", "E": "e", "EE": "ee", "AI": "ai", "O": "o", "OO": "oo", "AU": "au",
    "KA": "k", "KHA": "kh", "GA": "g", "GHA": "gh", "NGA": "ng", "CA": "ch", "CHA": "chh", "JA": "j", "JHA": "jh", "NYA": "ny",
    "TTA": "t", "TTHA": "th", "DDA": "d", "DDHA": "dh", "NNA": "n", "TA": "t", "THA": "th", "DA": "d", "DHA": "dh", "NA": "n",
    "PA": "p", "PHA": "ph", "BA": "b", "BHA": "bh", "MA": "m", "YA": "y", "RA": "r", "LA": "l", "VA": "v",
    "SHA": "sh", "SSA": "sh", "SA": "s", "HA": "h", "LLA": "l", "RRA": "r",
}
#: Blocks of Devanagari, Telugu and Kannada.
INDIC_BLOCKS = ((0x900, 0x97F), (0xC00, 0xC7F), (0xC80, 0xCFF))


def indic_letters() -> dict[str, str]:
    """Latin letters by character: by the last part of its name; a sign that is neither letter nor vowel is a blank, one
    that has no Latin letters, and the sign that ends a vowel, are left out."""
    out = {}
    for first, last in INDIC_BLOCKS:
        for ch in map(chr, range(first, last + 1)):
            kind, found, token = unicodedata.name(ch, "").partition("VOWEL SIGN ")
            if not found:
                kind, found, token = unicodedata.name(ch, "").partition("LETTER ")
            if kind:
                out[ch] = INDIC.get(token, "") if found else "" if kind.endswith("SIGN VIRAMA") else " "
    return out


def latin(c: Column) -> Column:
    """Indic letters as Latin ones, about; texts of other letters as they are, and texts that nothing would be left of."""
    table = F.create_map(*(F.lit(x) for pair in indic_letters().items() for x in pair))
    letters = F.transform(F.regexp_extract_all(c, F.lit(r"(?s)(.)"), 1), lambda ch: F.coalesce(F.try_element_at(table, ch), ch))
    written = F.array_join(letters, "")
    indic = c.rlike("[" + "".join(f"\\x{{{a:x}}}-\\x{{{z:x}}}" for a, z in INDIC_BLOCKS) + "]")
    return F.when(indic & (F.trim(written) != ""), written).otherwise(c)


def normal_name(c: Column) -> Column:
    """Lower-case letters and digits of a name, without titles, relatives and what follows an @."""
    plain = F.substring_index(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\b[sdwh]\s*/\s*o\b", " "), "@", 1)
    plain = F.regexp_replace(plain, rf"\b(?:{'|'.join(HONORIFICS)})\b\.?", " ")
    return squeeze(F.regexp_replace(plain, r"[^a-z0-9\s]", " "))


def _label(text: str) -> str:
    """A label as people write it: with dots or blanks between its words, dots behind it, a colon with blanks."""
    words = [re.escape(w.rstrip(":")) for w in text.split()]
    return r"(?<![A-Za-z])" + r"\.?\s*".join(words) + (r"\.?\s*:" if text.endswith(":") else r"(?![A-Za-z])\.?")


def _any(labels: tuple[str, ...]) -> str:
    return "(?:" + "|".join(map(_label, labels)) + ")"


#: Remarks by what they are about.
NAME_REMARKS = {
    "status": r"\(?\s*absconding\s*\)?",
    "person in custody": r"under\s+trial\s+prisoner[^,]*,",
    "role in brackets": rf"\([^)]*{_any(IN_BRACKETS)}[^)]*\)",
    "number": rf"[\s,(]*{_any(WITH_A_NUMBER)}[\s:]*\d[\d\s-]*\)?",
    "age": r"[\s,]*(?:\bage\b[.:\s]*)?\d+\s*yrs?\b\.?",
    "relation or caste": rf"[\s,]*{_any(TO_THE_COMMA)}\s*[^,]+",
    "residence, vehicle or force": rf"[\s,]*{_any(TO_THE_END)}.*$",
    "number in the case": r"^\s*a-?\d+[).\s]+",
    "others": r"\s+and\s+others\s*$",
    "empty brackets": r"\(\s*\)",
}


def without_remarks(c: Column, *kinds: str) -> Column:
    """A name without the remarks of some kinds (of all, if none is named)."""
    return reduce(lambda x, kind: F.regexp_replace(x, f"(?is){NAME_REMARKS[kind]}", " "), kinds or NAME_REMARKS, c)


def clean_full_name(c: Column) -> Column:
    """A full name without aliases, remarks and punctuation at its ends; the original where fewer than two characters are
    left."""
    cleaned = F.trim(F.regexp_replace(squeeze(without_remarks(F.substring_index(c, "@", 1))), r"^[,.\s]+|[,.\s]+$", ""))
    return F.when(F.length(cleaned) >= 2, cleaned).otherwise(c)


def full_name(name: Column, surname: Column, alias: Column) -> Column:
    return F.concat_ws(" ", blank_to_null(name), blank_to_null(surname), F.concat(F.lit("@ "), blank_to_null(alias)))


def alias_of(c: Column) -> Column:
    """What follows the first @."""
    return F.when(F.instr(c, "@") > 0, blank_to_null(F.regexp_extract(c, r"@\s*([^@,]+)", 1)))


def relation_of(c: Column) -> Column:
    """struct(relation, relative) of a name like "x s/o y"."""
    mark = F.lower(F.regexp_replace(F.regexp_extract(c, r"(?i)\b([sdw]\s*/\s*o)\b", 1), r"\s", ""))
    relation = reduce(lambda w, kv: w.when(mark == kv[0], kv[1]), list(RELATIONS.items())[1:], F.when(mark == "s/o", RELATIONS["s/o"]))
    return F.struct(relation.alias("relation"), blank_to_null(F.regexp_extract(c, r"(?i)\b[sdw]\s*/\s*o\b\.?\s*([^,@(]+)", 1)).alias("relative"))


def name_key(c: Column) -> Column:
    """The same for all orders of a name's words; a single word stays as it is."""
    words = F.split(normal_name(c), " ")
    return F.array_join(F.array_sort(words), " ")


def once(c: Column, f) -> Column:
    """f of a value that is computed once, though f names it several times."""
    return F.element_at(F.transform(F.array(c), f), 1)


#: A character that texts hardly hold.
_CUT = "\u0001"


def cut(c: Column, pattern: str) -> Column:
    """F.split, but for a pattern that is compiled once and not once a text; no empty piece comes first."""
    return F.when(F.contains(c, F.lit(_CUT)), F.split(c, pattern)).otherwise(F.split(F.ltrim(F.regexp_replace(c, pattern, _CUT), F.lit(_CUT)), _CUT))


def person_code(c: Column) -> Column:
    """A1, A-1, a.01 -> A-1."""
    number = F.regexp_extract(c, r"(?i)A\s*[-.]?\s*(\d+)", 1)
    return F.when(number != "", F.concat(F.lit("A-"), number.cast("long").cast("string")))


#: A person's code in a text.
CODE = r"(?i:\bA\s*[-.]?\s*(\d+)\b)"


def person_codes(c: Column) -> Column:
    """All codes in a text, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(CODE), 1), lambda n: F.concat(F.lit("A-"), n.cast("long").cast("string"))))


def phone_digits(c: Column) -> Column:
    """The last ten digits."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")
    return F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits)


def phone_list(c: Column) -> Column:
    """Distinct ten-digit numbers of a text, joined by ", "; null without any."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(\d{10})"), 1))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def address(*parts: Column) -> Column:
    return F.concat_ws(", ", *(blank_to_null(p) for p in parts))


def address_tokens(c: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z0-9]+)"), 1))
    stop = F.array(*map(F.lit, ADDRESS_STOP_WORDS))
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.rlike(r"^\d+$") & ~F.array_contains(stop, w))


def title_case(c: Column, acronyms: tuple[str, ...] = ()) -> Column:
    keep = F.array(*map(F.lit, acronyms)) if acronyms else F.array().cast("array<string>")
    return F.array_join(F.transform(F.split(squeeze(c), " "), lambda w: F.when(F.array_contains(keep, F.upper(w)), F.upper(w)).otherwise(F.initcap(w))), " ")


def near(text: Column, name: Column, pattern: str, chars: int) -> Column:
    """Whether pattern is found within so many characters around the first mention of name."""
    at = F.position(F.lower(name), F.lower(text))
    window = F.substring(F.lower(text), F.greatest(at - chars, F.lit(1)), F.length(name) + F.lit(2 * chars))
    return (at > 0) & window.rlike(pattern)


def extension(path: Column) -> Column:
    """The file extension before a query string or fragment, lower-case; null without one."""
    return blank_to_null(F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9_-]+)(?:\?|#|$)", 1)))


def with_extension(url: Column, ext: Column) -> Column:
    """ext put before the query string of url, unless it ends so already."""
    head, tail = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    return F.when(F.endswith(F.lower(head), F.concat(F.lit("."), F.lower(ext))), url).otherwise(F.concat(head, F.lit("."), ext, tail))


def file_path(source: Column, parent: Column, file_id: Column, folders: dict[str, str]) -> Column:
    """folder of the source / parent / file id; null where the source or the file is unknown."""
    folder = reduce(lambda w, kv: w.when(source == kv[0], kv[1]), list(folders.items())[1:], F.when(source == next(iter(folders)), next(iter(folders.values()))))
    return F.when(file_id.isNotNull() & folder.isNotNull(), F.concat_ws("/", folder, parent, file_id))


def valid_person_name(c: Column, placeholders: tuple[str, ...] = ("unknown", "na", "n/a", "none", "null", "nil")) -> Column:
    """At least two letters, letters at least 35 % of what is not blank, and no placeholder."""
    plain = F.lower(squeeze(c))
    letters = F.length(F.regexp_replace(plain, r"[^a-z]", ""))
    return F.coalesce((letters >= 2) & (letters >= 0.35 * F.length(F.replace(plain, F.lit(" "), F.lit("")))) & ~plain.isin(*placeholders), F.lit(False))


def relevant_sections(text: Column, boundary: str, first: tuple[str, ...], patterns: tuple[str, ...], second: tuple[str, ...], least: int = 50) -> Column:
    """struct(kept_text, sections, kept): a text's sections (cut before each `boundary`, blank ones left out) whose relevance is
    `least` or more, joined by a blank line. A text of one section is kept as it is; none may be left of several."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), f"(?={boundary})"), lambda s: s.rlike(r"\S"))
    kept = F.filter(parts, lambda s: relevance(s, first, patterns, second) >= least)
    joined = F.array_join(F.transform(kept, lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), "\n\n")
    one = F.size(parts) <= 1
    return F.struct(F.when(one, text).otherwise(joined).alias("kept_text"), F.size(parts).alias("sections"), F.when(one, F.size(parts)).otherwise(F.size(kept)).alias("kept"))


def relevance(text: Column, first: tuple[str, ...], patterns: tuple[str, ...], second: tuple[str, ...]) -> Column:
    """100 for any first-tier word, 80 for any pattern, 15 for each second-tier word that occurs."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hit = lambda *words: low.rlike(rf"(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?:$|[^\p{{L}}\p{{N}}_])")
    score = F.when(hit(*first), 100).otherwise(0) + F.when(low.rlike("|".join(patterns)), 80).otherwise(0)
    return reduce(lambda s, w: s + F.when(hit(w), 15).otherwise(0), second, score)
