"""Similarities of names and texts, natively where Spark has the parts, else in Arrow batches."""

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def trigrams(c: Column) -> Column:
    """Distinct three-letter parts of the words, each padded by two blanks before and one behind."""
    words = F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    return both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1))


def dice(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) * 2.0 / F.greatest(F.size(a) + F.size(b), F.lit(1))


def trigram_similarity(a: Column, b: Column) -> Column:
    return jaccard(trigrams(a), trigrams(b))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))


def soundex_or_zero(c: Column) -> Column:
    return F.when(c == "", "0000").otherwise(F.soundex(c))


def sound_overlap(a: Column, b: Column, codes_a: Column | None = None, codes_b: Column | None = None) -> Column:
    """Dice of the Soundex codes of two names' words (given, or found here); 0.2 where short names differ in one consonant only."""
    codes = lambda c: F.array_distinct(F.transform(words(c), soundex_or_zero))
    plain = dice(codes(a) if codes_a is None else codes_a, codes(b) if codes_b is None else codes_b)
    # one differing letter of equally long names: the letters where they differ
    differing = F.filter(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    letter = lambda c: F.substring(c, F.try_element_at(differing, F.lit(1)), F.lit(1))
    swap = (F.length(a) < 8) & (F.length(b) < 8) & (F.length(a) == F.length(b)) & (F.levenshtein(a, b) == 1) & letter(a).rlike("[b-df-hj-np-tv-z]") & letter(b).rlike("[b-df-hj-np-tv-z]")
    return F.when(F.coalesce((plain == 1) & swap, F.lit(False)), F.lit(0.2)).otherwise(plain)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: F.pow(p.cast("double") - q.cast("double"), F.lit(2))), F.lit(0.0), lambda s, v: s + v))


def _jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity with up to four letters of common prefix at weight 0.1, from a Jaro of 0.7 on."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, pairs = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                pairs.append(i)
                break
    m = len(pairs)
    if not m:
        return 0.0
    other = [y for y, t in zip(b, taken, strict=True) if t]
    swapped = sum(a[i] != y for i, y in zip(pairs, other, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_jaro_winkler(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching blocks (difflib's ratio)."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _common_letters(a: list[str], b: list[str]) -> list[int]:
    """Length of the longest common subsequence of each pair, bit by bit: a bit per letter of one text, a step per letter of
    the other, for all pairs of up to 64 letters at once; longer ones take Python's integers."""
    out = [0] * len(a)
    short = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and len(x) <= 64]
    if short:
        wide, long = max(len(a[i]) for i in short), max(len(b[i]) for i in short)
        codes = lambda texts, n, fill: np.array([[*map(ord, t), *[fill] * (n - len(t))] for t in texts], "i8")
        x, y = codes((a[i] for i in short), wide, -1), codes((b[i] for i in short), long, -2)
        bit, left = np.uint64(1) << np.arange(wide, dtype="u8"), np.full(len(short), 2**64 - 1, "u8")
        for j in range(long):
            here = left & np.where(x == y[:, j, None], bit, np.uint64(0)).sum(1, dtype="u8")
            left = (left + here) | (left - here)
        size = np.array([len(a[i]) for i in short], "u8")
        mask = np.where(size == 64, np.uint64(2**64 - 1), (np.uint64(1) << (size % np.uint64(64))) - np.uint64(1))
        for i, n in zip(short, np.bitwise_count(~left & mask).tolist(), strict=True):
            out[i] = n
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if len(x) > 64 and y:
            at: dict[str, int] = {}
            for k, c in enumerate(x):
                at[c] = at.get(c, 0) | 1 << k
            left, full = (1 << len(x)) - 1, (1 << len(x)) - 1
            for c in y:
                here = left & at.get(c, 0)
                left = ((left + here) | (left - here)) & full
            out[i] = (full & ~left).bit_count()
    return out


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the longest common subsequence over both lengths: 1 for equal texts (and for two empty ones)."""
    x, y = ([t or "" for t in c] for c in (a, b))
    return pd.Series([2 * n / (len(s) + len(t)) if s or t else 1.0 for n, s, t in zip(_common_letters(x, y), x, y, strict=True)], dtype="float64")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """The ratio of the texts with their words sorted."""
    ordered = lambda c: F.array_join(F.array_sort(F.filter(F.split(c, " "), lambda w: w != "")), " ")
    return indel_ratio(ordered(a), ordered(b))


@F.pandas_udf(StringType())
def strip_accents(c: pd.Series) -> pd.Series:
    """Compatibility form without diacritics."""
    import unicodedata

    return c.map(lambda x: None if x is None else "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch)))


@functools.lru_cache(1 << 16)
def alike(a: str, b: str, least: float) -> bool:
    """Whether the Jaro-Winkler similarity or the share of matching blocks reaches `least`; the bounds of the share decide first."""
    from difflib import SequenceMatcher

    if a == b or _jaro_winkler(a, b) >= least:
        return True
    share = SequenceMatcher(None, a, b)
    return share.real_quick_ratio() >= least and share.quick_ratio() >= least and share.ratio() >= least


@functools.lru_cache(1 << 16)
def _name_similarity(a: str, b: str) -> float:
    from difflib import SequenceMatcher

    if a == b:
        return 1.0
    likeness, share = _jaro_winkler(a, b), SequenceMatcher(None, a, b)
    return max(likeness, share.ratio()) if share.real_quick_ratio() > likeness and share.quick_ratio() > likeness else likeness


@F.pandas_udf(DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """The greater of Jaro-Winkler similarity and share of matching blocks; the share is found only where its bounds let it be that."""
    return pd.Series([_name_similarity(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


def ensemble(a: Column, b: Column) -> Column:
    """.25 edit distance, .25 ratio of sorted words, .20 overlap of words, .15 Jaccard and .15 Dice of words."""
    x, y = words(a), words(b)
    overlap = F.size(F.array_intersect(x, y)) / F.greatest(F.least(F.size(x), F.size(y)), F.lit(1))
    return 0.25 * levenshtein_similarity(a, b) + 0.25 * token_sort_ratio(a, b) + 0.20 * overlap + 0.15 * jaccard(x, y) + 0.15 * dice(x, y)
