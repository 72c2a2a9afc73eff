"""The best partners of a person among all that share a key, without scoring most of them.

Spark deals both sides by key, common keys in pieces; within a piece everything of a score but the likeness of names is
found for all pairs at once from arrays, the likeness is bounded from above, and partners are scored in the order of their
bounds until no other one can reach the best. None is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd

from ..functions import similarity

#: Letters that count as one: what one name has of a group and another one lacks is a letter without a partner.
LETTERS = {c: i for i, group in enumerate((*"aeiourntlshmdkbg", "cp", "fvw", "jy", "qxz0123456789", " ")) for c in group}
#: How many partners are scored at once, at first; each later step takes four times as many.
STEP = 2
CONSONANTS = set("bcdfghjklmnpqrstvwxyz")


class _Shared:
    """How many values of a list each of the known people's lists holds."""

    def __init__(self, lists: list[Iterable]) -> None:
        at: dict[object, list[int]] = {}
        for i, values in enumerate(lists):
            for v in set(values):
                at.setdefault(v, []).append(i)
        self.n, self.sizes = len(lists), np.array([len(set(x)) for x in lists], "f8")
        self.at = {v: np.array(i) if len(i) * 8 < len(lists) else np.bincount(i, minlength=len(lists)).astype("f8") for v, i in at.items()}

    def count(self, values: Iterable) -> np.ndarray:
        out = np.zeros(self.n)
        for v in set(values):
            i = self.at.get(v)
            if i is not None and i.dtype.kind == "f":
                out += i
            elif i is not None:
                out[i] += 1
        return out


def _letters(names: list[str]) -> np.ndarray:
    """Up to three bits per group of letters, by how many of them a name has."""
    out = np.zeros(len(names), "u8")
    for k, name in enumerate(names):
        held: dict[int, int] = {}
        for c in name:
            if (g := LETTERS.get(c)) is not None:
                held[g] = held.get(g, 0) + 1
        out[k] = sum(((1 << min(n, 3)) - 1) << 3 * g for g, n in held.items())
    return out


def _starts(names: list[str]) -> np.ndarray:
    """The first four letters of each text, a row per letter."""
    return np.array([[ord(c) for c in n[:4]] + [0] * (4 - min(len(n), 4)) for n in names], "i8").reshape(-1, 4).T


class _Texts:
    """Texts by what bounds how alike another one is to each of them: at most the letters that both have are matched."""

    def __init__(self, texts: list[str]) -> None:
        self.letters, self.lengths, self.starts = _letters(texts), np.array([max(len(t), 1) for t in texts], "f8"), _starts(texts)

    def most(self, text: str, at) -> np.ndarray:
        """What Jaro-Winkler similarity and share of matching blocks cannot exceed."""
        mine, n, letters, lengths = _letters([text])[0], max(len(text), 1), self.letters[at], self.lengths[at]
        matched = np.minimum(n - np.bitwise_count(mine & ~letters), lengths - np.bitwise_count(letters & ~mine))
        jaro = (matched / n + matched / lengths + 1) / 3
        prefix, equal = np.zeros(jaro.size), np.ones(jaro.size, bool)
        for k, c in enumerate(text[:4]):
            equal = equal & (self.starts[k][at] == ord(c))
            prefix += equal
        return np.maximum(jaro + prefix * 0.1 * (1 - jaro), 2 * matched / (n + lengths))


class _Alike:
    """Which of the known people's lists of words may hold one that is alike to a given word."""

    def __init__(self, lists: list[list[str]]) -> None:
        distinct = {w: i for i, w in enumerate(sorted({w for x in lists for w in x}))}
        self.texts, self.n, self.filled = _Texts(list(distinct)), len(lists), np.array([bool(x) for x in lists])
        self.words = np.array([distinct[w] for x in lists for w in x], "i8")
        self.begins = np.cumsum([0, *(len(x) for x in lists if x)])[:-1]
        self.known: dict[str, np.ndarray] = {}

    def may(self, word: str) -> np.ndarray:
        if word not in self.known:
            out = np.zeros(self.n)
            if self.words.size:
                out[self.filled] = np.maximum.reduceat((self.texts.most(word, slice(None)) >= 0.85 - 1e-9)[self.words], self.begins)
            if len(self.known) >= 100:
                self.known.clear()
            self.known[word] = out
        return self.known[word]


def _swapped(a: str, b: str) -> bool:
    """Whether two short names differ in one consonant only, as in `similarity.sound_overlap`."""
    differing = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
    return len(a) == len(b) < 8 and len(differing) == 1 and all(c in CONSONANTS for c in differing[0])


def _list(v) -> list:
    """The values of an array that can be equal to others: nulls are not."""
    return [] if v is None else [x for x in v if x is not None]


def search(weighed: Callable, common: tuple[str, ...], ties_from: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """A function for cogrouped people: _a, _b of the best scores of a piece. weighed: `identity._weighed` over arrays."""
    known_words = set(common)
    odd = lambda words: [w for w in words if w not in known_words]

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"_a": [], "_b": []})
        right = right.sort_values("_at", kind="stable")
        people, days, cases = right["b"].tolist(), right["_at"].to_numpy(), right["_case"].to_numpy()
        of = lambda f: [p[f] for p in people]
        names, words = of("_n"), [_list(x) for x in of("_words")]
        texts, likewise = _Texts(names), _Alike(words)
        shared = {f: _Shared([_list(x) for x in of(f)]) for f in ("_words", "_codes", "_tokens", "_phones", "offence", "associates")}
        odds = _Shared([odd(x) for x in words])
        ages = np.array([p["age"] or 0 for p in people], "f8")
        genders, stations = (pd.Series([None if v is None else f(v) for v in of(c)], dtype="object").to_numpy() for c, f in (("gender", str.lower), ("station", str)))
        aliases, aliased = np.array(of("_alias"), "object"), np.array([bool(p["alias"]) for p in people])
        named = np.array([bool(p["name"]) for p in people])
        out: list[tuple] = []

        for me, p, since, until, case in zip(left["_a"], left["a"], left["_from"], left["_until"], left["_case"], strict=True):
            lo, hi = np.searchsorted(days, since, "left"), np.searchsorted(days, until, "right")
            near = np.arange(lo, hi)[cases[lo:hi] != case]
            if not near.size:
                continue
            n, mine_odd, all_words = p["_n"], odd(p["_words"]), len(p["_words"])
            with_word, with_odd, with_code, with_token = (s.count(_list(v))[near] for s, v in ((shared["_words"], p["_words"]), (odds, mine_odd), (shared["_codes"], p["_codes"]), (shared["_tokens"], p["_tokens"])))
            total = np.maximum(shared["_words"].sizes[near] + all_words, 1)
            plain = with_word * 2.0 / total
            single = (all_words == 1) & (shared["_words"].sizes[near] == 1) & (plain == 0)
            age, other = float(p["age"] or 0), ages[near]
            apart = np.abs(age - other)
            gender = None if p["gender"] is None else p["gender"].lower()
            same_gender = np.array(genders[near] == gender, bool) & (gender is not None)
            same_age = (age == other) & (age > 0)
            e = {
                "sound": with_code * 2.0 / np.maximum(shared["_codes"].sizes[near] + len(p["_codes"]), 1), "address": with_token / np.maximum(shared["_tokens"].sizes[near] + len(p["_tokens"]) - with_token, 1),
                "age": np.where((age == 0) & (other == 0), 0.0, np.where((age == 0) | (other == 0), 0.3, np.where(apart <= 2, 0.8, np.where(apart >= 10, 0.0, 0.8 - (apart - 2) * 0.1)))), "alias": np.where((aliases[near] == p["_alias"]) & bool(p["alias"]), 1.0, 0.0),
                "phone": np.where(shared["_phones"].count(_list(p["_phones"]))[near] > 0, 1.0, 0.0), "same_station": np.array(stations[near] == p["station"], bool) & (p["station"] is not None), "same_gender": same_gender,
                "same_offence": shared["offence"].count(_list(p["offence"]))[near] > 0, "shared_associates": shared["associates"].count(_list(p["associates"]))[near] > 0,
            }
            asks, answers = bool(p["name"]) & aliased[near], bool(p["alias"]) & named[near]
            rest = len(mine_odd) + odds.sizes[near] - 2 * with_odd, (len(mine_odd) == 0) | (odds.sizes[near] == 0)

            def score(at, likely, fuzzy, cross, e=e, plain=plain, single=single, same=same_age & same_gender, rest=rest):
                tokens = np.where(single[at], likely * 0.5, plain[at])
                evidence = {f: v[at] for f, v in e.items()} | {"name": np.where(tokens == 1.0, np.maximum(likely, 0.95), likely), "tokens": tokens, "fuzzy_tokens": fuzzy, "alias_cross": cross, "same_age_and_gender": same[at] & (fuzzy > 0)}
                return weighed(evidence, rest[0][at], rest[1][at])

            fuzzy_most = 2.0 * sum((likewise.may(w)[near] for w in p["_words"]), np.zeros(near.size)) / total
            most = score(slice(None), texts.most(n, near), fuzzy_most, np.where(asks | answers, 1.0, 0.0))

            reached, scored, step, left_over = -1.0, [], STEP, np.arange(near.size)
            while left_over.size:
                if left_over.size > step:
                    cut = np.argpartition(-most[left_over], step - 1)
                    now, left_over = left_over[cut[:step]], left_over[cut[step:]]
                else:
                    now, left_over = left_over, left_over[:0]
                alike, fuzzy, cross = np.zeros(now.size), np.zeros(now.size), np.zeros(now.size)
                for k, j in enumerate(now):
                    i = near[j]
                    alike[k] = similarity._name_similarity(n, names[i])
                    fuzzy[k] = 2.0 * sum(any(similarity.alike(s, t, 0.85) for t in words[i]) for s in p["_words"]) / total[j]
                    cross[k] = max(similarity._name_similarity(n, aliases[i]) if asks[j] else 0.0, similarity._name_similarity(names[i], p["_alias"]) if answers[j] else 0.0)
                    if e["sound"][j] == 1 and _swapped(n, names[i]):
                        e["sound"][j] = 0.2
                found = score(now, alike, fuzzy, cross)
                scored += zip(found.tolist(), near[now].tolist(), strict=True)
                reached, step = max(reached, float(found.max())), step * 4
                left_over = left_over[most[left_over] >= reached - 0.010001]  # scores are rounded
            if reached >= ties_from - 0.010001:
                keep = [i for s, i in scored if s >= reached - 0.010001]
            else:
                keep = list({s: i for s, i in scored if s >= reached - 1e-9}.values())
            out += ((me, right["_b"].iloc[i]) for i in keep)
        return pd.DataFrame(out, columns=["_a", "_b"])

    return best
