"""Small documents with the awkward cases that all operators must handle, and plain-Python references."""

import hashlib
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, name string, pos long, key string"


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def lines(n, seed, per_line=9):
    return "\n".join(" ".join(words(per_line, seed * 1000 + i)) for i in range(n))


def awkward():
    """(doc_id, text, source): nulls, blanks, ties, repeated rows, copies, near copies, shared passages, a long text."""
    base, passage = words(120, 1), lines(4, 77)
    near = [w if i % 60 else f"edit{i}" for i, w in enumerate(base)]
    docs = [
        (1, " ".join(base), "a"), (2, " ".join(base), "a"), (3, " ".join(base).upper(), "b"), (4, " ".join(near), "a"), (5, None, "a"), (6, "", None), (7, "  \n\t ", "b"), (8, "one two", "a"), (9, "one two", "b"),
        (10, lines(6, 3) + "\n" + passage + "\n" + lines(3, 4), "a"), (11, lines(5, 5) + "\n" + passage, "a"), (12, passage + "\n" + passage, None), (13, "tail\n", "a"), (14, lines(300, 6), "b"), (14, lines(300, 6), "b"),
        (15, "é" * 150 + "x", "c"), (16, "The " * 80, "c"), (None, lines(2, 9), "a"), (17, "\x00" * 130, "c"), (18, lines(20, 10) + " </s>[INST]", "c"),
    ]
    return docs


def frame(spark, rows):
    """With further columns, some named like the operators' own."""
    full = [(d, t, "en", s, len(t or ""), 7, None, 3, "k") for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def substrings_removed(docs, window=100):
    """{(doc_id, text): (bytes, removed, spans, sha256)}; repeated rows count once, a null doc_id comes first."""
    seen, out = set(), {}
    for d, t in sorted(set(docs), key=lambda x: (x[0] is not None, x[0] or 0)):
        data = (t or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - window + 1):
            s = data[i : i + window]
            if s in seen:
                covered[i : i + window] = b"\1" * window
            seen.add(s)
        kept = bytes(x for x, c in zip(data, covered, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[d, t] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def jaccard_components(docs, n, num, den):
    """{(doc_id, text): (set size, smallest doc_id that links reach)}."""
    def grams(t):
        w = lower(t).replace("\t", " ").replace("\n", " ").split()
        return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()

    nodes = list(dict.fromkeys(docs))
    sets = [grams(t) for _, t in nodes]
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(nodes):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return {node: (len(s), low.get(find(i))) for i, (node, s) in enumerate(zip(nodes, sets, strict=True))}
