import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from caseloom.llm import exact_dedup, line_dedup, ngram_join, suffix_dedup

from .helpers import awkward, frame, jaccard_components, lower, substrings_removed, words


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup(spark, bits):
    rows = awkward()
    out = exact_dedup.exact_dedup(frame(spark, rows), block_bytes=64, key_bits=bits).collect()
    assert len(out) == len(rows)
    groups = Counter(lower(t) for _, t, _ in rows)
    best = {}
    for d, t, _ in rows:
        best[lower(t)] = max(best.get(lower(t), -1), -1 if d is None else d)
    expected = Counter((d, None if best[lower(t)] < 0 else best[lower(t)], groups[lower(t)], hashlib.sha256(lower(t).encode()).hexdigest()) for d, t, _ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == expected
    assert sum(r.kept for r in out) == len(groups) and all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(frame(spark, [])).collect() == []


def plain_lines(rows):
    """What line dedup leaves, by definition."""
    nodes = sorted({(d, t) for d, t, _ in rows}, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    first, out = {}, {}
    for d, t in nodes:
        ls = (t or "").split("\n")
        for i in range(len(ls) - 2):
            first.setdefault(tuple(ls[i : i + 3]), (d, i))
    for d, t in nodes:
        ls = (t or "").split("\n") if t is not None else []
        gone = {i + k for i in range(len(ls) - 2) if first[tuple(ls[i : i + 3])] != (d, i) for k in range(3)}
        out[d, t] = (None if t is None else "\n".join(x for i, x in enumerate(ls) if i not in gone), len(gone))
    return out


def test_line_dedup(spark):
    rows = awkward()
    out = line_dedup.deduplicate_lines(frame(spark, rows), "r").collect()
    expected = plain_lines(rows)
    assert len(out) == len(rows) and {r.name for r in out} == {None}
    for r in out:
        assert (r.r.text, r.r.n_removed) == expected[r.doc_id, r.text]
    kept = line_dedup.without_repeated_lines(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.count() == len(rows)
    assert line_dedup.without_repeated_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("doc", [7, None])
def test_line_dedup_of_texts_that_share_a_doc_id(spark, doc):
    head = "one header\nof three\nlines"
    rows = [(doc, f"{head}\nbody {i}", "a") for i in range(4)]
    out = line_dedup.deduplicate_lines(frame(spark, rows), "r").collect()
    assert sorted(r.r.n_removed for r in out) == [0, 3, 3, 3]
    assert {r.r.text for r in out if r.r.n_removed} <= {f"body {i}" for i in range(4)}


def test_suffix_dedup(spark):
    rows = awkward()
    out = suffix_dedup.deduplicate_substrings(frame(spark, rows)).collect()
    expected = substrings_removed([(d, t) for d, t, _ in rows])
    texts = Counter()
    for d, t, _ in rows:
        texts[d, *expected[d, t]] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out) == texts
    assert suffix_dedup.deduplicate_substrings(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"hot_contexts": 3}, {"shard_bytes": 300, "block_bytes": 500}, {"shard_bytes": 150, "block_bytes": 200, "hot_contexts": 2}])
def test_suffix_dedup_of_shards_blocks_and_hot_keys(spark, sizes):
    r = random.Random(5)
    passage = " ".join(words(40, 8))
    rows = [(i, " ".join(words(r.randrange(5, 60), 100 + i)) + " " + passage[: r.randrange(90, len(passage))] + " " + " ".join(words(20, 300 + i)), "a") for i in range(40)]
    rows += [(100, "ab" * 300, "a"), (101, "x" + "ab" * 200, "a"), (102, "abc" * 50 + "d", "a"), (103, rows[3][1], "a"), (None, rows[5][1] + " more", "a")]
    expected = substrings_removed([(d, t) for d, t, _ in rows])
    out = suffix_dedup.deduplicate_substrings(frame(spark, rows), **sizes).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out} == {(d, *x) for (d, _), x in expected.items()}


@pytest.mark.parametrize("bits", [63, 3, 1])
def test_suffix_dedup_of_different_texts_of_one_doc_id(spark, bits):
    """Whichever keys they get: with one bit, keys are drawn until the two differ."""
    a, b = (" ".join(words(60, seed))[:133] for seed in (21, 22))
    low = -(2**63)
    rows = [(1, a, "a"), (1, b, "a"), (2, a + b, "a"), (low, b + "!", "a"), (None, b + "!", "a")]
    out = suffix_dedup.deduplicate_substrings(frame(spark, rows), key_bits=bits).collect()
    removed = {(r.doc_id, r.n_bytes): r.n_removed for r in out if r.doc_id != 1}
    assert removed == {(2, 266): 266, (low, 134): 134, (None, 134): 0}
    assert sorted((r.doc_id, r.n_removed) for r in out if r.doc_id == 1) == [(1, 0), (1, 133)]


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\x00"])
def test_shards_by_brute_force(alphabet):
    r = random.Random(2)
    for _ in range(25):
        base = [bytes(r.choice(alphabet) for _ in range(r.randrange(500))) for _ in range(4)]
        pieces = [(d, 0, 0, b"".join(r.choice(base) for _ in range(r.randrange(4))) + bytes(r.choice(alphabet) for _ in range(r.randrange(200))) + bytes(r.choice([0, 140]))) for d in range(r.randrange(1, 9))]
        shard, seen = suffix_dedup.Shard(pieces), set()
        for (*_, text), start in zip(pieces, shard.starts.tolist(), strict=True):
            for i in range(len(text) - 99):
                assert shard.is_lead[start + i] == (text[i : i + 100] not in seen) != shard.repeats[start + i]
                seen.add(text[i : i + 100])
        windows = shard.windows(shard.leads).tolist()
        assert sorted(seen) == [w[:100] for w in windows] and shard.is_lead.sum() + shard.repeats.sum() == sum(max(0, len(p[3]) - 99) for p in pieces)


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\x00", bytes(range(97, 123))])
def test_rows_of_shards_by_brute_force(alphabet):
    """Also of texts in pieces: all repeats of the shard, and runs over all first windows."""
    r = random.Random(3)
    for _ in range(20):
        base, pieces = [bytes(r.choice(alphabet) for _ in range(r.randrange(500))) for _ in range(4)], []
        for d in range(r.randrange(1, 9)):
            t = b"".join(r.choice(base) for _ in range(r.randrange(4))) + bytes(r.choice(alphabet) for _ in range(r.randrange(200))) + bytes(r.choice([0, 240]))
            pieces += [(d, 0, at, t[at : at + 399]) for at in range(0, max(len(t) - 99, 0), 300)]
        if not pieces:
            continue
        seen, again, first = set(), set(), set()
        for d, _, at, t in pieces:
            for i in range(len(t) - 99):
                (again if t[i : i + 100] in seen else first).add((d, at + i))
                seen.add(t[i : i + 100])
        rows = suffix_dedup._shard_rows(pieces).to_pandas()
        covered = [{(x.doc, i) for x in rows[rows["kind"] == kind].itertuples() for i in range(x.first, x.last + 1)} for kind in (0, 1)]
        assert covered[1] == again and first <= covered[0]


def test_suffix_order_and_common_prefixes():
    r = random.Random(2)
    for size in (1, 7, 300, 2000):
        data = bytes(r.choice(b"ab\x00") for _ in range(size)) if size < 2000 else b"abcabd" * 300 + bytes(200)
        order, shared = suffix_dedup.suffix_order(np.frombuffer(data, "u1"))
        assert sorted(order.tolist()) == list(range(len(data)))
        padded = data + b"\xff" * 200
        assert all((padded[a : a + 128], a) <= (padded[b : b + 128], b) for a, b in zip(order, order[1:], strict=False))
        lcp = suffix_dedup.common_prefixes(np.frombuffer(data, "u1"), order, shared)
        for k in range(1, len(data)):
            x, y = data[order[k] :], data[order[k - 1] :]
            exact = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert (lcp[k] == exact or suffix_dedup.WINDOW <= lcp[k] < exact) if exact >= 64 else lcp[k] <= 64


def test_a_long_periodic_text():
    """In pieces, each in time about linear in its length."""
    rows = suffix_dedup._shard_rows([(1, 0, 0, b"abcdefg " * 250_000)]).to_pandas()
    assert len(rows[rows["kind"] == 1]) == 1 and rows[rows["kind"] == 1]["first"].iloc[0] == 8


def test_suffix_dedup_of_passages_that_differ_in_a_rare_byte(spark):
    rows = []
    for i, (a, b) in enumerate([("\u00a8", "\u00a9"), ("\u00b1", "\u00b2"), ("\u00ba", "\u00bb"), ("{", "}")]):
        passage = " ".join(words(60, 500 + i))
        rows += [(2 * i, a + passage, "a"), (2 * i + 1, b + passage, "a")]
    expected = substrings_removed([(d, t) for d, t, _ in rows])
    out = suffix_dedup.deduplicate_substrings(frame(spark, rows)).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out} == {(d, *x) for (d, _), x in expected.items()}


@pytest.mark.parametrize(("n", "num", "den", "block"), [(3, 90, 100, 1500), (5, 8, 10, 1500), (2, 8, 10, 4)])
def test_ngram_join(spark, n, num, den, block):
    r = random.Random(n)
    base = words(90, 21)
    near = []
    for i in range(30):  # a chain of copies with more and more edits, and some of other lengths
        w = list(base)
        for k in r.sample(range(90), i % 7):
            w[k] = f"e{i}_{k}"
        near.append((200 + i, " ".join(w[: 90 - i % 4]), "a"))
    rows = awkward() + near
    out = ngram_join.jaccard_components(frame(spark, rows), n, num, den, block).collect()
    expected = jaccard_components([(d, t) for d, t, _ in rows], n, num, den)
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in out) == Counter((d, *expected[d, t]) for d, t, _ in rows)


def test_ngram_join_keeps_one_of_each(spark):
    rows = awkward()
    kept = ngram_join.one_of_each(frame(spark, rows), n=5, num=8, den=10)
    assert kept.columns == frame(spark, rows).columns
    expected = jaccard_components([(d, t) for d, t, _ in rows], 5, 8, 10)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, t, _ in rows if expected[d, t][1] == d or not expected[d, t][0])
    assert ngram_join.one_of_each(frame(spark, [])).count() == 0


def test_ngram_join_keeps_one_of_each_whatever_the_ids(spark):
    base, other, third = (words(90, seed) for seed in (31, 32, 33))
    near = lambda own, i: " ".join(own[:-1] + [f"e{i}"])
    rows = [(None, near(base, i), "a") for i in range(3)] + [(5, near(other, i), "a") for i in range(3)] + [(6, near(third, 0), "a"), (None, near(third, 1), "a"), (5, near(third, 2), "a"), (5, "quite another text", "a"), (None, "and one more text", "a"), (None, None, "b"), (5, " ", "b")]
    kept = Counter(" ".join((r.text or "").split()[:2]) for r in ngram_join.one_of_each(frame(spark, rows), n=5, num=8, den=10).collect())
    assert kept == {" ".join(base[:2]): 1, " ".join(other[:2]): 1, " ".join(third[:2]): 1, "quite another": 1, "and one": 1, "": 2}
