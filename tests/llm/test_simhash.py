import random
from collections import Counter
from itertools import pairwise

import pytest
import xxhash

from caseloom.llm import simhash
from caseloom.llm.components import components

from .helpers import awkward, frame, lower


def plain_print(text, n=3):
    words = lower(text).encode().split()
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints):
    """{position: smallest position of its component}, by all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def test_documents_against_the_definition(spark):
    base = " ".join(f"w{i}" for i in range(3000))
    rows = [*awkward(), *((100 + i, base.replace(f"w{50 * i} ", "x "), "a") for i in range(12)), (90, "A\x0bb\x0cc\x85d e", "a"), (91, "a b c\x85d e", "a")]
    got = simhash.simhash_components(frame(spark, rows)).collect()
    prints = [plain_print(t) for _, t, _ in rows]
    low = {}
    for (d, _, _), c in zip(rows, roots := plain_components(prints), strict=True):
        if d is not None:
            low[c] = min(d, low.get(c, d))
    assert len(set(roots)) < len({*prints})  # some link that is no copy
    assert Counter((r.doc_id, r.print % 2**64, r.component_id) for r in got) == Counter((d, p, low.get(c)) for (d, _, _), p, c in zip(rows, prints, roots, strict=True))
    assert simhash.simhash_components(frame(spark, [])).collect() == []


def signed(x):
    return x - 2**64 if x >> 63 else x


@pytest.mark.parametrize("seed", range(3))
def test_links_lose_no_pair(spark, seed):
    """Fingerprints at all small distances, in either half and across, also around zero, and a dense ball."""
    r = random.Random(seed)
    prints = {0, 1, 2**64 - 1, 2**63}
    for _ in range(60):
        at = r.getrandbits(64)
        prints.add(at)
        for _ in range(3):
            flips = r.sample(range(64), r.choice([1, 2, 3, 4, 5]))
            prints.add(at ^ sum(1 << f for f in flips))
    middle = r.getrandbits(64)
    prints |= {middle ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(150)}
    prints = sorted(prints)
    found = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "print long")).collect()
    assert all((x.a ^ x.b) % 2**64 and ((x.a ^ x.b) % 2**64).bit_count() <= 3 for x in found) and len(found) == len({(x.a, x.b) for x in found})
    at = {signed(p): i for i, p in enumerate(prints)}
    rebuilt = list(range(len(prints)))
    for _ in range(len(prints)):
        before = list(rebuilt)
        for x in found:
            i, j = at[x.a], at[x.b]
            rebuilt[i] = rebuilt[j] = min(rebuilt[i], rebuilt[j])
        if before == rebuilt:
            break
    assert rebuilt == plain_components(prints)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_place_of_differing_bits(spark, distance):
    r = random.Random(distance)
    pairs = [(a, a ^ sum(1 << f for f in r.sample(range(64), distance))) for a in (r.getrandbits(64) for _ in range(400))]
    found = {(x.a, x.b) for x in simhash.links(spark.createDataFrame([(signed(p),) for pair in pairs for p in pair], "print long")).collect()}
    assert all(tuple(sorted(map(signed, p))) in found for p in pairs)


def test_components_of_hubs_chains_and_loops(spark):
    chain = list(range(100, 400))
    links = [*pairwise(chain), *((0, x) for x in range(1, 60)), *((x, 60 + x % 7) for x in range(500, 560)), (900, 900), (7, 7), (800, 801), (801, 802), (802, 800)]
    random.Random(1).shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a long, b long"), parts=20, least=4).collect())
    expected = {x: 100 for x in chain} | {x: 0 for x in range(60)} | {800: 800, 801: 800, 802: 800}
    for x in range(500, 560):
        expected[x] = expected[60 + x % 7] = 60 + x % 7
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
