import hashlib
import random
import zlib

import pytest

from caseloom.llm import prefix_trie
from caseloom.llm.prefix_trie import HEADS, MODULUS

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth long, path long"


def remainder(c):
    return c % MODULUS if c >= 0 else -(-c % MODULUS)


def plain(turns, heads):
    """The contract by definition: {(depth, sequence): row}."""
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = heads(c)
        built[c] = own.get(c - remainder(c), [])[:h] + t[h:]
    nodes = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        under = [x for x in nodes if x[: len(node)] == node]
        children = [x for x in nodes if len(x) == len(node) + 1 and x[: len(node)] == node]
        leaves = [x for x in under if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in under)]
        saved = sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, turns, heads=None, **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*t, "x", 1, 2) for t in turns], SCHEMA)
    conv = F.col("conv")
    h = (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int") if heads is None else F.lit(heads)
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered_turns(df), conv - conv % MODULUS, h, HEADS - 1))
    assert all(kind == "bigint" for name, kind in got.dtypes if name != "ends_sha256")
    return sorted(map(tuple, got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def crc(c):
    return zlib.crc32(str(c).encode()) % HEADS


def test_random_conversations(spark):
    r = random.Random(5)
    turns = [(c, i, r.choice(["user", "assistant"]), r.choice(["a", "bé", "", None, "long " * 50])) for c in r.sample(range(-40, 60), 70) for i in range(r.randrange(1, 13))]
    turns += [(71, None, None, None), (71, None, "user", "x"), (72, 3, "user", "b"), (72, 3, "user", "b"), (72, 3, "assistant", "a"), (None, 0, "user", "lost")]
    assert result(spark, turns) == plain(turns, crc)


def test_copies_prefixes_and_a_caterpillar(spark):
    """Very many copies of one conversation, prefixes of each other, and a long one that others leave turn by turn."""
    turns = [(c, i, "user", f"same {i}") for c in range(0, 300, 5) for i in range(3)]
    turns += [(1000 + 5 * k, i, "user", f"nested {i}") for k in range(25) for i in range(k + 1)]
    turns += [(2000 + 5 * k, i, "user", f"body {i}" if i < k else f"leg {k}") for k in range(25) for i in range(k + 1)]
    assert result(spark, turns, heads=0) == plain(turns, lambda c: 0)


def test_prefixes_longer_first(spark):
    """Ids fall as conversations grow, so each prefix has another smallest member and hangs off the next."""
    turns = [(5 * (30 - k), i, "user", f"nested {i}") for k in range(25) for i in range(k + 1)]
    assert result(spark, turns, heads=0) == plain(turns, lambda c: 0)


@pytest.mark.parametrize("ids", [1, 2, 4096])
def test_pieces_of_ends(spark, ids):
    rows = [(c, 0, b"n" if c % 3 else b"m", None, 0, True) for c in range(-20, 40)] + [(99, 0, b"n", None, 0, False)]
    got = dict(prefix_trie.end_digests(spark.createDataFrame(rows, prefix_trie._PREFIXES), ids).collect())
    for node, own in ((b"n", [c for c in range(-20, 40) if c % 3]), (b"m", [c for c in range(-20, 40) if not c % 3])):
        assert got[node] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()


def test_no_conversation(spark):
    assert result(spark, []) == [] and result(spark, [(None, 0, "user", "x")]) == []
    only = [(7, 0, "user", "x")]
    assert result(spark, only) == plain(only, crc)
