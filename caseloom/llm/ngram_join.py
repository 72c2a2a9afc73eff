"""N-gram Jaccard join with multiple-global-order filtering.

A document is the set of its distinct word n-grams (64-bit digests). Under any one order of all n-grams, two sets of
Jaccard similarity t or more share a member of their prefixes, the first n - ceil(t * n) + 1 in that order. The first
order (rare before frequent, by counts over all documents) gives the candidates through a shuffle by n-gram; a candidate
must then share prefix members under further orders too, and only the intersection of these filters is verified.

What keeps this in proportion to the input:
- documents of one set are one class from the start, so exact copies cost a row each;
- an n-gram has a list for every class of set sizes: sets that differ too much in size never meet;
- n-grams with the same list of classes are one list (count and two XOR digests tell lists apart, nothing is collected);
- a list of more than `LEADER_ROWS` is dealt to parts, and each part compares its rows with one leader of the list; only rows
  that are far from the leader meet all parts, so that a large group of near copies costs a comparison a row;
- within a list, sizes and parity bitmaps must allow the similarity (the number of differing bits is a lower bound of the
  symmetric difference), and only as many links are written as connect what they allow, not all pairs;
- texts move once, only those with a candidate, to the component of their candidates (in large ones again a leader first,
  then what is far from it), where all orders filter and exact set sizes decide. Pairs that links connect already are left
  out, as only classes count.

Every filter is a necessary condition, so no link between different sets is lost; links are verified by the exact sizes of
sets of 64-bit digests (two n-grams of one text or pair would have to share a digest to change a size). A list or a
component whose members are mostly far from its leader is compared pair by pair of its blocks.

Defined results: null and blank texts have no n-gram and link with nothing; texts of fewer words than n are one n-gram,
the whole sequence; rows that repeat doc_id and text are one member and get one result each; a null doc_id takes part
but names a component only if it has no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize, numbered, possibly_in, read
from .components import components

BITS, COUNTERS, BLOCK, BLOCK_SHINGLES = 1024, 1 << 22, 1500, 2_000_000
#: How many rows meet a leader in one task.
LEADER_ROWS = 256
ORDERS = 3
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them, another for each seed."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: A number for each byte (A-Z as a-z), and an odd base with its inverse modulo 2**64.
_BYTE = _mixed(np.frombuffer(_LOWER, "u1").astype("u8"), 7)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))


def _powers(base, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[:1] = 1
    return np.multiply.accumulate(out)


def ngram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct digests of the n-grams of each text's words (A-Z lowered). All texts of a batch are digested
    together: a word's digest is a difference of running sums of its bytes' numbers."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(part[-1]) + 1
        if size > 2_000_000:
            out += _ngram_sets(part, n)
            part, size = [], 0
    return out + _ngram_sets(part, n)


def _ngram_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    if not texts:
        return []
    b = np.frombuffer(b" ".join(texts) + b" ", "u1")
    white = _WHITE[b]
    edge = np.flatnonzero(np.diff(np.r_[True, white]))  # word starts and ends in turn
    first, end = edge[0::2], edge[1::2]
    sums = np.r_[np.uint64(0), np.cumsum(np.where(white, np.uint64(0), _BYTE[b]) * _powers(_BASE, len(b)), dtype="u8")]
    w = _mixed((sums[end] - sums[first]) * _powers(_INVERSE, len(b))[first] + (end - first).astype("u8"))
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    cut = np.searchsorted(first, starts)  # words of each text
    whole = w[:0]
    if len(w) >= n:
        whole = np.full(len(w) - n + 1, n, "u8")
        for k in range(n):
            whole = _mixed(whole ^ w[k : len(w) - n + 1 + k], k)
    out = []
    for a, z in zip(cut[:-1], cut[1:], strict=True):
        m = z - a
        if m >= n:
            out.append(np.unique(whole[a : z - n + 1]))
        else:
            h = np.full(min(m, 1), m, "u8")
            for k in range(m):
                h = _mixed(h ^ w[a + k], k)
            out.append(h)
    return out


def ngrams(text: str | None, n: int) -> np.ndarray:
    return ngram_sets([text], n)[0]


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(65 - COUNTERS.bit_length())).astype("i8")


def _prefix(grams: np.ndarray, order: int, counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """The prefix of a set: frequent classes last, within a class by a digest that differs between orders."""
    size = len(grams) - -(-num * len(grams) // den) + 1
    c = counts[_cells(grams)]
    if order:  # other orders see classes of counts only, and scatter differently
        c = c // 16
    key = _mixed(grams, 100 + order)
    return grams[np.lexsort((key, c))[:size]]


def _bitmap(grams: np.ndarray) -> bytes:
    """Parity of the members that fall on each bit; of half as many bits as members, a power of two, at least BITS.
    The halves of a longer map, joined by exclusive or, are the shorter map of the same set."""
    bits = BITS
    while bits < len(grams) // 2:
        bits *= 2
    at = (_mixed(grams, 77) % np.uint64(bits)).astype("i8")
    return np.packbits(np.bincount(at, minlength=bits).astype("u1") & 1).tobytes()


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    b = np.frombuffer(bitmap, "u8")
    while len(b) > size:
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return b


def gram_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How often the n-grams of each of COUNTERS cells occur in all documents, as eighths of a binary logarithm (a byte
    each). Tasks send a byte per cell, and what goes beyond apart; cells are summed in slices, so the driver only gets the result, of a fixed size."""
    slices = 64
    width = COUNTERS // slices

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, "i4")
        for batch in batches:
            found = ngram_sets(batch["text"].to_pylist(), n)
            for a in range(0, len(found), 2000):
                total += np.bincount(_cells(np.concatenate(found[a : a + 2000])), minlength=COUNTERS).astype("i4")
        if total.any():
            own = total.reshape(slices, width)
            low, more = np.minimum(own, 255).astype("u1"), [(at := np.flatnonzero(x > 255), x[at] - 255) for x in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(slices), pa.int32()), pa.array([x.tobytes() for x in low], pa.binary()), pa.array([np.stack([a, x]).astype("<i4").tobytes() for a, x in more], pa.binary())], names=["slice", "counts", "more"]
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, "i8")
        for x, more in zip(pdf["counts"], pdf["more"], strict=True):
            total += np.frombuffer(x, "u1")
            at, rest = np.frombuffer(more, "<i4").reshape(2, -1)
            total[at] += rest
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "counts": [np.minimum(np.round(8 * np.log2(np.maximum(total, 1))), 255).astype("u1").tobytes()]})

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "slice int, counts binary, more binary")
    summed = parts.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect()  # 64 rows of 64 KB
    out = np.zeros(COUNTERS, "u1")
    for r in summed:
        out[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], "u1")
    return out


def _size_classes(num: int, den: int, largest: int = 1 << 40) -> np.ndarray:
    """Where classes of set sizes begin, such that similar sets are of one class or of neighbouring ones."""
    begins = [1]
    while begins[-1] < largest:
        begins.append(-(-begins[-1] * den // num))
    return np.array(begins, "i8")


def _described(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, counts) -> Iterator[pa.RecordBatch]:
    begins = _size_classes(num, den)
    for batch in batches:
        size, key, bits, prefix = [], [], [], []
        for g in ngram_sets(batch["text"].to_pylist(), n):
            size.append(len(g))
            key.append(hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None)
            bits.append(_bitmap(g))
            prefix.append(_prefix(g, 0, counts.value, num, den).view("i8") if len(g) else np.empty(0, "i8"))
        of_size = np.searchsorted(begins, size, side="right")
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(size, pa.int64()), pa.array(of_size, pa.int32()), pa.array(key, pa.binary()), pa.array(bits, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n_shingles", "size_class", "set_key", "bits", "prefix"])


class Forest:
    """Which of some numbered nodes are connected so far."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, i: int, j: int) -> bool:
        """Whether i and j were not connected before."""
        x, y = self.root[i], self.root[j]
        if x != y:
            self.root[self.root == x] = y
        return bool(x != y)


def _could(size: np.ndarray, short: np.ndarray, i, j, num: int, den: int) -> np.ndarray:
    """Whether sizes and bitmaps allow the similarity."""
    both = size[i] + size[j]
    ok = np.minimum(size[i], size[j]) * den >= np.maximum(size[i], size[j]) * num
    return ok & (np.bitwise_count(short[i] ^ short[j]).sum(-1, dtype="i8") * (num + den) <= both * (den - num))


def _could_in_full(a: bytes, b: bytes, both: int, num: int, den: int) -> bool:
    """The same by the longer bitmaps that two long sets have."""
    words = min(len(a), len(b)) // 8
    return words * 64 <= BITS or int(np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum(dtype="i8")) * (num + den) <= both * (den - num)


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with where each starts and the end; rows come sorted by keys. Only an unfinished group is
    kept between batches."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        key = np.stack([table[c].to_numpy() for c in keys], 1)
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        held = table.slice(new[-1])
        if len(new) > 1:
            yield table.slice(0, new[-1]), new
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


class _Sets:
    """Nodes of a table with the sizes and bitmaps of their sets."""

    def __init__(self, table: pa.Table, num: int, den: int):
        self.node, self.size, self.maps = table["node"].to_numpy(), table["n_shingles"].to_numpy(), table["bits"].to_pylist()
        self.short = np.stack([_folded(m, BITS // 64) for m in self.maps])
        self.num, self.den = num, den

    def could(self, i, j) -> np.ndarray:
        return _could(self.size, self.short, i, j, self.num, self.den)

    def in_full(self, a: int, b: int) -> bool:
        return _could_in_full(self.maps[a], self.maps[b], self.size[a] + self.size[b], self.num, self.den)


def _links(sets: _Sets, found: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(found, "i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(sets.node[at[:, 0]]), pa.array(sets.node[at[:, 1]])], names=["a", "b"])


def _allowed(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram. Out: links that connect, within each list, what sizes and bitmaps allow to be similar; one
    link fewer than connected nodes."""
    for table, cuts in _groups(batches, ("gram",)):
        yield _connected(_Sets(table, num, den), cuts)


def _connected(sets: _Sets, cuts: np.ndarray) -> pa.RecordBatch:
    own = {x: i for i, x in enumerate(dict.fromkeys(sets.node.tolist()))}
    place, root, out = [own[x] for x in sets.node.tolist()], list(range(len(own))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def tell(i: np.ndarray, j: np.ndarray) -> None:
        ok = sets.could(i, j)
        for a, b in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
            x, y = find(place[a]), find(place[b])
            if x != y and sets.in_full(a, b):
                root[x] = y
                out.append((a, b))

    sizes = np.diff(cuts)
    for m in np.unique(sizes[sizes <= 64]):  # short lists of one length together
        i, j = np.triu_indices(m, 1)
        starts, step = cuts[:-1][sizes == m], max(1, 200_000 // max(len(i), 1))
        for a in range(0, len(starts), step):
            tell((starts[a : a + step, None] + i).ravel(), (starts[a : a + step, None] + j).ravel())
    for c, m in zip(cuts[:-1][sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        here = Forest(m)  # long lists row by row, without what is connected already
        for i in range(m - 1):
            j = i + 1 + np.flatnonzero(here.root[i + 1 :] != here.root[i])
            j = j[sets.could(c + i, c + j)]
            for x in j.tolist():
                if here.root[i] != here.root[x] and sets.in_full(c + i, c + x):
                    here.join(i, x)
                    tell(np.array([c + i]), np.array([c + x]))
    return _links(sets, out)


def _led(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram, part and kind; a part starts with the leader of the list (kind 0). Out: gram, node, and the
    leader if sizes and bitmaps allow the two to be similar."""
    leader: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if leader is None else pa.concat_tables([leader, pa.Table.from_batches([batch])])
        kind = table["kind"].to_numpy()
        sets, own = _Sets(table, num, den), np.arange(table.num_rows)
        at = np.maximum.accumulate(np.where(kind == 0, own, 0))
        leader = table.slice(at[-1], 1)
        ok = sets.could(at, own)
        for x in np.flatnonzero(ok & (kind == 1)).tolist():
            ok[x] = sets.in_full(at[x], x)
        rows = np.flatnonzero(kind == 1)
        yield pa.RecordBatch.from_arrays([pa.array(table["gram"].to_numpy()[rows]), pa.array(sets.node[rows]), pa.array(sets.node[at][rows], mask=~ok[rows])], names=["gram", "node", "leader"])


def _stars(node: np.ndarray, root: np.ndarray, center: np.ndarray | None) -> list[tuple[int, int]]:
    """Links that connect what has one root: each node with the smallest one, so that groups that share nodes mostly give
    the same links. center: for nodes that a leader connects already, that leader; else -1."""
    order = np.lexsort((node, root))
    first = np.r_[True, root[order][1:] != root[order][:-1]]
    middle = node[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    if center is not None:
        best = np.full(len(root), -1, "i8")
        np.maximum.at(best, root, center)
        middle = np.where(best[root[order]] >= 0, best[root[order]], middle)
        order, middle = order[center[order] < 0], middle[center[order] < 0]
    return [(m, x) for m, x in zip(middle.tolist(), node[order].tolist(), strict=True) if m != x]


def _far_links(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram, slot, part and kind. Out: links that connect the far nodes of a slot (kind 0) with what the
    part has (kind 1, leader null where that is far too); all with a leader count as connected to it."""
    for table, cuts in _groups(batches, ("gram", "slot", "part")):
        sets, kind = _Sets(table, num, den), table["kind"].to_numpy()
        leader = table["leader"].fill_null(-1).to_numpy()
        out: set[tuple[int, int]] = set()
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            node, here, members = sets.node[a:z], Forest(z - a), np.flatnonzero(kind[a:z] == 1)
            near = members[leader[a + members] >= 0]
            here.root[near] = near[0] if len(near) else 0
            at = dict(zip(node[members].tolist(), members.tolist(), strict=True))
            for i in np.flatnonzero(kind[a:z] == 0).tolist():
                if node[i] in at:  # the same node, also as a member
                    here.join(i, at[node[i]])
                j = members[here.root[members] != here.root[i]]
                for x in j[sets.could(a + i, a + j)].tolist():
                    if here.root[i] != here.root[x] and sets.in_full(a + i, a + x):
                        here.join(i, x)
            out.update(_stars(node, here.root, leader[a:z]))
        at = np.array(sorted(out), "i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], names=["a", "b"])


def _parted(rows: DataFrame, group: str, parts: str) -> tuple[DataFrame, DataFrame]:
    """rows of large groups dealt to `part`s, and one row of each group, its leader, for every part; kind tells them apart."""
    leader = rows.groupBy(group, parts).agg(F.min_by(F.struct(*(c for c in rows.columns if c not in (group, parts))), F.xxhash64("node")).alias("l")).select(group, parts, "l.*")
    leader = leader.withColumn("part", F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).withColumn("kind", F.lit(0))
    return leader, rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")).withColumn("kind", F.lit(1))


def _far_and_all(rows: DataFrame, checked: DataFrame, group: str, parts: str, block_rows: int) -> DataFrame:
    """What the far members of large groups have to meet: they go to every part of their group (kind 0), and each member
    goes to its part once per slot of far ones (kind 1). Few far members leave it at about a row each; where they are many,
    parts are larger, so that less is sent."""
    counts = checked.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("leader").isNull()).alias("_far")).where("_far > 0")
    known = join_groups(rows.join(checked, [group, "node"]), materialize(counts, "far"), [group], "_n")
    fewer = F.greatest(F.ceil(F.col("_n") / F.lit(block_rows)), F.ceil(F.col(parts) / 6)).cast("int")
    known = known.withColumn("_slots", F.ceil(F.col("_far") / F.lit(block_rows)).cast("int")).withColumn(parts, F.when(F.col("_far") * 8 < F.col("_n"), F.col(parts)).otherwise(F.least(F.col(parts), fewer))).drop("_n", "_far")
    own, every = F.pmod(F.xxhash64("node"), F.col(parts)).cast("int"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    far = known.where("leader IS NULL").withColumn("slot", F.pmod(F.xxhash64("node", F.lit(1)), F.col("_slots")).cast("int")).withColumn("part", every(parts)).withColumn("kind", F.lit(0))
    member = known.withColumn("slot", every("_slots")).withColumn("part", own).withColumn("kind", F.lit(1))
    return far.unionByName(member).drop("_slots")


def _candidates(classes: DataFrame, num: int, den: int, block_rows: int) -> DataFrame:
    """a, b: links that connect all nodes that share a prefix member of the first order and pass the bounds."""
    each = min(block_rows, LEADER_ROWS)
    # an n-gram is a list of its own for each size class; sets of a class meet those of the next one there too
    both = F.array(F.col("size_class"), F.col("size_class") + 1)
    grams = classes.select("node", F.explode("prefix").alias("gram"), both.alias("both")).select("node", "gram", F.explode("both").alias("of_size")).select("node", F.xxhash64("gram", "of_size").alias("gram"))
    shared = materialize(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    members = materialize(possibly_in(grams, "gram", shared.select("gram")).join(shared, "gram"), "members")
    lists = members.groupBy("gram", "n").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    lists = materialize(lists.groupBy("n", "x", "y").agg(F.min("gram").alias("gram")).select("gram", "n"), "lists")
    listed = join_groups(members.drop("n"), lists, ["gram"], "n").join(classes.select("node", "n_shingles", "bits"), "node").select("gram", "n", "node", "n_shingles", "bits")
    short = listed.where(F.col("n") <= each).drop("n").repartition("gram").sortWithinPartitions("gram")
    links = short.mapInArrow(lambda it: _allowed(it, num, den), "a long, b long")
    if lists.where(F.col("n") > each).isEmpty():
        return links
    long = materialize(listed.where(F.col("n") > each).withColumn("parts", F.ceil(F.col("n") / F.lit(each)).cast("int")).drop("n"), "long-lists")
    leader, member = _parted(long, "gram", "parts")
    ordered = leader.unionByName(member).repartition("gram", "part").sortWithinPartitions("gram", "part", "kind")
    checked = materialize(ordered.mapInArrow(lambda it: _led(it, num, den), "gram long, node long, leader long"), "led")
    links = links.unionByName(checked.where("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b")))
    if checked.where("leader IS NULL").isEmpty():
        return links
    rest = _far_and_all(long, checked, "gram", "parts", block_rows).repartition("gram", "slot", "part").sortWithinPartitions("gram", "slot", "part", "kind")
    return links.unionByName(rest.mapInArrow(lambda it: _far_links(it, num, den), "a long, b long"))


class _Texts:
    """Sets of texts that have met: the filters of all orders, the bounds, and exact verification."""

    def __init__(self, texts: pd.Series, n: int, num: int, den: int, counts: np.ndarray):
        self.sets, self.num, self.den = ngram_sets(list(texts), n), num, den
        self.maps = [_bitmap(s) for s in self.sets]
        self.size, self.short = np.array([len(s) for s in self.sets]), np.stack([_folded(m, BITS // 64) for m in self.maps])
        self.prefixes = [[_prefix(s, order, counts, num, den) for s in self.sets] for order in range(ORDERS)]
        owner = np.repeat(np.arange(len(self.sets)), [len(p) for p in self.prefixes[0]])
        gram = np.concatenate(self.prefixes[0])
        by_gram = np.argsort(gram, kind="stable")
        self.gram, self.owner = gram[by_gram], owner[by_gram]
        self.others = [[frozenset(p.tolist()) for p in own] for own in self.prefixes[1:]]

    def met(self, i: int) -> np.ndarray:
        """Which share a prefix member of the first order with i."""
        out = np.zeros(len(self.sets), bool)
        first, last = np.searchsorted(self.gram, self.prefixes[0][i]), np.searchsorted(self.gram, self.prefixes[0][i], side="right")
        for a, z in zip(first.tolist(), last.tolist(), strict=True):
            out[self.owner[a:z]] = True
        return out

    def could(self, i, j) -> np.ndarray:
        return _could(self.size, self.short, i, j, self.num, self.den)

    def similar(self, i: int, x: int) -> bool:
        if not _could_in_full(self.maps[i], self.maps[x], self.size[i] + self.size[x], self.num, self.den) or any(own[i].isdisjoint(own[x]) for own in self.others):
            return False
        both = len(np.intersect1d(self.sets[i], self.sets[x], assume_unique=True))
        return self.den * both >= self.num * (self.size[i] + self.size[x] - both)


def _verified(rows: pd.DataFrame, n: int, num: int, den: int, counts) -> pd.DataFrame:
    """Links within one component of candidates, or (with `kind`) between the far members of a slot and a part of a large
    one. Each node meets those that share prefix members under every order and pass the bounds; what verified links, or
    the leader of a large component, connect already needs no further check."""
    node, texts = rows["node"].to_numpy(), _Texts(rows["text"], n, num, den, counts.value)
    forest, place = Forest(len(node)), np.arange(len(node))
    kind = rows["kind"].to_numpy() if "kind" in rows else np.zeros(len(node), "i8")
    leader = rows["leader"].fillna(-1).to_numpy("i8") if "leader" in rows else np.full(len(node), -1, "i8")
    led = np.flatnonzero((kind == 1) & (leader >= 0))
    forest.root[led] = led[0] if len(led) else 0
    at = dict(zip(node[kind == 1].tolist(), np.flatnonzero(kind == 1).tolist(), strict=True))
    for i in np.flatnonzero(kind == 0).tolist():
        if node[i] in at:  # the same node, also as a member
            forest.join(i, at[node[i]])
        other = (place > i) if not kind.any() else kind == 1
        j = np.flatnonzero(texts.met(i) & other & (forest.root != forest.root[i]))
        for x in j[texts.could(i, j)].tolist():
            if forest.root[i] != forest.root[x] and texts.similar(i, x):
                forest.join(i, x)
    return pd.DataFrame(_stars(node, forest.root, leader), columns=["a", "b"]).astype("i8")


def _led_texts(rows: pd.DataFrame, n: int, num: int, den: int, counts) -> pd.DataFrame:
    """candidate_of, node, and the leader of the component if a part's text is similar to its text."""
    rows = rows.sort_values("kind", kind="stable")
    node, texts = rows["node"].to_numpy(), _Texts(rows["text"], n, num, den, counts.value)
    j = np.flatnonzero(texts.met(0) & (np.arange(len(node)) > 0))
    j = [x for x in j[texts.could(0, j)].tolist() if node[x] == node[0] or texts.similar(0, x)]
    leader = pd.array([None] * len(node), "Int64")
    leader[j] = node[0]
    return pd.DataFrame({"candidate_of": rows["candidate_of"].to_numpy(), "node": node, "leader": leader})[1:]


def _verified_links(texts: DataFrame, n: int, num: int, den: int, counts, block_rows: int) -> DataFrame:
    """a, b: verified links that connect all similar texts; texts: node, candidate_of, blocks, text."""
    verify = lambda t: _verified(t, n, num, den, counts)
    links = texts.where("blocks = 1").select("candidate_of", "node", "text").groupBy("candidate_of").applyInPandas(verify, "a long, b long")
    large = texts.where("blocks > 1")
    leader, member = _parted(large, "candidate_of", "blocks")
    checked = leader.unionByName(member).groupBy("candidate_of", "part").applyInPandas(lambda t: _led_texts(t, n, num, den, counts), "candidate_of long, node long, leader long")
    checked = materialize(checked, "led-texts")
    links = links.unionByName(checked.where("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b")))
    if checked.where("leader IS NULL").isEmpty():
        return links
    rest = _far_and_all(large, checked, "candidate_of", "blocks", block_rows).select("candidate_of", "slot", "part", "kind", "node", "leader", "text")
    return links.unionByName(rest.groupBy("candidate_of", "slot", "part").applyInPandas(verify, "a long, b long"))


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, block_rows: int = BLOCK) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id: a row per row of docs. Sets of word n-grams link when
    den * intersection >= num * union; component_id is the smallest doc_id that links reach."""
    return _in_components(docs, n, num, den, block_rows).drop("component")


def _in_components(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, block_rows: int = BLOCK) -> DataFrame:
    """The same with component, a number of its own for each component (doc_ids may repeat or be null); null for blank texts."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    counts = spark.sparkContext.broadcast(gram_counts(docs, n))  # 4 MB at any size of the input
    described = docs.mapInArrow(lambda it: _described(it, n, num, den, counts), "doc_id long, text_key long, n_shingles long, size_class int, set_key binary, bits binary, prefix array<long>")
    described = materialize(described, "sets")
    carrier = F.struct("doc_id", "text_key")
    first = described.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min(F.when(F.col("doc_id").isNotNull(), carrier)).alias("own"), F.min(carrier).alias("any"), F.first("n_shingles").alias("n_shingles"), F.first("size_class").alias("size_class"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"))
    classes = materialize(numbered(first.withColumn("carrier", F.coalesce("own", "any")).drop("own", "any"), "node", ["set_key"]), "classes")
    groups = components(materialize(_candidates(classes, num, den, block_rows), "candidates")).withColumnRenamed("component", "candidate_of")
    groups = groups.join(classes.select("node", "n_shingles", F.col("carrier.doc_id").alias("c_doc"), F.col("carrier.text_key").alias("c_key")), "node")
    sizes = groups.groupBy("candidate_of").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(min(block_rows, LEADER_ROWS))), F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES))).alias("blocks"))
    carried = materialize(groups.join(sizes, "candidate_of").select("node", "candidate_of", "blocks", "c_doc", "c_key"), "carriers")
    # only texts of candidates move; a text of a large component goes to each pair of blocks that has its own
    texts = possibly_in(docs, "text_key", carried.select("c_key")).join(carried, docs["doc_id"].eqNullSafe(F.col("c_doc")) & (docs["text_key"] == F.col("c_key")))
    texts = materialize(texts.dropDuplicates(["node"]).select("node", "candidate_of", F.col("blocks").cast("int").alias("blocks"), "text"), "candidate-texts")
    linked = components(materialize(_verified_links(texts, n, num, den, counts, block_rows), "links"))
    named = classes.select("node", "set_key", F.col("carrier.doc_id").alias("smallest")).join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = named.join(names, "component").select("set_key", "component", "component_id")
    out = described.select("doc_id", "text_key", "n_shingles", "set_key").join(named, "set_key", "left")
    return out.select("doc_id", "text_key", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "component")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, all columns, that keep one document per component: that of the smallest doc_id (a null only if
    all are), of several texts with that doc_id the one of the smallest digest. Blank texts stay, and so do all rows that
    repeat the kept document's id and text."""
    rows = materialize(_in_components(docs, **options), "in-components")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    best = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("best")).select(F.col("best.doc_id").alias("_doc"), F.col("best.text_key").alias("_key"))
    blank = rows.where("component IS NULL").select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
    kept = best.unionByName(blank).distinct()
    joined = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_key")))
    return joined.select(*(docs[c] for c in docs.columns))


def op4_ngram_join(spark, sf_dir):
    return jaccard_components(read(spark, sf_dir, "documents"), 3, 90, 100).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op4_ngram_join": op4_ngram_join}
#: Brute force, for small tables: all pairs that share an n-gram, then reachability.
COMPONENTS_SQL = r"""
w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM {docs}),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {n} THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - {n} + 2), lambda i: array_to_string(ws[i:i + {n} - 1], ' '))) END AS gs FROM w),
s AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS x FROM g WHERE len(gs) > 0),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id AND {num} * least(a.n, b.n) <= {den} * greatest(a.n, b.n) AND {num} * greatest(a.n, b.n) <= {den} * least(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id HAVING {den} * count(*) >= {num} * (any_value(a.n) + any_value(b.n) - count(*))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS low FROM {docs} UNION SELECT e.b, r.low FROM r JOIN e ON r.v = e.a WHERE r.low < e.b)"""
ORACLE_SQL = {
    "op4_ngram_join": "WITH RECURSIVE" + COMPONENTS_SQL.format(docs="documents", n=3, num=90, den=100) + """
SELECT g.doc_id, coalesce(len(g.gs), 0) AS n_shingles, m.component_id FROM g JOIN (SELECT v, min(low) AS component_id FROM r GROUP BY v) m ON g.doc_id = m.v"""
}
