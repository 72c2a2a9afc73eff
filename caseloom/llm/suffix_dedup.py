"""Removal of repeated 100-byte strings by suffix arrays over shards.

Whole texts are gathered in shards of about `shard_bytes` (a longer text is cut into pieces that share no window). Every
window has a key, the smallest digest among its GRAM-byte substrings; equal windows have equal keys, wherever they are.
Stretches of a shard whose keys are at one place of it only cannot repeat in it and are left out. Of the others, a shard
sorts the suffixes by Larsson-Sadakane refinement (the groups that are still unsorted are sorted by the rank of the
suffix that starts as far behind as is sorted already), takes the common prefixes of neighbours by Kasai's rule (one byte
less when both start one byte later) and so finds the classes of equal windows, in each of which all but the first are
repeats. What is first in its shard may still repeat what another shard has.

Equal windows of different shards are brought together by the same keys. Consecutive first windows with one key form a run, and a
run's bytes are its context. A key that only one shard has needs nothing more. Of contexts with one key and one
cryptographic digest (128 bits of BLAKE2b) all but the first are repeats from end to end; the bytes of all other contexts
go to buckets by key. There, contexts are sorted by suffix arrays of their own, block by block, and each block's distinct
windows are merged into those of the blocks before it by binary search on the bytes; what is found there under an earlier
place, or has been, is a repeat. A key with more contexts than `hot_contexts` is dealt over several such blocks, whose
distinct windows meet by a shuffle, each window for itself.

Rows shuffled for the search are digests, one per run; texts move twice, to meet their runs and their spans.

Defined results: a null text counts as empty; texts shorter than WINDOW have no window and stay; rows that repeat both
doc_id and text count as one document and get one result each; of documents with one doc_id the order is by a digest of
the text (drawn anew where two of them share it); a null doc_id comes first, before any other document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize, read, small_batches

WINDOW, GRAM = 100, 24
SHARD_BYTES, BLOCK_BYTES, HOT_CONTEXTS = 4_000_000, 500_000, 2048
#: Common prefixes are followed from places so far apart at most, and no further than so many bytes.
STRIDE = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _eights(data: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.lib.stride_tricks.as_strided(data[:8].view(kind), (len(data) - 7,), (1,)).astype("u8")


def _sliding(x: np.ndarray, w: int, of) -> np.ndarray:
    """of (np.minimum or np.maximum) over each w consecutive places."""
    s, out = 1, x
    while 2 * s <= w:
        out = of(out[:-s], out[s:])
        s *= 2
    n = len(x) - w + 1
    return of(out[:n], out[w - s : w - s + n])


def runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, first and last window of each run of the windows that lie within one of several pieces of data; and whether the
    key's gram is at several places of the data. Each place serves one run, so only windows of such runs may repeat."""
    if len(data) < WINDOW:
        return *(np.empty(0, "i8"),) * 3, np.empty(0, bool)
    e = _eights(data, "<u8")
    h = _mixed(e[:-16] * np.uint64(0x9E3779B97F4A7C15) + _mixed(e[8:-8]) * np.uint64(0xD6E8FEB86659FD93) + _mixed(e[16:]))
    w = WINDOW - GRAM + 1
    low = _sliding(h, w, np.minimum)
    padded = np.concatenate([np.zeros(w - 1, "u8"), low, np.zeros(w - 1, "u8")])
    at_places = np.sort(h[_sliding(padded, w, np.maximum) == h])  # the keys of all places that are some window's smallest
    several = np.unique(at_places[1:][at_places[1:] == at_places[:-1]])
    cut = np.zeros(len(low), bool)
    cut[0], cut[1:] = True, low[1:] != low[:-1]
    cut[starts[starts < len(low)]] = True
    ends = starts + np.maximum(sizes - WINDOW + 1, 0)  # behind the last window of each piece
    cut[ends[ends < len(low)]] = True
    first = np.flatnonzero(cut)
    last = np.r_[first[1:] - 1, len(low) - 1]
    ok = first < ends[np.searchsorted(starts, first, side="right") - 1]
    key, first, last = low[first[ok]], first[ok], last[ok]
    return key.view("i8"), first, last, np.isin(key, several)


class Shard:
    """Pieces of texts side by side, in the order of their places; windows that are the first of their class, and others."""

    def __init__(self, pieces: list[tuple[int, int, int, bytes]]):
        """pieces: doc, text_key, the place of the piece in its text, bytes; what repeats a place counts once."""
        pieces = sorted({p[:3]: p for p in pieces}.values())
        self.doc, self.text_key, self.offset = (np.array([p[i] for p in pieces], "i8") for i in range(3))
        self.sizes = np.array([len(p[3]) for p in pieces], "i8")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(p[3] for p in pieces), "u1")
        order, shared = suffix_order(self.data)
        group = np.cumsum(common_prefixes(self.data, order, shared) < WINDOW)
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.data))
        within = left[order] >= WINDOW
        self.sorted, group = order[within], group[within]  # windows in the order of their bytes
        new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, "i8")
        #: The first place of each class, classes in the order of their bytes.
        self.leads = np.minimum.reduceat(self.sorted, new) if len(new) else new
        self.is_lead = np.zeros(len(self.data), bool)
        self.is_lead[self.leads] = True
        self.repeats = np.zeros(len(self.data), bool)
        self.repeats[self.sorted] = True
        self.repeats[self.leads] = False

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc, text_key and place of windows."""
        piece = np.searchsorted(self.starts, at, side="right") - 1
        return self.doc[piece], self.text_key[piece], self.offset[piece] + at - self.starts[piece]

    def spans(self, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """doc, text_key, first and last window of consecutive repeats of one piece."""
        at = np.flatnonzero(repeats)
        piece = np.searchsorted(self.starts, at, side="right") - 1
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (piece[1:] != piece[:-1])]) if len(at) else at
        doc, text_key, first = self.places(at[new])
        return doc, text_key, first, first + np.diff(np.r_[new, len(at)]) - 1

    def windows(self, at: np.ndarray) -> np.ndarray:
        """Windows as fixed strings, one byte of 1 behind so that trailing zeros count."""
        out = np.ones((len(at), WINDOW + 1), "u1")
        out[:, :WINDOW] = self.data[at[:, None] + np.arange(WINDOW)]
        return out.view(f"S{WINDOW + 1}").ravel()


def _covered(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of several ranges."""
    n = last - first + 1
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


_NAMES = ["gram", "context", "more", "doc", "text_key", "first", "last", "kind"]


def _shard_rows(pieces: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """The runs of first windows (kind 0) and the spans of repeated ones (kind 1) of one shard. Its suffix array leaves out
    the stretches between runs whose keys the shard has at one place only: no window there can repeat in the shard."""
    pieces = sorted({p[:3]: p for p in pieces}.values())
    doc, text_key, offset = (np.array([p[i] for p in pieces], "i8") for i in range(3))
    sizes = np.array([len(p[3]) for p in pieces], "i8")
    starts, whole = np.cumsum(sizes) - sizes, b"".join(p[3] for p in pieces)
    key, first, last, several = runs(np.frombuffer(whole, "u1"), starts, sizes)
    piece = np.searchsorted(starts, first, side="right") - 1
    # stretches of neighbouring runs that may repeat
    new = several & ~np.r_[False, several[:-1] & (first[1:] == last[:-1] + 1) & (piece[1:] == piece[:-1])] if len(first) else several
    begin, until = first[new], last[several & ~np.r_[(several & ~new)[1:], False]] if len(first) else last
    own = piece[new]
    where = offset[own] + begin - starts[own]
    shard = Shard([(d, t, o, whole[a : z + WINDOW]) for d, t, o, a, z in zip(doc[own].tolist(), text_key[own].tolist(), where.tolist(), begin.tolist(), until.tolist(), strict=True)])
    again = np.flatnonzero(shard.repeats)
    stretch = np.searchsorted(shard.starts, again, side="right") - 1
    leads = np.zeros(len(whole) + 1, "i8")  # 1 at each window that is the first of its class
    leads[_covered(first, last)] = 1
    leads[begin[stretch] + again - shard.starts[stretch]] = 0
    at = np.flatnonzero(leads)
    count = np.r_[0, np.cumsum(leads)]
    some = count[last + 1] > count[first]
    key, first, last = key[some], first[some], last[some]
    # a run shrinks to what lies between its first and its last first window
    first, last = at[count[first]], at[count[last + 1] - 1]
    made = b"".join([hashlib.blake2b(whole[a:z], digest_size=16).digest() for a, z in zip(first.tolist(), (last + WINDOW).tolist(), strict=True)])
    context = np.frombuffer(made, "<i8").reshape(-1, 2)
    piece = np.searchsorted(starts, first, side="right") - 1
    place = offset[piece] + first - starts[piece]
    r = shard.spans(shard.repeats)
    scattered = _mixed(r[0].astype("u8") ^ (r[2].astype("u8") << np.uint64(40))).view("i8")  # spreads rows that need no key
    none = np.zeros(len(r[0]), "i8")
    columns = (key, scattered), (context[:, 0], none), (context[:, 1], none), (doc[piece], r[0]), (text_key[piece], r[1]), (place, r[2]), (place + last - first, r[3]), (np.zeros(len(key)), np.ones(len(none)))
    types = ("i8", "i8", "i8", "i8", "i8", "i8", "i8", "i1")
    return pa.table({n: np.concatenate(c).astype(t) for n, c, t in zip(_NAMES, columns, types, strict=True)})


def _keyed(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    pieces, size = [], 0
    for batch in batches:
        for doc, tk, text in zip(batch["doc"].to_pylist(), batch["text_key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            for at in range(0, len(data) - WINDOW + 1, shard_bytes):
                piece = data[at : at + shard_bytes + WINDOW - 1]
                if size + len(piece) > shard_bytes + WINDOW and pieces:
                    yield from _shard_rows(pieces).to_batches(max_chunksize=50_000)
                    pieces, size = [], 0
                pieces.append((doc, tk, at, piece))
                size += len(piece)
    if pieces:
        yield from _shard_rows(pieces).to_batches(max_chunksize=50_000)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows at least, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram, context, doc, text_key, first. Out: repeats (kind 1), and the first contexts of grams
    that have several (kind 0). Only the last first context is kept between batches."""
    before = None  # the last first context; kind 3: it was given out already
    for batch in gathered(batches, 20_000):
        p = batch.to_pandas()
        if before is not None:
            p = pd.concat([before, p], ignore_index=True)
        passed = p["kind"].to_numpy() == 1
        own = p[~passed].reset_index(drop=True)
        out = [p[passed]]
        before = None
        if len(own):
            gram = own["gram"].to_numpy()
            new = np.r_[True, gram[1:] != gram[:-1]]
            for c in ("context", "more"):
                x = own[c].to_numpy()
                new[1:] |= x[1:] != x[:-1]
            place = own[["doc", "text_key", "first"]].to_numpy()
            lead = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
            repeat = own[~new & ~(place == place[lead]).all(1)].copy()  # a repeated row is its own first
            repeat["kind"] = np.int8(1)
            firsts = own[new].reset_index(drop=True)
            g, kind = firsts["gram"].to_numpy(), firsts["kind"].to_numpy()
            ready = np.r_[False, g[1:] == g[:-1]] | np.r_[g[1:] == g[:-1], False] | (kind == 3)
            give = firsts[ready & (kind != 3)].copy()
            out += [repeat, give]
            before = firsts.iloc[[-1]].copy()
            if ready[-1]:
                before["kind"] = np.int8(3)
        made = pd.concat(out, ignore_index=True)
        if len(made):
            yield pa.RecordBatch.from_pandas(made[_NAMES], schema=batch.schema, preserve_index=False)


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first 128 bytes at least (Larsson-Sadakane refinement), ties by position, and whether each
    shares its first 64 bytes with the one before; what is behind the end counts as bytes of 255, which no text in UTF-8
    has."""
    n = len(data)
    if not n:
        return np.empty(0, "i8"), np.empty(0, bool)
    first = _eights(np.r_[data, np.full(8, 255, "u1")], ">u8")[:n]
    order = np.argsort(first)
    key = first[order]
    rank, shared = np.full(n + 128, n, "u4"), np.zeros(n, bool)
    open_, sorted_to = np.arange(n), 8  # places of groups that are not sorted yet
    while True:
        new = np.r_[True, key[1:] != key[:-1]]
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        if sorted_to == 64:
            shared[open_[~new]] = True
        open_ = open_[~new | ~np.r_[new[1:], True]]
        at = order[open_]
        if sorted_to == 128 or not len(open_):
            order[open_] = at[np.lexsort((at, rank[at]))]
            return order, shared
        key = (rank[at].astype("u8") << np.uint64(32)) | rank[at + sorted_to]
        by = np.argsort(key)
        order[open_], key, sorted_to = at[by], key[by], 2 * sorted_to


def common_prefixes(data: np.ndarray, order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Per sorted place the common prefix with the place before, where they share 64 bytes (0 elsewhere), or WINDOW at least where it is longer than STRIDE.
    Kasai's rule: one position later both suffixes share one byte less, so bytes are compared only where the neighbour is
    not simply the next one, and anew after STRIDE positions, so that long repeats are followed from many places at once."""
    n = len(data)
    before = np.full(n, -1, "i4")
    before[order[1:][shared[1:]]] = order[:-1][shared[1:]]
    place = np.flatnonzero(before >= 0)
    full = np.zeros(n, "i4")
    if len(place):
        prior = before[place]
        chain = np.r_[False, (place[1:] == place[:-1] + 1) & (prior[1:] == prior[:-1] + 1)] & (place % STRIDE > 0)
        head = np.flatnonzero(~chain)
        length, active = np.full(len(head), 64, "i8"), np.arange(len(head))
        eights = _eights(np.r_[data, np.zeros(8, "u1")], "<u8")[: n + 1]
        while len(active):
            x, y = place[head[active]] + length[active], prior[head[active]] + length[active]
            differ = eights[np.minimum(x, n)] ^ eights[np.minimum(y, n)]
            # equal low bytes: trailing zero bits of the difference
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, (np.log2(np.maximum(low, 1).astype("f8")) // 8).astype("i8"))
            step = np.minimum(same, np.maximum(n - np.maximum(x, y), 0))
            length[active] += step
            active = active[(step == 8) & (length[active] < STRIDE + WINDOW)]
        own = np.cumsum(~chain) - 1
        full[place] = length[own] - (place - place[head[own]])
    return full[order]


def _blocks_of(pdf: pd.DataFrame, block_bytes: int) -> Iterator[Shard]:
    pieces, size = [], 0
    for r in zip(pdf["doc"].tolist(), pdf["text_key"].tolist(), pdf["first"].tolist(), pdf["bytes"], strict=True):
        pieces.append(r)
        size += len(r[3])
        if size >= block_bytes:
            yield Shard(pieces)
            pieces, size = [], 0
    if pieces:
        yield Shard(pieces)


def _later(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Whether the places (doc, text_key, place) of a come behind those of b."""
    return (a[0] > b[0]) | (a[0] == b[0]) & ((a[1] > b[1]) | (a[1] == b[1]) & (a[2] > b[2]))


def _merged_spans(pdf: pd.DataFrame, block_bytes: int) -> pd.DataFrame:
    """Repeats among the contexts of a bucket: distinct windows, sorted, with their earliest place so far; the sorted
    windows of each further block are looked up among them by binary search."""
    known, places = None, None
    out: list[tuple] = []
    for shard in _blocks_of(pdf, block_bytes):
        out.append(shard.spans(shard.repeats))
        windows, own = shard.windows(shard.leads), list(shard.places(shard.leads))
        if known is None:
            known, places = windows, own
            continue
        at = np.minimum(np.searchsorted(known, windows), max(len(known) - 1, 0))
        found = known[at] == windows if len(known) else np.zeros(len(windows), bool)
        there = at[found]
        mine, theirs = [x[found] for x in own], [x[there] for x in places]
        later, earlier = _later(mine, theirs), _later(theirs, mine)
        for x, which in ((mine, later), (theirs, earlier)):
            out.append((x[0][which], x[1][which], x[2][which], x[2][which]))
        for x, y in zip(places, mine, strict=True):
            x[there[earlier]] = y[earlier]
        into = np.searchsorted(known, windows[~found])
        known, places = np.insert(known, into, windows[~found]), [np.insert(x, into, y[~found]) for x, y in zip(places, own, strict=True)]
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, "i8")] * 4
    return _joined(*columns)


def _joined(doc: np.ndarray, text_key: np.ndarray, first: np.ndarray, last: np.ndarray) -> pd.DataFrame:
    """doc, text_key, lo, hi (bytes) of windows, neighbours as one span."""
    by = np.lexsort((last, first, text_key, doc))
    doc, text_key, first, last = doc[by], text_key[by], first[by], last[by]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (text_key[1:] != text_key[:-1]) | (first[1:] > last[:-1] + 1)]) if len(doc) else np.empty(0, "i8")
    return pd.DataFrame({"doc": doc[new], "text_key": text_key[new], "lo": first[new], "hi": (np.maximum.reduceat(last, new) if len(new) else last) + WINDOW})


def _distinct_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block of one key's contexts: its distinct windows and their first places (kind 0), and its repeats (kind 1)."""
    shard = Shard(list(zip(pdf["doc"].tolist(), pdf["text_key"].tolist(), pdf["first"].tolist(), pdf["bytes"], strict=True)))
    doc, text_key, place = shard.places(shard.leads)
    one = pd.DataFrame({"window": [bytes(shard.data[a : a + WINDOW]) for a in shard.leads.tolist()], "doc": doc, "text_key": text_key, "lo": place, "hi": place + WINDOW})
    again = _joined(*shard.spans(shard.repeats))
    again.insert(0, "window", None)
    return pd.concat([one, again], ignore_index=True)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that a text was asked for."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            data = (r["text"] or "").encode("utf-8", "surrogatepass")
            rows += [(c["gram"], r["doc"], r["text_key"], c["first"], data[c["first"] : c["last"] + WINDOW]) for c in r["wanted"]]
        columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in range(5)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["gram", "doc", "text_key", "first", "bytes"])


def repeated_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """doc, text_key, spans (array of struct lo, hi; bytes, may overlap): docs has doc (no nulls), text_key, text."""
    rows = docs.mapInArrow(lambda it: _keyed(it, shard_bytes), "gram long, context long, more long, doc long, text_key long, first long, last long, kind tinyint")
    dealt = rows.repartition("gram").sortWithinPartitions("gram", "context", "more", "doc", "text_key", "first")
    known = materialize(dealt.mapInArrow(_compared, rows.schema), "runs")
    whole = known.where("kind = 1").select("doc", "text_key", F.col("first").alias("lo"), (F.col("last") + WINDOW).alias("hi"))
    first = known.where("kind = 0")
    wanted = first.groupBy("doc", "text_key").agg(F.collect_list(F.struct("gram", "first", "last")).alias("wanted"))
    contexts = materialize(docs.join(wanted, ["doc", "text_key"]).select("doc", "text_key", "text", "wanted").mapInArrow(_contexts, "gram long, doc long, text_key long, first long, bytes binary"), "contexts")
    total = contexts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    hot = materialize(contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_contexts), "hot-keys")
    n_buckets = max(1, -(-total // (4 * block_bytes)))
    span = "doc long, text_key long, lo long, hi long"
    cold = contexts.join(hot, "gram", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(n_buckets)))
    spans = cold.groupBy("bucket").applyInPandas(lambda pdf: _merged_spans(pdf, block_bytes), span)
    if not hot.isEmpty():
        blocks = join_groups(contexts, hot, ["gram"], "n").withColumn("block", F.pmod(F.xxhash64("doc", "text_key", "first"), F.ceil(F.col("n") / F.lit(hot_contexts))).cast("int"))
        found = materialize(blocks.groupBy("gram", "block").applyInPandas(_distinct_windows, "window binary, doc long, text_key long, lo long, hi long"), "hot-windows")
        place = F.struct("doc", "text_key", "lo")
        firsts = found.where("window IS NOT NULL").groupBy("window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        later = join_groups(found.where("window IS NOT NULL"), materialize(firsts, "hot-firsts"), ["window"], "n").where(place != F.col("first"))
        spans = spans.unionByName(found.where("window IS NULL").drop("window")).unionByName(later.select("doc", "text_key", "lo", "hi"))
    spans = spans.unionByName(whole)
    return spans.groupBy("doc", "text_key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    for batch in batches:
        sizes, removed, digests, found = [], [], [], []
        for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            cuts = merged(spans or [])
            at, digest = 0, hashlib.sha256()
            for lo, hi in cuts:
                digest.update(data[at:lo])
                at = hi
            digest.update(data[at:])
            sizes.append(len(data))
            removed.append(sum(hi - lo for lo, hi in cuts))
            digests.append(digest.hexdigest())
            found.append([{"lo": lo, "hi": hi} for lo, hi in cuts])
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(found, kind)], names=["doc_id", "n_bytes", "n_removed", "kept_sha256", "spans"])


def keyed_texts(docs: DataFrame, bits: int = 63) -> DataFrame:
    """docs with doc (the smallest long for a null doc_id) and text_key, which tell different texts and ids apart: where texts
    of one doc_id share a key (their SHA-256 differs), all keys are drawn anew with another salt. The keys of a null doc_id
    are negative, all others not. bits is for tests: few bits make keys meet often."""
    with_key = lambda salt: F.shiftrightunsigned(F.xxhash64(F.lit(salt), "text"), 64 - bits)
    salt = 0
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        own = F.sha2(F.coalesce("text", F.lit("")), 256)
        while not docs.groupBy("doc_id", with_key(salt)).agg(F.min(own).alias("low"), F.max(own).alias("high")).where("low <> high").isEmpty():
            salt += 1
    key = with_key(salt)
    return docs.withColumn("doc", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("text_key", F.when(F.col("doc_id").isNull(), -1 - key).otherwise(key))


def deduplicate_substrings(docs: DataFrame, key_bits: int = 63, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, kept_sha256, spans (maximal removed byte ranges): a row per row of docs. sizes: those of
    `repeated_spans`."""
    with small_batches(docs.sparkSession):
        return _deduplicated(docs, key_bits, sizes)


def _deduplicated(docs: DataFrame, key_bits: int, sizes: dict[str, int]) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = keyed_texts(docs, key_bits)
    spans = repeated_spans(keyed.select("doc", "text_key", "text"), **sizes)
    kept = keyed.join(spans, ["doc", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, kept_sha256 string, spans array<struct<lo:long,hi:long>>")
    return materialize(kept, "kept")


def op2_suffix_dedup(spark, sf_dir):
    return deduplicate_substrings(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE_SQL: dict[str, str] = {}
