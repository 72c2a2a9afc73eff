"""Packing token sequences by shortest-pack-first over the length histogram.

Documents become token ids (a vocabulary file of the `tokenizers` library, its path a parameter) plus an end id. A
document longer than a sequence is cut into full sequences and one rest. Only the histogram of piece lengths (at most
`max_len` numbers) reaches the driver: lengths are placed longest first, each on the pattern with the fewest tokens that
still has room, and patterns are counted instead of sequences. Pieces then join the patterns by (length, rank among the
pieces of that length); ranks come from bucket counts, so no length is gathered in one task.

Defined results: null and empty texts are one end id; repeated rows (and a repeated or null doc_id) are documents of
their own; very long texts are tokenised as a whole; an empty table gives no sequence; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, read, small_batches

MAX_LEN = 2048
END_ID = 1
#: Fixed value: how byte-level vocabularies of this kind cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer runs of one kind of character go to the tokenizer file's own library.
LONG_RUN = 20_000


class Encoder:
    """Ids of whole texts by a tokenizer file. Where the file holds a plain byte-level BPE whose ids are its merge ranks,
    `tiktoken` gives the same ids in a fraction of the time; texts with a special token's string, and files of any other
    kind, are encoded by `tokenizers` itself, and so is everything where `tiktoken` is not installed."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        try:
            import tiktoken
        except ModuleNotFoundError:
            return None

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        vocabulary = {t: i for t, i in model.get("vocab", {}).items() if t not in self.special} if model["type"] == "BPE" else {}
        merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model.get("merges", [])]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not spec.get("normalizer")
        if not plain or not merged or merged != sorted(merged) or merged[0] < 0 or len(set(merged)) < len(merged):
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves, then the others
        other = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks={bytes(byte[c] for c in t): i for t, i in vocabulary.items()}, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special) or _LONG.search(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_ordinary(text), "<u4")


_LONG = re.compile(r"\s{%d}|\S{%d}" % (LONG_RUN, LONG_RUN))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def _cut(batches: Iterator[pa.RecordBatch], path: str, max_len: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        out: list[tuple] = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            ids = np.append(enc.ids(text or ""), np.uint32(END_ID)).astype("<u4")
            for start in range(0, len(ids), max_len):
                piece = ids[start : start + max_len].tobytes()
                out.append((doc, start, len(piece) // 4, zlib.crc32(piece), len(ids), *([piece] if with_ids else [])))
        columns = list(zip(*out, strict=True)) or [()] * (5 + with_ids)
        types = [pa.int64()] * 5 + [pa.binary()] * with_ids
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids])


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids, little-endian unsigned 32-bit): a row per piece."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lambda it: _cut(it, tokenizer_path, max_len, with_ids), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def patterns(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in order): shortest pack first, over the histogram of lengths.

    Only patterns with room are kept in the heap; a pattern is split when a length fills part of its sequences."""
    heap: list[tuple[int, int, int, tuple]] = []
    done: list[tuple[int, list[int]]] = []
    tick = count()

    def put(used: int, n: int, lengths: tuple) -> None:
        if used == max_len:
            done.append((n, list(lengths)))
        else:
            heapq.heappush(heap, (used, next(tick), n, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and heap[0][0] + length <= max_len:
                used, _, n, lengths = heapq.heappop(heap)
                take = min(n, left)
                if take < n:
                    put(used, n - take, lengths)
                put(used + length, take, (*lengths, length))
                left -= take
            else:
                fit = max_len // length  # as many of this length as a sequence holds
                whole, rest = divmod(left, fit)
                if whole:
                    put(fit * length, whole, (length,) * fit)
                if rest:
                    put(rest * length, 1, (length,) * rest)
                left = 0
    return done + [(n, list(lengths)) for _, _, n, lengths in heap]


def slots(found: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) for each place of each pattern."""
    out, used, sequence = [], {}, 0
    for n, lengths in found:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            out.append((length, first, first + n - 1, sequence, offset))
            used[length], offset = first + n, offset + length
        sequence += n
    return out


def ranked(rows: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """rows (with a number `_row` each) with `rank`, from 0 among the rows of one length. A length of n rows is dealt to
    buckets of about sqrt(all rows): their counts give offsets, and only buckets are sorted."""
    bucket_rows = max(256, math.isqrt(sum(histogram.values())))
    buckets = rows.sparkSession.createDataFrame([(n, -(-m // bucket_rows)) for n, m in histogram.items()], "_at long, _buckets long")  # at most max_len rows
    rows = rows.join(F.broadcast(buckets), F.col("length") == F.col("_at")).withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.col("_buckets"))).drop("_at", "_buckets")
    totals = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = W.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32", "_row")
    return rows.withColumn("_nth", F.row_number().over(within) - 1).join(before, ["length", "_bucket"]).withColumn("rank", F.col("_before") + F.col("_nth")).drop("_bucket", "_before", "_nth", "_row")


#: More places than these are joined by a shuffle.
MOST_PLACES = 200_000


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, with_ids: bool = False) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset."""
    with small_batches(docs.sparkSession):
        cut = materialize(pieces(docs, tokenizer_path, max_len, with_ids).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    histogram = dict(cut.groupBy("length").count().collect())  # at most max_len rows
    found = slots(patterns(histogram, max_len))
    places = cut.sparkSession.createDataFrame(found, "at_length long, lo long, hi long, sequence long, offset long")
    places = F.broadcast(places) if len(found) <= MOST_PLACES else places
    rows = ranked(cut, histogram).join(places, (F.col("length") == F.col("at_length")) & F.col("rank").between(F.col("lo"), F.col("hi")))
    keep = [c for c in cut.columns if c not in ("ids", "_row")]
    return rows.select(*keep, (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame, max_len: int = MAX_LEN, pad_id: int = 0) -> DataFrame:
    """sequence_id, input_ids, doc_ids, lengths from `pack(..., with_ids=True)`; padded to max_len but at a power of two."""
    def build(pdf):
        import pandas as pd

        pdf = pdf.sort_values("offset")
        ids = np.frombuffer(b"".join(pdf["ids"]), "<u4").astype("int32")
        full = len(ids) if len(ids) & (len(ids) - 1) == 0 else max_len
        return pd.DataFrame({"sequence_id": [pdf["sequence_id"].iloc[0]], "input_ids": [np.pad(ids, (0, full - len(ids)), constant_values=pad_id)], "doc_ids": [list(pdf["doc_id"])], "lengths": [list(pdf["length"])]})

    return packed.groupBy("sequence_id").applyInPandas(build, "sequence_id long, input_ids array<int>, doc_ids array<long>, lengths array<long>")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"), default_tokenizer())


QUERIES = {"op6_packing": op6_packing}
ORACLE_SQL: dict[str, str] = {}
