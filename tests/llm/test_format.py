import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import chat, mixing, packing, vector_search

from .helpers import awkward, frame

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "back\\slash\\", "<<SYS>>\\</s>", "\\<\\/s>", "<</SYS>><s><<s>", None, "a\nb"]


def test_chat_round_trip(spark):
    r = random.Random(1)
    turns = [(c, t, r.choice(["user", "assistant", "system", None, "<|end|>"]), r.choice(TEXTS)) for c in range(40) for t in range(r.randrange(1, 6))]
    turns += [(99, None, "assistant", "x"), (99, 1, "assistant", "x"), (99, 1, "assistant", "x"), (None, 0, "user", "y")]
    table = spark.createDataFrame([(*t, "c") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    examples = chat.examples(table)
    by_conv = defaultdict(list)
    for c, t, role, text in turns:
        by_conv[c].append((t is not None, t or 0, role or "", text or ""))
    for c, rows in by_conv.items():
        rows.sort()
    seen = defaultdict(list)
    for e in sorted(examples.withColumn("turns", chat.read_back(F.col("formatted"))).collect(), key=lambda e: (e.conv_id is not None, e.conv_id or 0, e.nth)):
        own = [x[2:] for x in by_conv[e.conv_id]]
        got = [(t.role, t.text) for t in e.turns]
        assert got == own[: len(got)]
        if e.loss_length is not None:
            assert got[-1][0] == "assistant"
            seen[e.conv_id].append(len(got))
            masked = e.formatted[e.loss_start : e.loss_start + e.loss_length]
            assert not any(x in masked for x in chat.CONTROL)
    for c, rows in by_conv.items():
        assert seen[c] == [i + 1 for i, x in enumerate(rows) if x[2] == "assistant"]
    assert chat.summary(examples).count() == len(by_conv)
    assert chat.summary(chat.examples(table.limit(0))).count() == 0


def test_escape_is_reversible_and_hides_control_strings(spark):
    r = random.Random(4)
    texts = ["".join(r.choice([*chat.CONTROL, "\\", "<", "[", "a", "/"]) for _ in range(8)) for _ in range(300)]
    for t in spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert t.u == t.t and not any(c in t.e for c in chat.CONTROL)


def test_packing(spark):
    rows = awkward()
    out = packing.pack(frame(spark, rows), packing.default_tokenizer(), 64, with_ids=True)
    got = [r.asDict() for r in out.collect()]
    tokenizer = packing.encoder(packing.default_tokenizer()).tokenizer
    expected = Counter()
    for d, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 64):
            expected[d, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes()), len(ids)] += 1
    assert Counter((g["doc_id"], g["start"], g["length"], g["ids_crc32"], g["doc_tokens"]) for g in got) == expected
    by_sequence = defaultdict(list)
    for g in got:
        by_sequence[g["sequence_id"]].append(g)
    for pieces in by_sequence.values():
        at = 0
        for g in sorted(pieces, key=lambda g: g["offset"]):
            assert g["offset"] == at
            at += g["length"]
        assert at <= 64
    built = packing.sequences(out, 64).collect()
    assert len(built) == len(by_sequence) and all(len(b.input_ids) == 64 or len(b.input_ids) & (len(b.input_ids) - 1) == 0 for b in built)
    assert packing.pack(frame(spark, []), packing.default_tokenizer()).count() == 0


def test_patterns_hold_every_length():
    r = random.Random(2)
    for most in (1, 8, 50, 2048):
        histogram = Counter(r.randrange(1, most + 1) for _ in range(3000))
        found = packing.patterns(dict(histogram), most)
        held = Counter()
        for n, lengths in found:
            assert sum(lengths) <= most
            for x in lengths:
                held[x] += n
        assert held == histogram


def test_fast_ids_equal_the_tokenizers_library():
    r = random.Random(7)
    e = packing.encoder(packing.default_tokenizer())
    assert e.fast is not None
    alphabet = [*" \n\t  ab1!'", "'s", "é", "\xa0", "\x1c", "\x85", "　", "漢", "🙂", "<|endoftext|>", "İ"]
    for _ in range(2000):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(16)))
        assert e.ids(t).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_fast_encoding_of_whole_texts_and_long_runs():
    e = packing.encoder(packing.default_tokenizer())
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()
    n = packing.LONG_RUN
    for (t,) in [*texts, *((x * k,) for x in ("a", " ", "ab ", "é", "\n", "1") for k in (n - 1, n, n + 1))]:
        assert e.ids(t).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("max_len", [16, 64])
def test_packing_against_packing_piece_by_piece(max_len):
    """Shortest pack first without a histogram: each piece, longest first, on the least filled sequence with room."""
    r = random.Random(max_len)
    for _ in range(40):
        lengths = [r.randrange(1, max_len + 1) if r.random() < 0.7 else r.choice([1, 3, max_len // 2]) for _ in range(r.randrange(1, 300))]
        found = packing.patterns(Counter(lengths), max_len)
        packed = Counter()
        for n, pattern in found:
            assert n > 0 and sum(pattern) <= max_len
            for x in pattern:
                packed[x] += n
        assert packed == Counter(lengths)
        plain = []
        for x in sorted(lengths, reverse=True):
            room = [i for i, used in enumerate(plain) if used + x <= max_len]
            if room and min(plain) + x <= max_len:
                plain[min(room, key=lambda i: plain[i])] += x
            else:
                plain.append(x)
        assert sum(n for n, _ in found) <= len(plain)


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_mixing(spark, bucket_rows):
    rows = awkward()
    out = mixing.mix(frame(spark, rows), bucket_rows=bucket_rows).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for d, t, s in rows:
        sizes[s] += len((t or "").replace("\n", " ").replace("\t", " ").split(" ")) - (t or "").replace("\n", " ").replace("\t", " ").split(" ").count("")
    by_source = defaultdict(int)
    source_of = {(d, len(t or "")): s for d, t, s in rows}
    assert source_of and sum(r.size for r in out) == sum(sizes.values())
    targets = {r.source_size: r.target for r in out}
    assert sum({s: targets[sizes[s]] for s in sizes}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-6
        by_source[r.source_size] += r.taken
    largest = max(r.size for r in out)
    for size, taken in by_source.items():
        assert abs(taken - targets[size]) <= largest
    again = mixing.mix(frame(spark, list(reversed(rows))).repartition(3), bucket_rows=bucket_rows).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in out)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1)], "doc_id long, quality int")
    mixed = mixing.mixed_documents(frame(spark, rows), labels)
    assert mixed.columns == frame(spark, rows).columns and mixed.count() > 0
    assert mixing.mix(frame(spark, [])).count() == 0


def shared_again(sizes):
    """{source: target}: the budget by weight; what sources above their cap leave is shared again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    cap = {s: 2 * n for s, n in sizes.items()}
    expected, open_, left = {}, set(weight), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap[s]}
        if not over:
            return expected | share
        for s in over:
            expected[s] = cap[s]
            left -= cap[s]
        open_ -= over


@pytest.mark.parametrize("n", [0, 1, 2, 5, 20, 1000])
@pytest.mark.parametrize("kind", ["lopsided", "equal", "random"])
def test_water_filling(spark, n, kind):
    r = random.Random(n)
    size = {"lopsided": lambda i: (100, 1000, 50, 400, 0)[i % 5] * (i + 1), "equal": lambda i: 250, "random": lambda i: int(r.paretovariate(0.7) * 10)}[kind]
    sizes = {(None if i == 3 else f"s{i}"): size(i) for i in range(n)}
    got = {x.source: x.target for x in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(shared_again(sizes) if n else {})
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values())) and all(0 <= got[s] <= 2 * sizes[s] for s in sizes)


@pytest.mark.parametrize("n_sources", [1, 2, 20, 300])
def test_mix_meets_its_targets(spark, n_sources):
    r = random.Random(n_sources)
    rows = [(i if i % 50 else None, " ".join(["w"] * r.randrange(0, 40)) + f" {i}", f"s{r.randrange(n_sources)}" if r.random() < 0.7 else "s0") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 3000, 3)], "doc_id long, quality int")
    out = mixing.mix(frame(spark, rows), labels, bucket_rows=100).collect()
    assert len(out) == len(rows)
    totals, taken, target = Counter(), Counter(), {}
    for d, t, s in rows:
        totals[s] += len(t.split())
    expected = shared_again(totals)
    by_size = {}
    for s, n in totals.items():
        by_size.setdefault(n, []).append(expected[s])
    for x in out:
        assert 0 <= x.taken <= 2 * x.size and any(x.target == pytest.approx(e) for e in by_size[x.source_size])
        taken[x.source_size, round(x.target, 3)] += x.taken
        target[x.source_size, round(x.target, 3)] = x.target
    largest = max(x.size for x in out)
    for key, n in taken.items():
        sources = sum(1 for e in by_size[key[0]] if round(e, 3) == key[1])
        assert abs(n - sources * target[key]) <= sources * largest


def test_mix_of_one_source_of_most_rows_among_very_many(spark):
    rows = [(i, "w " * (1 + i % 5), "big" if i % 10 else f"s{i}", 1) for i in range(20_000)] + [(20_000, "x", "", 1), (20_001, "x", None, 1), (20_002, "x", "big", 1)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, of long")).collect()
    assert sorted(x.doc_id for x in out) == list(range(20_003))
    totals = Counter()
    for _, t, s, _ in rows:
        totals[s] += len(t.split())
    expected, source = shared_again(totals), {d: s for d, _, s, _ in rows}
    assert all(x.source_size == totals[source[x.doc_id]] and x.target == pytest.approx(expected[source[x.doc_id]]) for x in out)
    assert sum(x.taken for x in out if source[x.doc_id] == "big") == pytest.approx(expected["big"], abs=5)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_mixing_query_against_its_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    sql = mixing.ORACLE_SQL["op10_mixing"]
    expected = {x[0]: x[1:] for x in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({sql})").fetchall()}
    out = mixing.op10_mixing(spark, folder).collect()
    assert {x.doc_id: (x.size, x.source_size, x.target, x.taken) for x in out} == expected
    assert sum(x.taken for x in out) > sum(x.size for x in out)


@pytest.mark.parametrize(("cell", "block", "query_block"), [(2, 8192, 2048), (16, 7, 5), (1000, 8192, 3), (1, 20, 4)])
def test_top_k(spark, cell, block, query_block):
    r = np.random.default_rng(5)
    vectors = r.integers(-30, 30, (150, 8))
    vectors[40:110] = vectors[40]
    rows = [(i, [float(x) / 64 for x in v]) for i, v in enumerate(vectors)] + [(200, None), (201, [1.0] * 7 + [float("nan")]), (202, [None] * 8), (203, [float("inf")] * 8), (None, [0.5] * 8), (204, [])]
    table = vector_search.whole_vectors(spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, id long"))
    assert table.count() == 150
    got = defaultdict(list)
    for x in vector_search.top_k(table, table.where("id % 10 = 0"), 20, cell, block, query_block).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x["rank"], x.vec_id, x.score))
    for q in range(0, 150, 10):
        scores = sorted((-int(vectors[q] @ vectors[i]), i) for i in range(150) if i != q)[:20]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert vector_search.top_k(table.limit(0), table.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8192, 40])
def test_top_k_of_repeated_ids(spark, block):
    r = np.random.default_rng(6)
    vectors = r.integers(-30, 30, (160, 8))
    vectors[40:110] = vectors[40]  # copies under ids of their own and under repeated ones
    ids = [i if i < 50 else 50 if i < 80 else i - 30 if i < 90 else i // 4 if i < 130 else i for i in range(160)]
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)]
    table = spark.createDataFrame(rows, "id long, vector array<long>")
    got = defaultdict(list)
    for x in vector_search.top_k(table, table.where("id % 5 = 0"), 20, 2, block, 16).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x["rank"], x.vec_id, x.score))
    assert set(got) == {i for i in ids if i % 5 == 0}
    for q in got:
        own = min(v for i, v in rows if i == q)
        scores = sorted((-int(np.dot(own, v)), i) for i, v in rows if i != q)[:20]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]


@pytest.mark.parametrize("most", [1e3, 1e9, 1e12, 1e300])
def test_top_k_of_large_components(spark, most):
    r = np.random.default_rng(8)
    rows = [(2**60 + i, (r.standard_normal(6) * (most if i % 3 else 1)).tolist()) for i in range(120)]
    rows += [(i, [1.0] * 4) for i in range(30)]  # another length
    table = vector_search.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {i: [max(-(2**62), min(2**62, math.floor(min(max(x * 64, -(2.0**62)), 2.0**62)))) for x in v] for i, v in rows}
    got = defaultdict(list)
    for x in vector_search.top_k(table, table.where("id % 10 = 0"), 20, 2, 16, 4).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score))
    assert set(got) == {i for i in whole if i % 10 == 0}
    for q in got:
        scores = [(sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
        assert got[q] == [(i, min(2**63 - 1, max(-(2**63), s))) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:20]]
