"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and, so that inflected forms share one, the first `STEM` letters of longer words; both are
known by 64-bit digests. The examples are a bounded sample of labelled documents (`per_class` of each class). The vector space is
chosen with the labels: it has the terms whose presence depends on them beyond chance (a log-likelihood ratio of CHANCE or more,
tested for all terms of all examples), and as a background the terms that a fifth of the examples have. Within it, similarity is the plain cosine of TF-IDF vectors: the square root of a term's count times its inverse document
frequency, counted over all documents, normalised.

The inverted index lists, per term, the examples in blocks of similar ones with the largest weight of each block; the
lists of terms that `DENSE` or more of the examples hold are rows of a matrix instead. For a text, the matrix gives exact
parts of all cosines, and with the maxima these bound every block; blocks are read from the highest bound on until no
other block can change the k nearest, so the k similarities are exact. Votes are weighted by the inverse of distance; a
logistic curve makes them probabilities. It is fitted, at the classes' true rates, to votes that saw nothing of the example's label: by
the examples of other folds, over terms chosen without its fold. The neighbours are the evidence.

Texts of examples are never collected: their terms are counted in Spark, and of at most `most_terms` chosen terms the counts per
example reach the driver (2 * per_class * most_terms numbers at most, mostly a few per example). This index is
broadcast; every whole text is counted and then scored where it lies, without a shuffle.

Defined results: null and empty texts, and texts without any chosen term, get the classes' rate as score, and so do all texts
where no term is chosen; repeated
rows are scored each; label rows with null or other labels are ignored, of several labels of a document the larger
counts; with no labels, with one class only, or where the labelled documents of a class are missing, every score is that
rate (0.5 without labels); a null doc_id is not held out; an empty table gives an empty result; other columns are ignored
by `score` and kept by `without_toxic`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, read, small_batches
from .labelled import logistic, sample

STEM, BLOCK, DENSE, COMMON = 4, 64, 1 / 16, 1 / 5
#: The log-likelihood ratio that one term in 2000 reaches by chance.
CHANCE = 12.0
#: How near a vote may come.
NEAR = 0.02
#: Whether a character belongs to a word; from the end of the table on all do.
_IN_WORD = np.array([bool(re.match(r"\w", chr(c))) for c in range(0x3040)] + [True])
_BASE = 0x9E3779B97F4A7C15
#: Texts are counted and scored in parts of about so many characters and of so many texts at most.
_CHARS, _TEXTS = 400_000, 256


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[:1] = 1
    return np.multiply.accumulate(out)


class Terms:
    """Counted terms of texts. The digest of a word is a difference of running sums, moved to one place."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, "u8")

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and count of each distinct term of each text, sorted by text and term."""
        low = [(t or "").lower() for t in texts]
        code = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        if len(code) > len(self.up):
            n = max(len(code), _CHARS)
            self.up, self.down = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)
        edge = np.flatnonzero(np.diff(np.r_[False, _IN_WORD[np.minimum(code, len(_IN_WORD) - 1)], False]))
        first, size = edge[0::2], (edge[1::2] - edge[0::2])
        sums = np.zeros(len(code) + 1, "u8")
        np.cumsum(_mixed(code.astype("u8") + np.uint64(1)) * self.up[: len(code)], out=sums[1:])
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in low]), first, side="right")
        long = size > STEM
        digest = lambda at, n, kind: _mixed((sums[at + n] - sums[at]) * self.down[at] + n.astype("u8") + np.uint64(kind))
        term = np.r_[digest(first, size, 0), digest(first[long], np.full(long.sum(), STEM), 1 << 40)]
        owner = np.r_[owner, owner[long]]
        order = np.argsort(term)
        order = order[np.argsort(owner[order], kind="stable")]
        owner, term = owner[order], term[order]
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])]) if len(term) else np.empty(0, "i8")
        return owner[new], term[new], np.diff(np.r_[new, len(term)])


def parts_of(texts: pa.Array) -> Iterator[list[str | None]]:
    """Texts in parts; of a whole batch, only one part's texts are Python strings at a time."""
    for start in range(0, len(texts), _TEXTS):
        part, size = [], 0
        for t in texts.slice(start, _TEXTS).to_pylist():
            part.append(t)
            size += len(t or "")
            if size >= _CHARS:
                yield part
                part, size = [], 0
        if part:
            yield part


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, y, terms, counts: a row per sampled document."""
    terms = Terms()
    for batch in batches:
        owner, term, n = terms.of(batch["text"].to_pylist())
        cuts = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], pa.ListArray.from_arrays(cuts, pa.array(term.view("i8"))), pa.ListArray.from_arrays(cuts, pa.array(n, pa.int64()))], names=["doc_id", "y", "terms", "counts"])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


@dataclass
class Index:
    """Examples sorted so that similar ones share blocks. A list is what one term has in one block: lists of a term and
    postings of a list lie side by side, and each list has its largest weight."""

    vocabulary: np.ndarray  # sorted digests
    weight: np.ndarray  # of terms
    doc_ids: np.ndarray
    labels: np.ndarray
    dense: np.ndarray  # row of the matrix of each term, or -1
    matrix: np.ndarray  # weights by row and example, whole blocks
    lists: np.ndarray  # where the lists of each term start, and the end
    blocks: np.ndarray  # of lists
    highest: np.ndarray  # of lists
    postings: np.ndarray  # where the postings of each list start, and the end
    examples: np.ndarray  # of postings
    weights: np.ndarray  # of postings
    k: int
    prior: float

    @classmethod
    def build(cls, vocabulary: np.ndarray, weight: np.ndarray, docs: np.ndarray, labels: np.ndarray, own: np.ndarray, terms: np.ndarray, tf: np.ndarray, k: int, prior: float) -> Index:
        """own, terms, tf: example, term and count of each posting, sorted by example."""
        w = np.sqrt(tf) * weight[terms]
        w = w / np.sqrt(np.bincount(own, w * w, len(docs)))[own]
        held_by = np.bincount(terms, minlength=len(vocabulary))
        # examples of one heaviest term (of those that others hold too) are neighbours
        by_weight = np.lexsort((w * (held_by[terms] > 1), own))
        last = np.searchsorted(own[by_weight], np.arange(len(docs)), side="right") - 1
        main = np.where(np.bincount(own, minlength=len(docs)) > 0, terms[by_weight[last]], -1)
        order = np.lexsort((docs, main, labels))
        place = np.empty(len(docs), "i8")
        place[order] = np.arange(len(docs))
        n_blocks = -(-len(docs) // BLOCK)
        often = held_by >= max(2, len(docs) * DENSE)
        dense = np.where(often, np.cumsum(often) - 1, -1)
        matrix = np.zeros((often.sum(), n_blocks * BLOCK))
        at = place[own]
        full = often[terms]
        matrix[dense[terms[full]], at[full]] = w[full]
        at, terms, w = at[~full], terms[~full], w[~full]
        sort = np.lexsort((at, terms))
        at, terms, w = at[sort], terms[sort], w[sort]
        block = at // BLOCK
        new = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])]) if len(at) else np.empty(0, "i8")
        highest = np.maximum.reduceat(w, new) if len(at) else np.empty(0)
        lists = np.searchsorted(terms[new], np.arange(len(vocabulary) + 1))
        return cls(vocabulary, weight, docs[order], labels[order], dense.astype("i4"), matrix, lists.astype("i4"), block[new].astype("i4"), highest, np.r_[new, len(at)].astype("i4"), at.astype("i4"), w, k, prior)

    def known(self, owner: np.ndarray, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same with numbers of terms, without terms that no example has."""
        order = np.argsort(term)
        at = np.empty(len(term), "i8")
        at[order] = np.searchsorted(self.vocabulary, term[order])
        ok = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == term
        return owner[ok], at[ok], n[ok]

    def query(self, terms: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Normalised weights of a document's terms."""
        q = np.sqrt(n) * self.weight[terms]
        return q / np.sqrt(q @ q)

    def dense_parts(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the matrix adds to the cosine of each query and each example."""
        q = np.zeros((len(queries), len(self.matrix)))
        for i, (terms, x) in enumerate(queries):
            rows = self.dense[terms]
            q[i, rows[rows >= 0]] = x[rows >= 0]
        return q @ self.matrix

    def nearest(self, terms: np.ndarray, q: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples of positive similarity; ties go to the earlier position.
        scores: the query's row of `dense_parts`."""
        sparse = self.dense[terms] < 0
        terms, q = terms[sparse], q[sparse]
        n_lists = self.lists[terms + 1] - self.lists[terms]
        own = _ranges(self.lists[terms], n_lists)
        blocks, weight = self.blocks[own], np.repeat(q, n_lists)
        n_blocks = len(scores) // BLOCK
        bounds = np.bincount(blocks, weight * self.highest[own], n_blocks) + scores.reshape(n_blocks, BLOCK).max(1)
        order = np.argsort(-bounds, kind="stable")
        best_at, best = np.empty(0, "i8"), np.empty(0)
        done, step = 0, 2 + 2 * k // BLOCK
        while done < n_blocks:
            least = best[-1] - 1e-9 if len(best) == k else 0.0
            now = order[done : done + step]
            now = now[bounds[now] > max(least, 0.0)]
            if not len(now):
                break
            chosen = np.zeros(n_blocks, bool)
            chosen[now] = True
            mine = np.flatnonzero(chosen[blocks])
            mine, x = own[mine], weight[mine]
            sizes = self.postings[mine + 1] - self.postings[mine]
            p = _ranges(self.postings[mine], sizes)
            more = np.bincount(self.examples[p], np.repeat(x, sizes) * self.weights[p], len(scores)).reshape(n_blocks, BLOCK)[now]
            total = (more + scores.reshape(n_blocks, BLOCK)[now]).ravel()
            at = np.flatnonzero(total > least)
            best_at, best = np.r_[best_at, now[at // BLOCK] * BLOCK + at % BLOCK], np.r_[best, total[at]]
            if len(best) > k:
                cut = np.partition(best, len(best) - k)[len(best) - k]
                best_at, best = best_at[best >= cut], best[best >= cut]
            top = np.lexsort((best_at, -best))[:k]
            best_at, best = best_at[top], best[top]
            done, step = done + step, 8 * step
        return best_at, best

    def vote(self, at: np.ndarray, similar: np.ndarray) -> float | None:
        """Between -1 and 1: the mean label of the neighbours, weighted by inverse distance; None without neighbours."""
        near = 1 / (NEAR + np.maximum(0, 1 - similar))
        return float(near @ (2.0 * self.labels[at] - 1) / near.sum()) if len(at) else None


@dataclass
class Model:
    """An index, held by the executors (None: nothing to compare with), and the curve from votes to probabilities."""

    index: Broadcast | None
    curve: tuple[float, float]
    prior: float

    def probability(self, vote: float | None) -> float:
        if vote is None:
            return self.prior
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * vote, -30, 30))))


def document_counts(docs: DataFrame, vocabulary: np.ndarray, width: int = 8192) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are; summed in slices of the
    vocabulary, so that a task and the driver hold a number per term."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total, n = Terms(), np.zeros(size, "i8"), 0
        for batch in batches:
            for part in parts_of(batch["text"]):
                term = np.sort(terms.of(part)[1])
                at = np.minimum(np.searchsorted(held.value, term), size - 1)
                total += np.bincount(at[held.value[at] == term], minlength=size)
            n += batch.num_rows
        slices = [(i // width, total[i : i + width].astype("<i8").tobytes()) for i in range(0, size, width)] + [(-1, np.array([n], "<i8").tobytes())]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in slices], pa.int32()), pa.array([b for _, b in slices], pa.binary())], names=["slice", "counts"])

    def add(pdf):
        import pandas as pd

        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "counts": [sum(np.frombuffer(x, "<i8") for x in pdf["counts"]).astype("<i8").tobytes()]})

    slices = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "slice int, counts binary")
    summed = {r["slice"]: np.frombuffer(r["counts"], "<i8") for r in slices.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect()}  # 8 bytes a term
    held.destroy()
    out = [summed.get(i, np.zeros(min(width, size - i * width), "i8")) for i in range(-(-size // width))]
    return np.concatenate([np.empty(0, "i8"), *out]), int(summed.get(-1, np.zeros(1, "i8"))[0])


def _strength(toxic: Column, clean: Column, n1: Column, n0: Column) -> Column:
    """How much a term's presence depends on the label: the log-likelihood ratio of its two-by-two table."""
    n, held = n1 + n0, toxic + clean
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (part(toxic, held * n1 / n) + part(clean, held * n0 / n) + part(n1 - toxic, (n - held) * n1 / n) + part(n0 - clean, (n - held) * n0 / n))


def vocabulary_of(examples: DataFrame, folds: int, most_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """The terms whose presence depends on the label beyond chance and those that COMMON of the examples have, sorted; and a
    column for the whole sample and one for the sample without each fold, which tell in which of them a term was chosen.
    At most the strongest `most_terms` of each are kept."""
    each = examples.select("y", "fold", F.explode("terms").alias("term"))
    seen = lambda y, f: F.count_if((F.col("y") == y) & (F.lit(True) if f is None else F.col("fold") != f))
    sets: list[int | None] = [None, *range(folds)]
    counts = each.groupBy("term").agg(*(seen(y, f).alias(f"n{y}_{i}") for i, f in enumerate(sets) for y in (0, 1))).where("n0_0 + n1_0 > 1")
    counts = materialize(counts, "term-counts")
    total = examples.agg(*(seen(y, f).alias(f"n{y}_{i}") for i, f in enumerate(sets) for y in (0, 1))).first()
    chosen = {}
    for i in range(len(sets)):
        strength = _strength(F.col(f"n1_{i}"), F.col(f"n0_{i}"), F.lit(float(total[f"n1_{i}"])), F.lit(float(total[f"n0_{i}"])))
        common = F.col(f"n1_{i}") + F.col(f"n0_{i}") >= COMMON * (total[f"n1_{i}"] + total[f"n0_{i}"])
        for r in counts.where(common | (strength > CHANCE)).select("term", strength.alias("s")).orderBy(F.desc("s"), "term").limit(most_terms).collect():  # at most most_terms
            chosen.setdefault(r["term"], set()).add(i)
    terms = np.array(sorted(chosen), "i8").view("u8")
    terms.sort()
    member = np.array([[i in chosen[t] for i in range(len(sets))] for t in terms.view("i8").tolist()], bool).reshape(len(terms), len(sets))
    return terms, member


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn=None, per_class: int = 2000, k: int = 15, folds: int = 5, most_terms: int = 20_000) -> Model:
    """Learn from the rows of labels for which `learn` (a condition on doc_id) holds."""
    with small_batches(docs.sparkSession):
        return _fit(docs, labels, label, F.lit(True) if learn is None else learn, per_class, k, folds, most_terms)


def _fit(docs: DataFrame, labels: DataFrame, label: str, learn, per_class: int, k: int, folds: int, most_terms: int) -> Model:
    rows, sizes = sample(docs, labels, label, learn, per_class)
    total = sum(sizes.values())
    prior = float(np.clip(sizes.get(1, 0) / total, 1e-6, 1 - 1e-6)) if total else 0.5
    rate = Model(None, (float(np.log(prior / (1 - prior))), 0.0), prior)
    if len(sizes) < 2:
        return rate
    counted = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text").mapInArrow(_examples, "doc_id long, y int, terms array<long>, counts array<long>")
    # repeated rows of an example follow each other, and share a fold
    counted = materialize(counted.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(folds)).cast("int")), "examples")
    vocabulary, member = vocabulary_of(counted, folds, most_terms)
    if not len(vocabulary):
        return rate
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    # at most 2 * per_class rows of at most most_terms * (folds + 1) numbers
    found = counted.mapInArrow(lambda it: _chosen(it, held.value), "doc_id long, y int, fold int, terms array<int>, counts array<long>").toArrow()
    held.destroy()
    found = found.sort_by([("doc_id", "ascending"), ("y", "ascending")])
    docs_of, y, fold_of = found["doc_id"].to_numpy(), found["y"].to_numpy().astype("i8"), found["fold"].to_numpy()
    if len(np.unique(y)) < 2:
        return rate
    lists, counts = found["terms"].combine_chunks(), found["counts"].combine_chunks()
    own, terms, tf = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy(), counts.flatten().to_numpy().astype("f8")
    df, n_docs = document_counts(docs, vocabulary)
    weight = np.log((1 + n_docs) / (1 + df)) + 1

    def index_of(chosen: np.ndarray, example: np.ndarray) -> Index:
        number = np.cumsum(chosen) - 1
        kept, place = chosen[terms] & example[own], np.cumsum(example) - 1
        return Index.build(vocabulary[chosen], weight[chosen], docs_of[example], y[example], place[own[kept]], number[terms[kept]], tf[kept], k, prior)

    spark = docs.sparkSession
    examples = spark.sparkContext.broadcast((np.searchsorted(own, np.arange(len(y) + 1)), vocabulary[terms], tf))
    votes = np.full(len(y), np.nan)
    for f in np.unique(fold_of):  # a job for each fold, so that a task holds one index only
        others, mine = spark.sparkContext.broadcast(index_of(member[:, 1 + f], fold_of != f)), np.flatnonzero(fold_of == f)
        rows = spark.range(0, len(mine), 1, max(1, len(mine) // 200)).mapInArrow(partial(_votes_of_others, index=others, examples=examples, mine=mine), "at long, vote double")
        for at, vote in rows.collect():  # a number per example
            votes[at] = vote
        others.destroy()
    examples.destroy()
    of_class = np.array([sizes[c] / max((y == c).sum(), 1) for c in (0, 1)])[y]
    told = ~np.isnan(votes)
    if len(np.unique(y[told])) < 2:
        curve = (float(np.log(prior / (1 - prior))), 1.0)
    else:
        curve = logistic(votes[told], y[told], (of_class / of_class.mean())[told])
    return Model(spark.sparkContext.broadcast(index_of(member[:, 0], np.ones(len(y), bool))), curve, prior)


def _chosen(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Examples with their terms of the vocabulary, by number."""
    for batch in batches:
        terms, counts = batch["terms"], batch["counts"]
        own, term = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy()), terms.flatten().to_numpy().view("u8")
        at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
        ok = vocabulary[at] == term
        cuts = pa.array(np.searchsorted(own[ok], np.arange(batch.num_rows + 1)), pa.int32())
        lists = pa.ListArray.from_arrays(cuts, pa.array(at[ok], pa.int32())), pa.ListArray.from_arrays(cuts, pa.array(counts.flatten().to_numpy()[ok], pa.int64()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], batch["fold"], *lists], names=["doc_id", "y", "fold", "terms", "counts"])


def _votes_of_others(batches: Iterator[pa.RecordBatch], index: Broadcast, examples: Broadcast, mine: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Votes about the examples `mine` of a fold by those of other folds, over terms chosen there; not a number without neighbours."""
    index, (cuts, terms, tf) = index.value, examples.value
    for batch in batches:
        at, votes = mine[batch["id"].to_numpy()], []
        for i in at.tolist():
            own, vote = slice(cuts[i], cuts[i + 1]), None
            if len(index.vocabulary):
                _, known, n = index.known(np.zeros(own.stop - own.start, "i8"), terms[own], tf[own])
                if len(known):
                    q = index.query(known, n)
                    vote = index.vote(*index.nearest(known, q, index.dense_parts([(known, q)])[0], index.k))
            votes.append(float("nan") if vote is None else vote)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(votes, pa.float64())], names=["at", "vote"])


def _scores(texts: pa.Array, model: Model, counter: Terms) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """Of each text the score, and the nearest examples with their cosines."""
    index, none = model.index.value if model.index else None, (np.empty(0, "i8"), np.empty(0))
    for part in parts_of(texts):
        if not index:
            yield from [(model.prior, *none)] * len(part)
            continue
        owner, terms, n = index.known(*counter.of(part))
        cuts = np.searchsorted(owner, np.arange(len(part) + 1)).tolist()
        queries = [(terms[a:z], index.query(terms[a:z], n[a:z])) if a < z else (terms[:0], np.empty(0)) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        for (own, q), row in zip(queries, index.dense_parts(queries), strict=True):
            at, s = index.nearest(own, q, row, index.k) if len(own) else none
            yield model.probability(index.vote(at, s)), at, s


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    index, counter = model.index.value if model.index else None, Terms()
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))
    for batch in batches:
        scores, evidence = [], []
        for score, at, s in _scores(batch["text"], model, counter):
            scores.append(score)
            evidence.append([{"doc_id": int(index.doc_ids[i]), "similarity": float(x), "label": int(index.labels[i])} for i, x in zip(at[:3], s[:3], strict=True)])
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=["doc_id", "score", "evidence"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, evidence (the three nearest examples)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _scored(it, model), "doc_id long, score double, evidence array<struct<doc_id:long,similarity:double,label:int>>")
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, whose score is under one half."""

    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Terms()
        for texts in batches:
            yield pa.array([score for score, _, _ in _scores(texts, model, counter)], pa.float64())

    return docs.where(F.arrow_udf(toxic, "double")(docs["text"].cast("string")) < 0.5)


def op1_toxicity(spark, sf_dir):
    docs, held_out = read(spark, sf_dir, "documents"), F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = fit(docs, read(spark, sf_dir, "labels"), "toxic", ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE_SQL: dict[str, str] = {}
