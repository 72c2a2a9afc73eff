"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line gets a state, good or bad. Its features are buckets of simple measures (length, share of symbols, capitals
and digits, repeated and distinct words, known common words, line end, repetition of an earlier line, place in the
document), and some of these of the line before and after it. The field is learned from a bounded sample of labelled
documents (`per_class` per class, of at most `most_lines` lines): the lines of good documents are good; of bad documents
the lines that the current model finds bad, and always the worst one, are bad; learning and relabelling alternate.

Forward-backward marginals of every line of the whole text, weighted by line length, give the mean and the worst share
of good lines; a logistic curve, fitted at the classes' true rates, turns their combination into the score.

The model is a few hundred numbers and is broadcast; documents are scored where they lie, without a shuffle.

Defined results: null and empty texts are one empty line and are scored as such; very long texts are scored whole, in
segments of lines whose messages are passed exactly; a null doc_id is not held out;
repeated rows are scored each; label rows with null or other labels are ignored, of several labels of a document the
larger counts; without labels, or with one class only, every score is that class's rate (0.5 without labels); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, read, small_batches
from .labelled import logistic, sample

THRESHOLD = 0.7
#: Edges of the buckets, by measure.
EDGES = {
    "length": (1, 8, 20, 40, 80, 160, 320, 640, 1280, 5000),
    "symbols": (1e-9, 0.02, 0.04, 0.06, 0.1, 0.15, 0.25, 0.5),
    "capitals": (1e-9, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7),
    "digits": (1e-9, 0.02, 0.05, 0.15, 0.4),
    "distinct": (0.1, 0.3, 0.5, 0.65, 0.8, 0.9, 0.9999),
    "adjacent": (1e-9, 0.03, 0.1, 0.3, 0.6),
    "common": (1e-9, 0.05, 0.1, 0.2, 0.3, 0.4, 0.6),
    "word": (2, 3, 4, 5, 6, 7, 9, 12, 20),
    "words": (1, 2, 4, 8, 16, 32, 64, 128, 256),
    "commas": (1e-9, 0.02, 0.05, 0.1, 0.2),
}
OWN = (*EDGES, "end", "again", "place")
NEIGHBOUR = ("length", "symbols", "capitals", "distinct", "adjacent", "common", "words")
WIDTH = 12  # values of a feature, 11: no such line
#: Documents of more lines are cut into segments.
LONG = 512
_PLAIN = re.compile(r"[^\w.,]|_")
COLUMNS = len(OWN) + 2 * len(NEIGHBOUR)


def line_features(text: str, common: frozenset) -> tuple[np.ndarray, np.ndarray]:
    """Feature values (lines by COLUMNS, small integers) and weights (line lengths, 1 at least) of a text's lines."""
    lines = text.split("\n")
    n = len(lines)
    measures = np.zeros((len(EDGES), n))
    other = np.zeros((3, n), "i1")
    seen: set[int] = set()
    for i, line in enumerate(lines):
        words = line.split()
        size = len(words)
        letters = line.replace(" ", "")
        alnum = len(letters)
        key = hash(line)
        other[1, i] = 2 if key in seen and line else 1 if not line else 0
        seen.add(key)
        other[2, i] = (i == 0) + 2 * (i == n - 1)
        if not size:
            continue
        ends = line.rstrip()[-1]
        other[0, i] = 1 if ends in ".!?" else 2 if ends.isalnum() else 3 if ends in ",;:" else 4
        distinct = len(set(words))
        same = sum(map(str.__eq__, words, words[1:])) if distinct < size else 0
        plain = _PLAIN.sub("", letters)
        measures[:, i] = (
            len(line), (alnum - len(plain)) / alnum, sum(map(str.isupper, plain)) / max(len(plain), 1), sum(map(str.isdigit, plain)) / alnum,
            distinct / size if size > 3 else 1, same / size, sum(w in common for w in words) / size, alnum / size, size, (line.count(",") + line.count(".")) / size,
        )
    own = np.stack([*(np.searchsorted(e, m, side="right") for e, m in zip(EDGES.values(), measures, strict=True)), *other], 1).astype("i1")
    near = own[:, [OWN.index(f) for f in NEIGHBOUR]]
    none = np.full((1, len(NEIGHBOUR)), WIDTH - 1, "i1")
    return np.concatenate([own, np.concatenate([none, near[:-1]]), np.concatenate([near[1:], none])], 1), np.maximum(measures[0], 1)


@dataclass
class Field:
    """Weights by feature value (of the state bad against good) and by pair of neighbouring states."""

    common: frozenset
    emission: np.ndarray = field(default_factory=lambda: np.zeros((COLUMNS, WIDTH)))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float] = (0.0, 0.0)

    def scores(self, values: np.ndarray) -> np.ndarray:
        parts = [self.emission[np.arange(COLUMNS), values[a : a + 50_000]].sum(-1) for a in range(0, len(values), 50_000)]
        return np.concatenate(parts) if parts else np.empty(0)

    def chains(self, emitted: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, float]:
        """Marginals of bad per line, expected counts of neighbouring states, log partition function. Short documents of
        similar length advance together, line by line; a long one is cut into segments that advance together."""
        marginals: list = [None] * len(emitted)
        pairs, log_z = np.zeros((2, 2)), 0.0
        sizes = np.array([len(e) for e in emitted], "i8")
        for i in np.flatnonzero(sizes > LONG):
            marginals[i], p, z = self.long_chain(emitted[i])
            pairs, log_z = pairs + p, log_z + z
        order = np.flatnonzero(sizes <= LONG)
        order = order[np.argsort(sizes[order], kind="stable")]
        for a in range(0, len(order), 128):
            p, z = self._together(order[a : a + 128], emitted, marginals)
            pairs, log_z = pairs + p, log_z + z
        return marginals, pairs, log_z

    def _together(self, own: np.ndarray, emitted: list[np.ndarray], marginals: list) -> tuple[np.ndarray, float]:
        t, pairs = self.transition, np.zeros((2, 2))
        sizes = np.array([len(emitted[i]) for i in own])
        longest = sizes.max()
        e = np.zeros((len(own), longest))
        for row, i in enumerate(own):
            e[row, : sizes[row]] = emitted[i]
        forward, backward = np.zeros((longest, 2, len(own))), np.zeros((longest, 2, len(own)))
        forward[0, 1] = e[:, 0]
        for j in range(1, longest):
            f = forward[j - 1]
            forward[j, 0] = np.logaddexp(f[0] + t[0, 0], f[1] + t[1, 0])
            forward[j, 1] = np.logaddexp(f[0] + t[0, 1], f[1] + t[1, 1]) + e[:, j]
        for j in range(longest - 2, -1, -1):
            g0, g1 = backward[j + 1, 0], backward[j + 1, 1] + e[:, j + 1]
            inside = j + 1 < sizes
            backward[j, 0] = np.where(inside, np.logaddexp(t[0, 0] + g0, t[0, 1] + g1), 0)
            backward[j, 1] = np.where(inside, np.logaddexp(t[1, 0] + g0, t[1, 1] + g1), 0)
        z = np.logaddexp(forward[0, 0] + backward[0, 0], forward[0, 1] + backward[0, 1])
        p = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - z, 0)).T  # places after the last line hold no probability
        for row, i in enumerate(own):
            marginals[i] = p[row, : sizes[row]]
        inside = np.arange(1, longest)[:, None] < sizes
        for x in (0, 1):
            for y in (0, 1):
                m = forward[:-1, x] + t[x, y] + backward[1:, y] + (e.T[1:] if y else 0) - z
                pairs[x, y] += np.exp(np.where(inside, m, -np.inf)).sum()
        return pairs, float(z.sum())

    def long_chain(self, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """The same for one document of n lines in about sqrt(n) segments: what each segment makes of either state before
        it (2 by 2) is found for all segments at once, passed from segment to segment, and then each is filled in."""
        n = len(emitted)
        length = int(np.ceil(np.sqrt(n)))
        count = -(-n // length)
        place = np.arange(count * length).reshape(count, length)
        e = np.zeros(count * length)
        e[:n] = emitted

        def step(j: int) -> np.ndarray:
            """[segment, state before, state]: log weights of line j of each segment; none is left after the last line."""
            m = np.repeat(self.transition[None], count, 0)
            m[0] = 0.0 if j == 0 else m[0]
            m[:, :, 1] += e[place[:, j]][:, None]
            m[place[:, j] >= n] = [[0.0, -np.inf], [-np.inf, 0.0]]
            return m

        through = np.repeat(np.array([[[0.0, -np.inf], [-np.inf, 0.0]]]), count, 0)
        for j in range(length):
            through = np.logaddexp(through[:, :, :1] + step(j)[:, :1], through[:, :, 1:] + step(j)[:, 1:])
        start, end = np.zeros((count, 2)), np.zeros((count, 2))
        start[0] = [0.0, -np.inf]  # before the first line there is one state
        for s in range(1, count):
            start[s] = np.logaddexp(start[s - 1, 0] + through[s - 1, 0], start[s - 1, 1] + through[s - 1, 1])
        for s in range(count - 2, -1, -1):
            end[s] = np.logaddexp(through[s + 1, :, 0] + end[s + 1, 0], through[s + 1, :, 1] + end[s + 1, 1])
        last = np.logaddexp(start[-1, 0] + through[-1, 0], start[-1, 1] + through[-1, 1])
        z = float(np.logaddexp(last[0], last[1]))
        before = np.empty((length, count, 2))
        f = start
        for j in range(length):
            before[j], m = f, step(j)
            f = np.logaddexp(f[:, :1] + m[:, 0], f[:, 1:] + m[:, 1])
        bad, pairs, g = np.empty((count, length)), np.zeros((2, 2)), end
        for j in range(length - 1, -1, -1):
            m = step(j)
            both = np.exp(before[j][:, :, None] + m + g[:, None] - z)  # [segment, state before, state]
            bad[:, j] = both[:, :, 1].sum(1)
            pairs += both[(place[:, j] < n) & (place[:, j] > 0)].sum(0)
            g = np.logaddexp(m[:, :, 0] + g[:, :1], m[:, :, 1] + g[:, 1:])
        return np.minimum(bad.ravel()[:n], 1.0), pairs, z

    def learn(self, values: list[np.ndarray], states: list[np.ndarray], steps: int, ridge: float = 2.0) -> None:
        """Gradient ascent (Adam) on the log likelihood of the states."""
        flat, where = np.concatenate(values), np.cumsum([0, *map(len, values)])
        seen = np.concatenate(states)
        pairs = np.zeros((2, 2))
        for s in states:
            np.add.at(pairs, (s[:-1], s[1:]), 1)
        cell = (np.arange(COLUMNS) * WIDTH + flat).ravel()
        params = np.r_[self.emission.ravel(), self.transition.ravel()]
        m, v = np.zeros_like(params), np.zeros_like(params)
        for step in range(1, steps + 1):
            self.emission, self.transition = params[:-4].reshape(COLUMNS, WIDTH), params[-4:].reshape(2, 2)
            out = self.scores(flat)
            marginals, expected, _ = self.chains([out[a:b] for a, b in zip(where[:-1], where[1:], strict=True)])
            gap = np.repeat(seen - np.concatenate(marginals), COLUMNS)
            g = np.r_[np.bincount(cell, gap, COLUMNS * WIDTH), (pairs - expected).ravel()] - ridge * params
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            params = params + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.emission, self.transition = params[:-4].reshape(COLUMNS, WIDTH), params[-4:].reshape(2, 2)

    def aggregate(self, marginals: np.ndarray, weights: np.ndarray) -> float:
        """Length-weighted share of bad lines, on a scale that tells small shares apart."""
        share = float(marginals @ weights / weights.sum())
        return float(np.log((share + 1e-3) / (1 - share + 1e-3)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * x, -30, 30)))


def _featured(batches: Iterator[pa.RecordBatch], common: frozenset) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [line_features(t, common) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], pa.array([v.tobytes() for v, _ in out], pa.binary()), pa.array([w.tobytes() for _, w in out], pa.binary())], names=["doc_id", "y", "features", "sizes"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn=None, per_class: int = 1500, most_lines: int = 400, n_common: int = 400, rounds: int = 3) -> Field:
    """Learn from the rows of labels for which `learn` (a condition on doc_id) holds."""
    with small_batches(docs.sparkSession):
        return _fit(docs, labels, label, F.lit(True) if learn is None else learn, per_class, most_lines, n_common, rounds)


def _fit(docs: DataFrame, labels: DataFrame, label: str, learn, per_class: int, most_lines: int, n_common: int, rounds: int) -> Field:
    rows, sizes = sample(docs, labels, label, learn, per_class)
    total = sum(sizes.values())
    if len(sizes) < 2:
        rate = sizes.get(1, 0) / total if total else 0.5
        return Field(frozenset(), curve=(float(np.clip(np.log(max(rate, 1e-9) / max(1 - rate, 1e-9)), -20, 20)), 0.0))
    rows = materialize(rows.where(F.size(F.split("text", "\n")) <= most_lines).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text"), "sample")
    words = rows.where("y = 1").select(F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("w")).where("w <> ''").groupBy("w").count().orderBy(F.desc("count"), "w").limit(n_common)
    model = Field(frozenset(r["w"] for r in words.collect()))
    found = rows.mapInArrow(lambda it: _featured(it, model.common), "doc_id long, y int, features binary, sizes binary").orderBy("doc_id").collect()  # bounded by the sample
    if len({r["y"] for r in found}) < 2:
        return model
    values = [np.frombuffer(r["features"], "i1").reshape(-1, COLUMNS) for r in found]
    weights, y = [np.frombuffer(r["sizes"], "f8") for r in found], np.array([r["y"] for r in found])
    states = [np.full(len(v), 1 - label, "i8") for v, label in zip(values, y, strict=True)]
    for nth in range(rounds):
        model.learn(values, states, 40)
        if nth + 1 == rounds:
            break
        marginals, _, _ = model.chains([model.scores(v) for v in values])
        for i in np.flatnonzero(y == 0):
            states[i] = ((marginals[i] >= 0.5) | (marginals[i] == marginals[i].max())).astype("i8")
    marginals, _, _ = model.chains([model.scores(v) for v in values])
    x = np.array([model.aggregate(m, w) for m, w in zip(marginals, weights, strict=True)])
    counts = Counter(y.tolist())
    rate = np.array([sizes[c] / counts[c] for c in (0, 1)])[y]
    model.curve = logistic(x, y, rate / rate.mean())
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        x = np.empty(len(texts))
        for a in range(0, len(texts), 512):
            out = [line_features(t or "", model.common) for t in texts[a : a + 512]]  # a small number of bytes per line
            where = np.cumsum([0, *(len(v) for v, _ in out)])
            flat = model.scores(np.concatenate([v for v, _ in out]))
            marginals, _, _ = model.chains([flat[i:j] for i, j in zip(where[:-1], where[1:], strict=True)])
            x[a : a + 512] = [model.aggregate(m, w) for m, (_, w) in zip(marginals, out, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.probability(x), pa.float64())], names=["doc_id", "score"])


def score(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, score, predicted (1 from THRESHOLD on)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _scored(it, held.value), "doc_id long, score double")
    return out.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_quality(spark, sf_dir):
    docs, held_out = read(spark, sf_dir, "documents"), F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit(docs, read(spark, sf_dir, "labels"), "quality", ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {"op3_quality": op3_quality}
ORACLE_SQL: dict[str, str] = {}
