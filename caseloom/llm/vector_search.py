"""Exact top-k search by vector-approximation files.

The approximation file holds one byte per component (more for wide ranges): the number of the cell, on a grid of `cell`
integers, that the component falls in. A first scan reads only these bytes and bounds every inner product: the cell
centres give a middle value and, as all cells have one width, the query's absolute components give the same slack for
every vector. Only vectors whose upper bound reaches the k-th highest lower bound remain, and only for these are exact
vectors read, in the order of their bounds, until the k-th exact score is above every bound that is left.

Queries go to the tasks in slots of about SLOT_BYTES; a task streams the blocks that it reads past a slot's queries,
carries their k highest lower bounds from block to block and writes what remains once, at the end. So the file is read once per
slot and never shuffled; only what remains is. Every row has a number of its own, by which cells, bounds and exact vectors belong together.
Of equal vectors of a block only those stay that are among the k smallest ids without some query's own id (ties go to
smaller ids), so long runs of copies do not grow.

Defined results: rows with a null id, a null vector, or one with null or non-finite components take no part; neither do
vectors of another length than the query's; repeated rows are candidates each, but never for the query of the same id
(a repeated query is asked once, by its smallest vector); components are whole numbers, up to 2**62 in absolute value
(what is beyond counts as that), and a score beyond a long is ranked by its value and shown as the nearest long; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read, small_batches

#: Rows of a block, queries that meet a block at once, and bytes of query components in a slot.
BLOCK, QUERY_BLOCK, SLOT_BYTES = 8192, 512, 1 << 22
LARGEST = 1 << 62


def _packed(rows: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Blocks of at most `size` rows of one length, as little-endian binaries."""
    waiting: dict[int, list[tuple[int, int, np.ndarray]]] = {}

    def block(dim: int, own: list) -> pd.DataFrame:
        return pd.DataFrame({"dim": [dim], "ids": [np.array([i for i, _, _ in own], "<i8").tobytes()], "rows": [np.array([x for _, x, _ in own], "<i8").tobytes()], "vectors": [np.array([v for _, _, v in own], "<i8").tobytes()]})

    for pdf in rows:
        for i, x, v in zip(pdf["id"].to_numpy(), pdf["row"].to_numpy(), pdf["vector"], strict=True):
            own = waiting.setdefault(len(v), [])
            own.append((i, x, v))
            if len(own) >= size:
                yield block(len(v), waiting.pop(len(v)))
    for dim, own in waiting.items():
        yield block(dim, own)


def _without_late_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Positions, without those of equal vectors that k rows of smaller ids precede whichever one id is left out."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    n, at = len(order), np.arange(len(order))
    new = np.r_[True, (vectors[order][1:] != vectors[order][:-1]).any(1)][:n]
    new_id = new | np.r_[True, ids[order][1:] != ids[order][:-1]][:n]
    starts, group, run = np.maximum.accumulate(np.where(new, at, 0)), np.cumsum(new), np.cumsum(new_id) - 1
    # per run of one id: the longest run before it among the same vectors
    longest = np.maximum.accumulate(group[new_id] * (n + 1) + np.bincount(run))
    longest = np.maximum(np.r_[0, longest][:-1] - group[new_id] * (n + 1), 0)
    return np.sort(order[at - starts - longest[run] < k])


def _approximate(rows: Iterator[pd.DataFrame], size: int, k: int, cell: int) -> Iterator[pd.DataFrame]:
    """The approximation file: per block the lowest cell and the least number of bytes per component that holds the rest."""
    for pdf in _packed(rows, size):
        r = pdf.iloc[0]
        ids, numbers, vectors = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["rows"], "<i8"), np.frombuffer(r["vectors"], "<i8").reshape(-1, r["dim"])
        at = _without_late_copies(ids, vectors, k)
        cells = np.floor_divide(vectors[at], cell)
        low = int(cells.min()) if cells.size else 0
        rest = (cells - low).astype("u8")
        width = next(w for w in (1, 2, 4, 8) if not cells.size or int(rest.max()) < 1 << 8 * w)
        yield pd.DataFrame({"dim": [r["dim"]], "ids": [ids[at].tobytes()], "rows": [numbers[at].tobytes()], "cells": [rest.astype(f"<u{width}").tobytes()], "low": [low], "width": [width]})


class _Slot:
    """Some queries on their way past the blocks of a task."""

    def __init__(self, queries: list[tuple[int, np.ndarray]], k: int, cell: int):
        self.ids, self.queries = np.array([i for i, _ in queries], "i8"), np.array([v for _, v in queries], "f8")
        self.k, self.cell = k, cell
        self.highest = np.full((len(queries), k), -np.inf)  # lower bounds
        self.found = [np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0), np.empty(0)]  # query, row, lower, upper

    def pass_block(self, ids: np.ndarray, numbers: np.ndarray, cells: np.ndarray, low: int) -> None:
        centres = (cells.astype("f8") + low) * self.cell + (self.cell - 1) / 2
        # what sums of products may be off by, for large components
        off = np.abs(self.queries) @ np.abs(centres).max(0, initial=0) * (len(centres.T) + 8) * 2.0**-50 if np.abs(centres).max(initial=0) > 1 << 20 or np.abs(self.queries).max() > 1 << 20 else 0.0
        slack = np.abs(self.queries).sum(1) * (self.cell - 1) / 2 + off
        middle = self.queries @ centres.T
        middle[self.ids[:, None] == ids[None, :]] = -np.inf
        lower = middle - slack[:, None]
        kept = np.partition(lower, len(ids) - self.k, 1)[:, len(ids) - self.k :] if len(ids) > self.k else lower
        self.highest = np.sort(np.concatenate([self.highest, kept], 1), 1)[:, -self.k :]
        least = self.highest[:, 0]
        at_q, at_v = np.nonzero((middle + slack[:, None] >= least[:, None]) & (middle > -np.inf))
        m = middle[at_q, at_v]
        new = [at_q, numbers[at_v], m - slack[at_q], m + slack[at_q]]
        still = self.found[3] >= least[self.found[0]]
        self.found = [np.concatenate([a[still], b]) for a, b in zip(self.found, new, strict=True)]

    def left(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": self.ids[self.found[0]], "row": self.found[1], "lower": self.found[2], "upper": self.found[3]})


def _bounded(blocks: Iterator[pd.DataFrame], queries: Broadcast, k: int, cell: int, query_block: int) -> Iterator[pd.DataFrame]:
    """query_id, row, lower, upper: what a task's blocks leave, for all queries of a slot."""
    held = queries.value
    slots = [_Slot(held[a : a + query_block], k, cell) for a in range(0, len(held), query_block)]
    for pdf in blocks:
        for r in pdf.itertuples():
            block = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.rows, "<i8"), np.frombuffer(r.cells, f"<u{r.width}").reshape(-1, r.dim), r.low
            for slot in slots:
                slot.pass_block(*block)
    for slot in slots:
        yield slot.left()


def _scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products, as Python's integers where a long may not hold them."""
    if float(np.abs(query).max()) * float(np.abs(vectors).max()) * len(query) < 2.0**62:
        return vectors @ query
    return vectors.astype(object) @ query.astype(object)


class _Best:
    """The k best of one query, from its candidates in the order of their upper bounds."""

    def __init__(self, query_id: int, query: np.ndarray, k: int):
        self.query_id, self.query, self.k = query_id, np.asarray(query, "i8"), k
        self.ids, self.scores, self.certain = np.empty(0, "i8"), np.empty(0, "i8"), False

    def read(self, upper: np.ndarray, ids: np.ndarray, vectors: list) -> None:
        for a in range(0, len(ids), 4 * self.k):
            if self.certain or len(self.ids) == self.k and upper[a] < self.scores[-1]:
                self.certain = True
                return
            step = np.stack(vectors[a : a + 4 * self.k]).astype("i8")
            all_ids, scores = np.r_[self.ids, ids[a : a + 4 * self.k]], np.r_[self.scores, _scores(self.query, step)]
            order = np.lexsort((all_ids, -scores)) if scores.dtype == "i8" else np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], all_ids[i])))
            order = order[: self.k]
            self.ids, self.scores = all_ids[order], scores[order]

    def ranked(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": self.query_id, "rank": np.arange(1, len(self.ids) + 1, dtype="i4"), "vec_id": self.ids, "score": np.clip(self.scores, -(2**63), 2**63 - 1).astype("i8")})


def _ranked(rows: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by query_id, kind (the query before its candidates) and descending upper bounds."""
    best = None
    for pdf in rows:
        for query_id, own in pdf.groupby("query_id", sort=False):
            if best is None or best.query_id != query_id:
                if best:
                    yield best.ranked()
                best, own = _Best(query_id, own["vector"].iloc[0], k), own.iloc[1:]
            if len(own):
                best.read(own["upper"].to_numpy(), own["vec_id"].to_numpy(), own["vector"].tolist())
    if best:
        yield best.ranked()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, cell: int = 2, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: both inputs have id (long) and vector (array<long>)."""
    vectors = materialize(vectors.select("id", F.monotonically_increasing_id().alias("row"), "vector"), "vectors")  # numbers hold once written
    asked = materialize(queries.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector")), "asked")
    file = vectors.mapInPandas(lambda it: _approximate(it, block, k, cell), "dim int, ids binary, rows binary, cells binary, low long, width int")
    with small_batches(vectors.sparkSession, 2048):
        file = materialize(file, "cells")
    # a slot of queries at a time goes to all tasks, which stream the blocks that they read: no block moves
    sizes = asked.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where("dim > 0").orderBy("dim").collect()  # a row per vector length
    bounds, waiting = [], []
    with small_batches(vectors.sparkSession, 32):
        for r in sizes:
            slots = max(1, -(-r["n"] * 8 * r["dim"] // SLOT_BYTES))
            for slot in range(slots):
                own = asked.where((F.col("dim") == r["dim"]) & (F.pmod(F.xxhash64("id"), F.lit(slots)) == slot)).select("id", "vector").toArrow()
                held = vectors.sparkSession.sparkContext.broadcast(list(zip(own["id"].to_pylist(), own["vector"].to_numpy(), strict=True)))  # about SLOT_BYTES
                blocks = file.where(F.col("dim") == r["dim"])
                waiting.append(blocks.mapInPandas(lambda it, held=held: _bounded(it, held, k, cell, query_block), "query_id long, row long, lower double, upper double"))
                if len(waiting) == 16:
                    bounds, waiting = [*bounds, materialize(reduce(DataFrame.unionByName, waiting), "bounds")], []
        if waiting:
            bounds.append(materialize(reduce(DataFrame.unionByName, waiting), "bounds"))
    if not bounds:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bounds = reduce(DataFrame.unionByName, bounds)
    nth = bounds.selectExpr("query_id", "lower", "row_number() OVER (PARTITION BY query_id ORDER BY lower DESC) AS nth").where(F.col("nth") <= k)
    kth = nth.groupBy("query_id").agg(F.min("lower").alias("kth"), F.count(F.lit(1)).alias("n"))
    left = bounds.join(kth, "query_id").where((F.col("n") < k) | (F.col("upper") >= F.col("kth"))).select("query_id", "row", "upper")
    wanted = left.join(vectors.select("row", F.col("id").alias("vec_id"), "vector"), "row").select("query_id", F.lit(1).alias("kind"), "upper", "vec_id", "vector")
    asking = asked.select(F.col("id").alias("query_id"), F.lit(0).alias("kind"), F.lit(float("inf")).alias("upper"), F.lit(0).cast("long").alias("vec_id"), "vector")
    ordered = asking.unionByName(wanted).repartition("query_id").sortWithinPartitions(F.col("query_id"), F.col("kind"), F.desc("upper"), F.col("vec_id"))
    return ordered.mapInPandas(lambda it: _ranked(it, k), "query_id long, rank int, vec_id long, score long")


def whole_vectors(table: DataFrame, scale: int = 64, with_null_ids: bool = False) -> DataFrame:
    """id, vector (array<long>, floor(scale * component)), rows without any null or non-finite component only."""
    most = float(LARGEST)
    numbers = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(most)), F.lit(-most))).cast("long"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return table.where((F.col("vec_id").isNotNull() | F.lit(with_null_ids)) & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("id"), numbers.alias("vector"))


def op9_vector_search(spark, sf_dir):
    vectors = whole_vectors(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("id % 20 = 0"))


QUERIES = {"op9_vector_search": op9_vector_search}
ORACLE_SQL = {
    "op9_vector_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""
}
