"""Nearest vectors of a stated query set among all rows, by shells around pivots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import checkpointed

#: Bytes of query vectors that go to the tasks at once, rows and queries that are compared at once, and how many pivots there are.
SLOT_BYTES, CHUNK, AT_ONCE, PIVOTS = 1 << 22, 4096, 512, 64
#: What rounding may hide of a distance, of vectors of length one.
SLACK = 1e-4


def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Larger is nearer; rounded, so that equal vectors tie."""
    dot = queries @ vectors.T
    q2, v2 = (queries**2).sum(1)[:, None], (vectors**2).sum(1)[None, :]
    if metric == "cosine":
        return np.round(dot / np.sqrt(np.maximum(q2 * v2, 1e-300)), 9)
    return -np.round(np.sqrt(np.maximum(q2 + v2 - 2 * dot, 0)), 6)


def _metric_space(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Vectors whose Euclidean distances rank as the scores do: for cosines, of length one (or zero)."""
    if metric != "cosine":
        return vectors
    return vectors / np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-300)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))


def stored_by_pivot(vectors: DataFrame, id_: str, vector: str, metric: str = "cosine", pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """The index: id, v, cell (the nearest of a few vectors taken as pivots), away (the distance to it), sorted by both, so that a
    stretch of rows is a thin shell around one pivot. It moves each vector once and can be kept for later searches."""
    rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    chosen = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()], "f8")  # `pivots` rows
    chosen = _metric_space(chosen, metric) if len(chosen) else chosen

    def placed(batches):
        for pdf in batches:
            d = _distances(_metric_space(np.stack(pdf["v"].to_numpy()), metric), chosen)
            yield pdf.assign(cell=d.argmin(1).astype("i4"), away=d.min(1))

    file = rows.mapInPandas(placed, "id long, v array<double>, cell int, away double").repartitionByRange("cell", "away").sortWithinPartitions("cell", "away", "id")
    return checkpointed(file), chosen


def _nearest(batches, held, pivots: np.ndarray, k: int, metric: str):
    """query_id, id, score: the k nearest of a task's rows for each query. A stretch of rows of one cell, between two distances
    from its pivot, is at least the query's distance to that shell away (triangle inequality); queries that have k nearer rows pass it by."""
    ids, queries = held.value
    space = _metric_space(queries, metric)
    to_pivot = _distances(space, pivots)
    slack = SLACK * (1 + np.sqrt((space * space).sum(1)) + np.sqrt((pivots * pivots).sum(1)).max())
    best_id, best = np.full((len(ids), k), np.iinfo("i8").max), np.full((len(ids), k), -np.inf)
    reach = lambda score: np.sqrt(np.maximum(2 - 2 * score, 0)) if metric == "cosine" else -score

    def meet(own: np.ndarray, v: np.ndarray, cell: int, low: float, high: float) -> None:
        shell = np.maximum(np.maximum(to_pivot[:, cell] - high, low - to_pivot[:, cell]), 0)
        wanted = np.flatnonzero(shell <= reach(best[:, -1]) + slack)
        for a in range(0, len(wanted), AT_ONCE):
            q = wanted[a : a + AT_ONCE]
            scores = _scores(queries[q], v, metric)
            scores[ids[q][:, None] == own[None, :]] = -np.inf
            all_ids, all_scores = np.concatenate([best_id[q], np.broadcast_to(own, scores.shape)], 1), np.concatenate([best[q], scores], 1)
            order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best_id[q], best[q] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_scores, order, 1)

    for pdf in batches:
        for cell, part in pdf.groupby("cell", sort=False):
            for a in range(0, len(part), CHUNK):
                rows = part.iloc[a : a + CHUNK]
                meet(rows["id"].to_numpy(), np.stack(rows["v"].to_numpy()), int(cell), float(rows["away"].min()), float(rows["away"].max()))
    at, nth = np.nonzero(best > -np.inf)
    yield pd.DataFrame({"query_id": ids[at], "id": best_id[at, nth], "score": best[at, nth]})


def top_k(vectors: DataFrame, queries: DataFrame, id_: str, vector: str, k: int, metric: str = "cosine") -> DataFrame:
    """query_id, id, score (cosine, or minus the distance): the k nearest rows of each query but those of its own id, ties to
    the smaller id. Vectors move once, into shells around pivots; queries go to the tasks in slots of a bounded size, and a
    task gives k rows per query."""
    file, pivots = stored_by_pivot(vectors, id_, vector, metric)
    asked = checkpointed(queries.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL"))
    n = asked.count()
    slots = max(1, -(-n * 8 * max(1, pivots.shape[-1]) // SLOT_BYTES))
    found = None
    for slot in range(slots if n and len(pivots) else 0):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(slots)) == slot).toPandas()  # about SLOT_BYTES
        if not len(own):
            continue
        held = vectors.sparkSession.sparkContext.broadcast((own["id"].to_numpy(), np.stack(own["v"].to_numpy())))
        part = file.mapInPandas(lambda it, held=held: _nearest(it, held, pivots, k, metric), "query_id long, id long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, id long, score double")
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("_nth", nth).where(F.col("_nth") <= k).drop("_nth")


def centroids(vectors: DataFrame, vector: str, name: str) -> DataFrame:
    """name, v: the mean vector of each name."""
    parts = vectors.select(name, F.posexplode(vector).alias("pos", "x")).groupBy(name, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy(name).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("p")).select(name, F.transform("p", lambda e: e.x).alias("v"))
