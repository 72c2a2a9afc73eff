"""Exact k-means assignment by annulus search.

Centroids are sorted by their norm. A vector's distance to the centroid of the nearest norm bounds its distance to the
best one; whatever is not farther than that bound has, by the triangle inequality, a norm within the bound of the
vector's own. Binary search gives these centroids (an annulus around the origin), and only they are compared, in whole
numbers; of equal distances the smaller number counts. Norms and bounds are rounded outwards, so ties on the border of an
annulus stay in.

The vectors are written once, as whole numbers, and read once per round; a round sends one row per task, cluster and
component that its task met, summed exactly as decimals, and k * components numbers reach the driver. No vector is shuffled.

Defined results: rows with a null vector, a null or non-finite component, or another number of components than asked for
take no part; components are whole numbers up to 2**62 in absolute value (what is beyond counts as that), distances are
compared by their exact values, and one beyond a long is shown as the largest long, as are sums of such; rows that repeat
an id are vectors each; a null id starts no cluster unless there are too few others, and has its row in the result; fewer
vectors than clusters give as many clusters as vectors; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read
from .vector_search import whole_vectors

LONG = (1 << 63) - 1


class Centroids:
    """Numbered centroids, sorted by norm."""

    def __init__(self, rows: list[tuple[int, ...]]):
        self.exact = np.array(rows, object).reshape(len(rows), -1)
        self.norms = np.sqrt((self.exact**2).sum(1).astype("f8"))
        self.order = np.argsort(self.norms, kind="stable")
        self.norms = self.norms[self.order]
        self.largest = max((abs(x) for row in rows for x in row), default=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance (doubles that hold whole numbers, or Python's integers) of each vector."""
        most = max(self.largest, int(np.abs(vectors).max(initial=0)))
        small = 4 * most * most * vectors.shape[1] < 1 << 53  # squared distances are exact as doubles
        x, centres = (vectors.astype("f8"), self.exact.astype("f8")) if small else (vectors.astype(object), self.exact)
        squared = (x * x).sum(1)
        norm = np.sqrt(squared.astype("f8"))
        # the centroid of the nearest norm gives the bound
        right = np.clip(np.searchsorted(self.norms, norm), 1, max(1, len(self.norms) - 1))
        if len(self.norms) > 1:
            right = np.where(norm - self.norms[right - 1] <= self.norms[right] - norm, right - 1, right)
        else:
            right = np.zeros(len(x), "i8")
        cluster = self.order[right].astype("i4")
        best = ((x - centres[cluster]) ** 2).sum(1)
        bound = np.sqrt(best.astype("f8"))
        bound += 1e-9 * (bound + norm + 1)
        low, high = np.searchsorted(self.norms, norm - bound, "left"), np.searchsorted(self.norms, norm + bound, "right")
        for place, c in enumerate(self.order.tolist()):
            rows = np.flatnonzero((low <= place) & (place < high))
            if len(rows):
                d = ((x[rows] - centres[c]) ** 2).sum(1)
                better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
                best[rows[better]], cluster[rows[better]] = d[better], c
        return cluster, best


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(batches: Iterator[pa.RecordBatch], centroids: Centroids, dim: int) -> Iterator[pa.RecordBatch]:
    """cluster, component (-1: the count), total of a task."""
    k = len(centroids.order)
    total, count = np.zeros((k, dim), object), np.zeros(k, "i8")
    for batch in batches:
        vectors = _matrix(batch["vector"], dim)
        cluster, _ = centroids.nearest(vectors)
        count += np.bincount(cluster, minlength=k)
        wide = np.abs(vectors).max(initial=0) > 1 << 40
        for c in np.unique(cluster).tolist():
            own = vectors[cluster == c]
            total[c] += (own.astype(object) if wide else own).sum(0)
    rows = [(c, j, t) for c in np.flatnonzero(count).tolist() for j, t in [(-1, int(count[c])), *((j, int(t)) for j, t in enumerate(total[c]))]]
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.decimal128(38, 0))], names=["cluster", "component", "total"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: Centroids, dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster, d = centroids.nearest(_matrix(batch["vector"], dim))
        shown = d.astype("i8") if d.dtype == "f8" else np.array([min(x, LONG) for x in d.tolist()], "i8")
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(cluster), pa.array(shown)], names=["id", "cluster", "distance"])


def first_centroids(vectors: DataFrame, k: int, salt: str = "1:") -> list[tuple[int, ...]]:
    """The k vectors of the smallest SHA-256 of salt and id (null ids last, of repeated ids the smaller vectors first)."""
    named = vectors.select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("name"), "vector")
    return [tuple(r["vector"]) for r in named.orderBy(F.col("name").asc_nulls_last(), "vector").limit(k).collect()]  # k rows


def k_means(vectors: DataFrame, dim: int, k: int = 16, rounds: int = 3, start: Callable[[DataFrame, int], list[tuple[int, ...]]] = first_centroids) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """id, cluster, distance for each row of vectors (id long, vector array<long> of dim numbers), and the centroids after
    so many rounds."""
    vectors = materialize(vectors.select("id", "vector"), "vectors")
    rows = start(vectors, k)
    if not rows:
        return vectors.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    for _ in range(rounds):
        now = Centroids(rows)
        parts = vectors.mapInArrow(lambda it, now=now: _sums(it, now, dim), "cluster int, component int, total decimal(38, 0)")
        found: dict[int, dict[int, int]] = {}
        for r in parts.groupBy("cluster", "component").agg(F.sum("total").alias("total")).collect():  # k * (dim + 1) rows
            found.setdefault(r["cluster"], {})[r["component"]] = int(r["total"])
        rows = [tuple(found[c][j] // found[c][-1] for j in range(dim)) if c in found else old for c, old in enumerate(rows)]
    last = Centroids(rows)
    return vectors.select("id", "vector").mapInArrow(lambda it: _assigned(it, last, dim), "id long, cluster int, distance long"), rows


def clusters(vectors: DataFrame, dim: int = 64, k: int = 16, rounds: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row per vector of dim components."""
    assigned, centroids = k_means(vectors.where(F.size("vector") == dim), dim, k, rounds)
    assigned = materialize(assigned, "assigned")
    shown = lambda c: F.least(c, F.lit(LONG)).cast("long")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("own"))
    total = sums.agg(F.sum("own").alias("total"))
    names = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    named = assigned.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")
    per_cluster = sums.join(F.broadcast(named), "cluster").crossJoin(total)  # k rows and one row
    return assigned.join(F.broadcast(per_cluster), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", shown("own").alias("cluster_inertia"), shown("total").alias("inertia"), "centroid_sha256")


def op12_clustering(spark, sf_dir):
    return clusters(whole_vectors(read(spark, sf_dir, "embeddings"), with_null_ids=True))


QUERIES = {"op12_clustering": op12_clustering}


def _round_sql(n: int) -> str:
    """Assignment to the centroids c{n}, and the centroids that follow from it."""
    return f""",
d{n} AS (SELECT v.vec_id, v.v, c.cluster, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance FROM v, c{n} c),
a{n} AS MATERIALIZED (SELECT vec_id, v, min_by(cluster, distance * 16 + cluster) AS cluster, min(distance) AS distance FROM d{n} GROUP BY vec_id, v),
u{n} AS (SELECT cluster, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{n}) GROUP BY cluster, j),
c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(u.v, c.v) AS v FROM c{n} c LEFT JOIN (SELECT cluster, list(x ORDER BY j) AS v FROM u{n} GROUP BY cluster) u ON u.cluster = c.cluster)"""


ORACLE_SQL = {
    "op12_clustering": """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256(concat('1:', vec_id))) - 1 AS INTEGER) AS cluster, v FROM v QUALIFY cluster < 16)"""
    + "".join(map(_round_sql, range(4)))
    + """
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a3 a JOIN c3 c ON a.cluster = c.cluster"""
}
