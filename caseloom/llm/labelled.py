"""Bounded, repeatable samples of labelled documents for the models of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def class_sizes(labels: DataFrame, label: str, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """The learnable rows (doc_id, y; the larger of several labels of a document) and how many each class has."""
    rows = labels.where(learn & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    return rows, {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text, y for at most per_class documents of each class (smallest hashes of doc_id); sizes of the classes."""
    rows, sizes = class_sizes(labels, label, learn)
    rows = materialize(rows, "labels")
    chosen = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = materialize(chosen[0].unionByName(chosen[1]).coalesce(1), "chosen")  # at most 2 * per_class rows
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id"), sizes


def logistic(x, y, weight, steps: int = 50, ridge: float = 1e-3):
    """Intercept and slope of a weighted one-variable logistic fit, by Newton's method."""
    import numpy as np

    a = np.stack([np.ones(len(x)), np.asarray(x, "f8")], 1)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        g = a.T @ (weight * (y - p)) - ridge * b
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        d = np.linalg.solve(h, g)
        b += np.clip(d, -5, 5)
        if abs(d).max() < 1e-8:
            break
    return float(b[0]), float(b[1])
