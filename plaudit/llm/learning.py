"""Labelled rows for the classifiers, and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.llm.common import uniform


def labelled(labels: DataFrame, label: str, wanted: Column, per_class: int, seed: str) -> DataFrame:
    """(doc_id, y, weight) of about ``per_class`` labelled documents of each class, drawn by a hash of the id.

    ``weight`` is how many labelled documents each stands for. Only rows that are ``wanted`` and whose label is 0 or 1 take part; a document with several
    labels has the largest.
    """
    rows = (
        labels.filter(wanted & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    )
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}  # two rows
    share = F.when(F.col("y") == 1, min(1.0, per_class / sizes.get(1, 1))).otherwise(
        min(1.0, per_class / sizes.get(0, 1))
    )
    return rows.filter(uniform(F.col("doc_id"), seed=seed) < share).withColumn("weight", F.lit(1.0) / share)


class Logistic:
    """Regularised logistic regression on standardised features, by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray, weight: float = 1e-2, steps: int = 40):
        """``rows`` are the rows' weights."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self.inputs(x)
        self.beta = np.zeros(z.shape[1])
        for _ in range(steps):
            p = self.squash(z @ self.beta)
            gradient = z.T @ (rows * (p - y)) + weight * self.beta
            hessian = (z * (rows * p * (1 - p))[:, None]).T @ z + weight * np.eye(z.shape[1])
            self.beta -= np.linalg.solve(hessian, gradient)
        q = np.clip(self(x), 1e-6, 1 - 1e-6)
        self.loss = float(-(rows * np.log(np.where(y == 1, q, 1 - q))).sum() / rows.sum())

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])

    @staticmethod
    def squash(v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v, -35, 35)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.squash(self.inputs(x) @ self.beta)
