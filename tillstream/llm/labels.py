"""Labels that may be learnt from, and small linear models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One in so many ids is held out, by the checksum of the id as text.
FOLDS = 5


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row's label is kept from learning; a NULL id is not held out."""
    return F.coalesce(
        F.crc32(F.col(id_column).cast("string")) % FOLDS == 0, F.lit(False)
    )


def learnable(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id`` and ``label`` 0 or 1, one row for each id that is not held out.

    Of an id that is labelled more than once the larger label holds; NULLs are left out.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col(column)).cast("int").alias("label"))
    )


def bounded(labels: DataFrame, most: int) -> DataFrame:
    """At most so many of the labelled ids, the same ones at every run."""
    return labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(
    x: np.ndarray,
    y: np.ndarray,
    penalty: float = 1.0,
    rounds: int = 25,
    weight: np.ndarray | None = None,
) -> np.ndarray:
    """Weights of a logistic regression with soft labels, the intercept last, by Newton's method."""
    weight = np.ones(len(y)) if weight is None else weight
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (y - p)) - ridge * w
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w
