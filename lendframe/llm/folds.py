"""Which rows may teach a model, and the two small fits that models share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_column: str) -> Column:
    """True for rows that no model may learn from: crc32 of the id as text is divisible by 5. A null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def teaching_labels(labels: DataFrame, label: str, id_column: str = "doc_id") -> DataFrame:
    """``id`` and ``label`` (0 or 1) of the rows to learn from; the largest of several labels of one id counts."""
    known = labels.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
    return known.groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the last for the constant, by Newton's method."""
    rows = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        gradient = rows.T @ (p - y) + penalty * w
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
