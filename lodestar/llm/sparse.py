"""Hashed sparse rows for the linear models: features in tasks, fitting on a
bounded sample.

Sampling keeps each row with a chance of ``per_class / class size``, decided
by a hash of its key, so it needs one grouped count, no sort and no group in
one place, and gives the same rows on a retry.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rows:
    """Compressed sparse rows of a small sample."""

    def __init__(self, cols: list[np.ndarray], vals: list[np.ndarray], dim: int):
        self.dim, self.n = dim, len(cols)
        self.ptr = np.zeros(len(cols) + 1, np.int64)
        np.cumsum([len(c) for c in cols], out=self.ptr[1:])
        self.col = np.concatenate([np.zeros(0, np.int64), *cols]).astype(np.int64)
        self.val = np.concatenate([np.zeros(0), *vals])
        self.row = np.repeat(np.arange(self.n), np.diff(self.ptr))

    def take(self, pick: np.ndarray) -> Rows:
        return Rows([self.col[self.ptr[i]:self.ptr[i + 1]] for i in pick],
                    [self.val[self.ptr[i]:self.ptr[i + 1]] for i in pick], self.dim)

    def only(self, slots: np.ndarray) -> Rows:
        """The rows without the columns for which ``slots`` is false."""
        keep = slots[self.col]
        cut = np.cumsum(np.bincount(self.row[keep], minlength=self.n))[:-1]
        return Rows(np.split(self.col[keep], cut), np.split(self.val[keep], cut), self.dim)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * r[self.row], minlength=self.dim)


def descend(grad, w: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Adam on a full gradient; the same numbers on every run."""
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = grad(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def stratified(df: DataFrame, key: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label (all of a smaller class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    share = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.join(F.broadcast(sizes), label).filter(share * F.col("_n") < per_class).drop("_n")
