"""Bounded samples of labelled rows to fit classifiers on, and small numpy models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def sample(labels: DataFrame, label: str, per_class: int, where: Column | None = None) -> DataFrame:
    """(doc_id, y): per_class labelled ids of either label at most, in hash order; an id of several labels has the largest. Rows with a null id or label are left out."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    own = own if where is None else own.where(where)
    own = own.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")).where("y in (0, 1)")
    own = settle(own.withColumn("u", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(3)), 11) / float(1 << 53)))
    sizes = {r[0]: r[1] for r in own.groupBy("y").count().collect()}
    parts = []
    for y in (0, 1):
        mine = own.where(F.col("y") == y)
        # Hashes are even: the first per_class lie below a bound, so that only they are sorted in one task.
        below = 1.5 * per_class / max(1, sizes.get(y, 0))
        if below < 1 and mine.where(F.col("u") < below).count() >= per_class:
            mine = mine.where(F.col("u") < below)
        parts.append(mine.orderBy("u", "doc_id").limit(per_class))
    return settle(parts[0].union(parts[1]).select("doc_id", "y"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 30) -> np.ndarray:
    """Coefficients, the intercept last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    c, ridge = np.zeros(x.shape[1]), l2 * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ c)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ c)
        c += step
        if np.abs(step).max() < 1e-8:
            break
    return c


def thinned(x: np.ndarray, keep: float = 0.5, seed: int = 1) -> np.ndarray:
    """A copy of rows of 0 and 1 that keeps each 1 by chance, one of a row's for certain: what one of many signs is worth by itself."""
    rng = np.random.default_rng(seed)
    mask = rng.random(x.shape, np.float32) < keep
    mask[np.arange(len(x)), np.argmax(x * rng.random(x.shape, np.float32), axis=1)] = True
    return (x * mask).astype(np.float32)


def fit_machine(x: np.ndarray, y: np.ndarray, rank: int = 8, l2: float = 1e-4, steps: int = 250, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """Factorization machine for logistic loss (bias, linear weights, factors), by Adam over all rows; only what isn't zero in x is read."""
    rng = np.random.default_rng(seed)
    n, k = x.shape
    row, col = np.nonzero(x)
    value = x[row, col].astype(np.float32)
    by_col = np.argsort(col, kind="stable")
    # Sums by row and by column over runs; runs without entries stay 0.
    rows, row_at = np.unique(row, return_index=True)
    cols, col_at = np.unique(col[by_col], return_index=True)
    row_c, value_c = row[by_col], value[by_col]
    squares, squares_c = (value * value)[:, None], (value_c * value_c)[:, None]

    def sums(each: np.ndarray, at: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros((size, each.shape[1]), np.float32)
        if len(at):
            out[to] = np.add.reduceat(each, at, axis=0)
        return out

    params = [np.zeros(1, np.float32), np.zeros(k, np.float32), rng.normal(0, 0.05, (k, rank)).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32)
    for t in range(1, steps + 1):
        b, w, v = params
        each = np.concatenate([v, w[:, None], (v * v).sum(1, keepdims=True)], axis=1)[col]
        each[:, :-1] *= value[:, None]
        each[:, -1:] *= squares
        got = sums(each, row_at, rows, n)
        inner = got[:, :rank]
        z = b[0] + got[:, rank] + 0.5 * ((inner * inner).sum(1) - got[:, -1])
        g = balance * (sigmoid(z) - y).astype(np.float32)
        back = np.concatenate([g[:, None] * inner, g[:, None]], axis=1)[row_c] * value_c[:, None]
        back = sums(np.concatenate([back, g[row_c][:, None] * squares_c], axis=1), col_at, cols, k)
        grads = [np.array([g.sum()], np.float32), back[:, rank] + l2 * w, back[:, :rank] - back[:, -1:] * v + l2 * v]
        for p, grad, m, s in zip(params, grads, first, second, strict=True):
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return float(params[0][0]), params[1], params[2]
