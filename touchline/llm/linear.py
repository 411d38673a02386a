"""Logistic regression on sparse rows of hashed features, for bounded training samples."""

from __future__ import annotations

import numpy as np


def sparse_sums(rows: np.ndarray, products: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, products, minlength=n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, weight: np.ndarray, size: int,
        l2: float = 1e-4, steps: int = 300, rate: float = 0.1,
        twins: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None, twin_penalty: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features and a bias, by Adam on all rows.

    target: labels from 0 to 1; weight: of each row.  twins: a second version (rows, columns,
    values) of the same rows; the squared difference of the two versions' scores is penalised.
    """
    n = len(target)
    total = weight.sum()
    w, b = np.zeros(size), 0.0
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = sparse_sums(rows, values * w[columns], n) + b
        error = weight * (sigmoid(z) - target) / total
        grad = np.bincount(columns, values * error[rows], minlength=size) + l2 * w
        if twins is not None and twin_penalty:
            r2, c2, v2 = twins
            other = sparse_sums(r2, v2 * w[c2], n) + b
            p, q = sigmoid(z), sigmoid(other)
            pull = 2 * twin_penalty * weight * (p - q) / total
            grad += np.bincount(columns, values * (pull * p * (1 - p))[rows], minlength=size)
            grad -= np.bincount(c2, v2 * (pull * q * (1 - q))[r2], minlength=size)
        full = np.append(grad, error.sum())
        mean = 0.9 * mean + 0.1 * full
        square = 0.999 * square + 0.001 * full * full
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)
