"""A small histogram gradient-boosting classifier for bounded samples."""

from __future__ import annotations

import numpy as np

CUTS = 32


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, least: float = 4.0):
    """Trees for the logistic loss: (level, [(feature, threshold, leaf values)]), oblivious trees of ``depth``.

    All nodes of a level share one test, so a tree is ``depth`` tests and ``2 ** depth`` values.
    """
    rows, width = x.shape
    edges = []
    binned = np.zeros((rows, width), np.int32)
    for j in range(width):
        cut = np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 1)[1:-1], method="lower"))
        edges.append(cut)
        binned[:, j] = np.searchsorted(cut, x[:, j], "left")
    base = float(np.log((y.sum() + 1) / (rows - y.sum() + 1)))
    score = np.full(rows, base)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(rows, np.int64)
        tests = []
        for level in range(depth):
            groups = 1 << level
            best = (0.0, None, None)
            for j in range(width):
                n = len(edges[j]) + 1
                if n < 2:
                    continue
                key = node * n + binned[:, j]
                g = np.bincount(key, grad, groups * n).reshape(groups, n)
                h = np.bincount(key, hess, groups * n).reshape(groups, n)
                lg, lh = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                rg, rh = g.sum(1, keepdims=True) - lg, h.sum(1, keepdims=True) - lh
                gain = (lg**2 / (lh + least) + rg**2 / (rh + least)).sum(0)
                gain -= (g.sum(1) ** 2 / (h.sum(1) + least)).sum()
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), j, k)
            if best[1] is None:
                break
            tests.append((best[1], float(edges[best[1]][best[2]])))
            node = node * 2 + (binned[:, best[1]] > best[2])
        if not tests:
            break
        size = 1 << len(tests)
        value = rate * np.bincount(node, grad, size) / (np.bincount(node, hess, size) + least)
        score = score + value[node]
        trees.append((tests, value))
    return base, trees


def predict(model, x: np.ndarray) -> np.ndarray:
    """Log-odds of every row."""
    base, trees = model
    out = np.full(len(x), base)
    for tests, value in trees:
        node = np.zeros(len(x), np.int64)
        for feature, threshold in tests:
            node = node * 2 + (x[:, feature] > threshold)
        out += value[node]
    return out
