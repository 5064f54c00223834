"""Boosted trees on counted, binned rows, applied as a column expression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = tuple  # ("leaf", value) or (feature, cut, tree at most the cut, tree above)


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, shrink: float) -> Tree:
    g, h = grad.sum(), hess.sum()
    best = (1e-6, None, None)
    if depth:
        for f in range(x.shape[1]):
            values, at = np.unique(x[:, f], return_inverse=True)
            gl = np.cumsum(np.bincount(at, grad))[:-1]
            hl = np.cumsum(np.bincount(at, hess))[:-1]
            if len(gl):
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, int(values[k]))
    _, f, cut = best
    if f is None:
        return ("leaf", float(shrink * g / (h + 1)))
    low = x[:, f] <= cut
    return (
        f,
        cut,
        _grow(x[low], grad[low], hess[low], depth - 1, shrink),
        _grow(x[~low], grad[~low], hess[~low], depth - 1, shrink),
    )


def _value(tree: Tree, x: np.ndarray) -> np.ndarray:
    if tree[0] == "leaf":
        return np.full(len(x), tree[1])
    return np.where(x[:, tree[0]] <= tree[1], _value(tree[2], x), _value(tree[3], x))


def fit(x: np.ndarray, positive: np.ndarray, negative: np.ndarray, rounds: int = 20, depth: int = 3) -> tuple[float, list[Tree]]:
    """Logistic boosting on distinct feature rows ``x`` with their counts of either label."""
    n = positive + negative
    base = float(np.log((positive.sum() + 1) / (negative.sum() + 1)))
    margin, trees = np.full(len(x), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, positive - n * p, n * p * (1 - p), depth, 0.3)
        trees.append(tree)
        margin += _value(tree, x)
    return base, trees


def predict(model: tuple[float, list[Tree]], x: np.ndarray) -> np.ndarray:
    base, trees = model
    margin = base + sum((_value(t, x) for t in trees), np.zeros(len(x)))
    return 1 / (1 + np.exp(-margin))


def expression(model: tuple[float, list[Tree]], features: list[str]) -> Column:
    """The same score as :func:`predict`, as nested conditions."""

    def branch(tree: Tree) -> Column:
        if tree[0] == "leaf":
            return F.lit(tree[1])
        return F.when(F.col(features[tree[0]]) <= tree[1], branch(tree[2])).otherwise(branch(tree[3]))

    base, trees = model
    margin = F.lit(base)
    for t in trees:
        margin = margin + branch(t)
    return 1 / (1 + F.exp(-margin))
