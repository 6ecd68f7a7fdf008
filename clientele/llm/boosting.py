"""Gradient boosted trees over small integer features, fitted on a bounded sample on the driver.

The model is plain data: it can be turned into a column expression, so that scoring stays in SQL, or
applied to a matrix of features inside a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = tuple  # (value,) or (feature, bound, tree if feature <= bound, tree otherwise)


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float, smooth: float = 1.0) -> Tree:
    total_g, total_h = g.sum(), h.sum()
    value = (float(rate * total_g / (total_h + smooth)),)
    if depth == 0 or len(g) < 2:
        return value
    best = (1e-9, -1, 0)
    for f in range(x.shape[1]):
        column = x[:, f]
        low, size = int(column.min()), int(column.max()) - int(column.min()) + 1
        if size < 2:
            continue
        left_g = np.bincount(column - low, g, size).cumsum()[:-1]
        left_h = np.bincount(column - low, h, size).cumsum()[:-1]
        gain = (
            left_g**2 / (left_h + smooth)
            + (total_g - left_g) ** 2 / (total_h - left_h + smooth)
            - total_g**2 / (total_h + smooth)
        )
        gain[(left_h < 1e-3) | (total_h - left_h < 1e-3)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, low + k)
    if best[1] < 0:
        return value
    under = x[:, best[1]] <= best[2]
    return (best[1], best[2], *(_grow(x[m], g[m], h[m], depth - 1, rate, smooth) for m in (under, ~under)))


def _apply(tree: Tree, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    return np.where(x[:, tree[0]] <= tree[1], _apply(tree[2], x), _apply(tree[3], x))


class BoostedTrees:
    def __init__(self, start: float, trees: Sequence[Tree]):
        self.start, self.trees = start, list(trees)

    @classmethod
    def fit(cls, x, y, weight, rounds: int = 30, depth: int = 3, rate: float = 0.3) -> BoostedTrees:
        """Logistic boosting. Rows: integer features, 0/1 labels, weights. Without rows all scores are 0."""
        if not len(y):
            return cls(-20.0, [])
        x = np.asarray(x, np.int64).reshape(len(y), -1)
        y, weight = np.asarray(y, float), np.asarray(weight, float)
        share = min(max(float((y * weight).sum() / weight.sum()), 1e-4), 1 - 1e-4)
        start = float(np.log(share / (1 - share)))
        margin, trees = np.full(len(y), start), []
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = _grow(x, (y - p) * weight, p * (1 - p) * weight, depth, rate)
            if len(tree) == 1:
                break
            trees.append(tree)
            margin += _apply(tree, x)
        return cls(start, trees)

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        for tree in self.trees:
            margin += _apply(tree, x)
        return 1 / (1 + np.exp(-margin))

    def column(self, feature: Callable[[int], Column]) -> Column:
        """The score as an expression over ``feature(i)``."""

        def walk(tree: Tree) -> Column:
            if len(tree) == 1:
                return F.lit(tree[0])
            return F.when(feature(tree[0]) <= tree[1], walk(tree[2])).otherwise(walk(tree[3]))

        margin = F.lit(self.start)
        for tree in self.trees:
            margin = margin + walk(tree)
        return 1 / (1 + F.exp(-margin))


def calibrated(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray, precision: float) -> float:
    """The lowest score above which held-out precision is reached; above 1 if there is none."""
    order = np.argsort(-scores, kind="stable")
    right, every = np.cumsum((labels * weight)[order]), np.cumsum(weight[order])
    ok = np.flatnonzero(right >= precision * every)
    last = [k for k in ok if k + 1 == len(order) or scores[order[k + 1]] < scores[order[k]]]
    return float(scores[order[last[-1]]]) if last else 2.0
