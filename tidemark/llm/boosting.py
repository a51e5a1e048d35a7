"""Small gradient-boosted trees: fitted in numpy on the driver, applied as a column expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    feature: int = -1  # -1: a leaf
    at: float = 0.0  # goes left where feature <= at
    left: Node | None = None
    right: Node | None = None
    value: float = 0.0


@dataclass
class Trees:
    names: list[str]
    trees: list[Node]
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        for tree in self.trees:
            _add(tree, x, np.arange(len(x)), out)
        return out

    def column(self, feature):
        """The same as an expression; feature(name) gives a feature's column."""
        from pyspark.sql import functions as F

        def of(node: Node):
            if node.feature < 0:
                return F.lit(float(node.value))
            return F.when(feature(self.names[node.feature]) <= F.lit(float(node.at)), of(node.left)).otherwise(of(node.right))

        out = F.lit(float(self.base))
        for tree in self.trees:
            out = out + of(tree)
        return out


def _add(node: Node, x: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    if node.feature < 0:
        out[rows] += node.value
        return
    left = x[rows, node.feature] <= node.at
    _add(node.left, x, rows[left], out)
    _add(node.right, x, rows[~left], out)


def fit(x: np.ndarray, y: np.ndarray, names: list[str], n_trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0, least: int = 20) -> Trees:
    """Newton boosting of the logistic loss; each split is the best of all features' midpoints."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    raw = np.full(len(y), base)
    trees = []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-raw))
        tree = _grow(x, p - y, p * (1 - p), np.arange(len(y)), depth, rate, ridge, least)
        _add(tree, x, np.arange(len(y)), raw)
        trees.append(tree)
    return Trees(names, trees, base)


def _grow(x, g, h, rows, depth, rate, ridge, least) -> Node:
    leaf = Node(value=float(-rate * g[rows].sum() / (h[rows].sum() + ridge)))
    if depth == 0 or len(rows) < 2 * least:
        return leaf
    best, total_g, total_h = 1e-6, g[rows].sum(), h[rows].sum()
    for f in range(x.shape[1]):
        order = rows[np.argsort(x[rows, f], kind="stable")]
        v, a, b = x[order, f], np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        n = np.arange(1, len(order))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(order) - n >= least)
        if not ok.any():
            continue
        gain = a**2 / (b + ridge) + (total_g - a) ** 2 / (total_h - b + ridge) - total_g**2 / (total_h + ridge)
        i = int(np.argmax(np.where(ok, gain, -1)))
        if gain[i] > best:
            best, leaf.feature, leaf.at = gain[i], f, float((v[i] + v[i + 1]) / 2)
    if leaf.feature >= 0:
        left = x[rows, leaf.feature] <= leaf.at
        leaf.left = _grow(x, g, h, rows[left], depth - 1, rate, ridge, least)
        leaf.right = _grow(x, g, h, rows[~left], depth - 1, rate, ridge, least)
    return leaf
