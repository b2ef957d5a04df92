"""A small random forest: trained on the driver from a bounded table, applied to whole batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: a node is a leaf where ``feature`` is negative."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        """The mean share of positives in the leaves that each row reaches."""
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                go = x[row, np.maximum(f, 0)] <= self.cut[at]
                at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
            total += self.value[at]
        return total / len(self.roots)


def train(x: np.ndarray, y: np.ndarray, trees=40, depth=9, least=3, seed=1) -> Forest:
    """Bootstrap samples, a random subset of features per node, Gini splits at quantiles."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    some = max(2, int(np.sqrt(x.shape[1])))

    def split(rows):
        best, choice = np.inf, None
        labels = y[rows]
        for f in rng.choice(x.shape[1], some, replace=False):
            values = x[rows, f]
            for cut in np.unique(np.quantile(values, np.linspace(0.05, 0.95, 19), method="lower")):
                go = values <= cut
                n = int(go.sum())
                if least <= n <= len(rows) - least:
                    p, q = labels[go].mean(), labels[~go].mean()
                    impurity = n * p * (1 - p) + (len(rows) - n) * q * (1 - q)
                    if impurity < best:
                        best, choice = impurity, (f, cut, go)
        return choice

    def grow(rows, level):
        number, share = len(nodes), float(y[rows].mean())
        nodes.append([-1, 0.0, 0, 0, share])
        if level < depth and 0 < share < 1 and len(rows) >= 2 * least:
            choice = split(rows)
            if choice:
                f, cut, go = choice
                nodes[number][:2] = [int(f), float(cut)]
                nodes[number][2] = grow(rows[go], level + 1)
                nodes[number][3] = grow(rows[~go], level + 1)
        return number

    roots = [grow(rng.integers(0, len(y), len(y)), 0) for _ in range(trees)]
    columns = list(zip(*nodes))
    kinds = (np.int32, float, np.int32, np.int32, float)
    return Forest(*(np.array(c, k) for c, k in zip(columns, kinds)), np.array(roots, np.int32))
