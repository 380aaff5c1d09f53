"""Gradient-boosted trees for a binary label, on binned features (numpy; trained on bounded samples)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Logistic loss, Newton leaf values, trees of a fixed depth split level by level.

    Columns from ``binary_from`` on hold only 0 and 1, mostly 0; their splits are found from the ones alone."""

    trees: int = 40
    depth: int = 4
    rate: float = 0.3
    bins: int = 32
    ridge: float = 1.0
    base: float = 0.0
    binary_from: int | None = None
    fitted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # features, thresholds, leaf values

    def fit(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray | float = 1.0) -> BoostedTrees:
        rows = len(x)
        width = x.shape[1] if self.binary_from is None else self.binary_from
        flags = x[:, width:] > 0.5
        flag_row, flag_column = np.nonzero(flags)
        n_flags = flags.shape[1]
        # half of the edges follow the rows, half the values, so that rare values have theirs
        grid = np.linspace(0, 1, self.bins // 2 + 1)[1:-1]
        edges = [np.unique(np.concatenate([np.quantile(x[:, j], grid), np.quantile(np.unique(x[:, j]), grid)])) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(rows, self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            slope, curve = weights * (y - p), weights * p * (1 - p)
            node = np.zeros(rows, np.int64)
            features, thresholds = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                here = 2**level
                best = np.full(here, 1e-6)
                chosen = [(0, np.inf, self.bins)] * here
                for j in range(width):
                    at = node * self.bins + binned[:, j]
                    g = np.bincount(at, slope, here * self.bins).reshape(here, -1)
                    h = np.bincount(at, curve, here * self.bins).reshape(here, -1)
                    gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                    ga, ha = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                    gain = gl**2 / (hl + self.ridge) + (ga - gl) ** 2 / (ha - hl + self.ridge) - ga**2 / (ha + self.ridge)
                    gain = gain[:, : len(edges[j])]
                    if gain.size:
                        top = gain.argmax(1)
                        for k in range(here):
                            if gain[k, top[k]] > best[k]:
                                best[k], chosen[k] = gain[k, top[k]], (j, edges[j][top[k]], top[k])
                if n_flags:
                    at = node[flag_row] * n_flags + flag_column
                    g1 = np.bincount(at, slope[flag_row], here * n_flags).reshape(here, -1)  # of the rows with a 1
                    h1 = np.bincount(at, curve[flag_row], here * n_flags).reshape(here, -1)
                    ga, ha = (np.bincount(node, v, here)[:, None] for v in (slope, curve))
                    gain = g1**2 / (h1 + self.ridge) + (ga - g1) ** 2 / (ha - h1 + self.ridge) - ga**2 / (ha + self.ridge)
                    for k, top in enumerate(gain.argmax(1)):
                        if gain[k, top] > best[k]:
                            best[k], chosen[k] = gain[k, top], (width + int(top), 0.5, 0)
                for k, (j, threshold, _) in enumerate(chosen):
                    features[here - 1 + k], thresholds[here - 1 + k] = j, threshold
                right = np.zeros(rows, bool)
                for k, (j, _, cut) in enumerate(chosen):
                    at = np.flatnonzero(node == k)
                    right[at] = flags[at, j - width] if j >= width else binned[at, j] > cut
                node = node * 2 + right
            leaves = 2**self.depth
            value = self.rate * np.bincount(node, slope, leaves) / (np.bincount(node, curve, leaves) + self.ridge)
            score += value[node]
            self.fitted.append((features, thresholds, value))
        return self

    def compact(self) -> list[int]:
        """The columns that the trees use; from now on ``probability`` takes these alone, in this order."""
        used = sorted({int(j) for features, thresholds, _ in self.fitted for j in features[np.isfinite(thresholds)]})
        place = {j: k for k, j in enumerate(used)}
        self.fitted = [(np.array([place.get(int(j), 0) for j in features]), thresholds, value) for features, thresholds, value in self.fitted]
        return used

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, thresholds, value in self.fitted:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = node * 2 + (x[rows, features[at]] > thresholds[at])
            score += value[node]
        return 1 / (1 + np.exp(-score))
