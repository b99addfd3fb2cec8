"""Gradient-boosted trees for a yes-or-no label, with monotonic constraints, trained and scored in numpy.

Training sees a bounded sample. Trees are complete to a fixed depth and flattened into node arrays, so that a batch is
scored level by level: each row follows ``2 * node + 1 (+ 1 if value > threshold)``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 80
DEPTH = 4
RATE = 0.15
BINS = 64
SMOOTHING = 5.0


@dataclass
class Forest:
    """``feature`` and ``threshold`` are (trees, 2^depth - 1), ``leaf`` is (trees, 2^depth); ``base`` is the prior."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def margins(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.base)
        rows = np.arange(len(values))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(values), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (values[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def probabilities(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(values)))


def train(values: np.ndarray, labels: np.ndarray, directions: np.ndarray) -> Forest:
    """``directions``: per feature +1 or -1 if the margin may only rise or fall with it, else 0."""
    n, width = values.shape
    inner = 2**DEPTH - 1
    share = float(np.clip(labels.mean() if n else 1.0, 1e-3, 1 - 1e-3))
    empty = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), float(np.log(share / (1 - share))))
    if n == 0 or labels.min() == labels.max():
        return empty
    cuts = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, values[:, f], "left") for f, c in enumerate(cuts)], 1)
    margin = np.full(n, empty.base)
    features, thresholds, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        feature, threshold, leaf, at = _grow(binned, cuts, labels - p, p * (1 - p), directions)
        margin += leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Forest(np.stack(features), np.stack(thresholds), np.stack(leaves), empty.base)


def _grow(binned: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, weight: np.ndarray, directions: np.ndarray):
    """One tree. Each node has bounds on its value, which a constrained split narrows for both sides."""
    inner = 2**DEPTH - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
    members: dict[int, np.ndarray] = {0: np.arange(len(binned))}
    value = lambda g, h: g / (h + SMOOTHING)
    for node in range(inner):
        rows = members.pop(node)
        best, split = 1e-9, None
        g_all, h_all = slope[rows].sum(), weight[rows].sum()
        for f, edges in enumerate(cuts):
            if not len(edges) or not len(rows):
                continue
            g = np.cumsum(np.bincount(binned[rows, f], slope[rows], len(edges) + 1))[:-1]
            h = np.cumsum(np.bincount(binned[rows, f], weight[rows], len(edges) + 1))[:-1]
            left = np.clip(value(g, h), low[node], high[node])
            right = np.clip(value(g_all - g, h_all - h), low[node], high[node])
            gain = _gain(left, g, h) + _gain(right, g_all - g, h_all - h)
            gain -= _gain(np.clip(value(g_all, h_all), low[node], high[node]), g_all, h_all)
            bad = (directions[f] * (right - left) < 0) | (h < 1) | (h_all - h < 1)
            gain = np.where(bad, 0, gain)
            k = int(gain.argmax())
            if gain[k] > best:
                best, split = gain[k], (f, k, left[k], right[k])
        for side in (1, 2):
            low[2 * node + side], high[2 * node + side] = low[node], high[node]
        if split is None:
            members[2 * node + 1], members[2 * node + 2] = rows, rows[:0]
            continue
        f, k, left, right = split
        feature[node], threshold[node] = f, cuts[f][k]
        if directions[f]:
            middle = (left + right) / 2
            upper, lower = (2 * node + 2, 2 * node + 1) if directions[f] > 0 else (2 * node + 1, 2 * node + 2)
            low[upper], high[lower] = middle, middle
        goes_right = binned[rows, f] > k
        members[2 * node + 1], members[2 * node + 2] = rows[~goes_right], rows[goes_right]
    leaf, at = np.zeros(inner + 1), np.zeros(len(binned), np.int64)
    for node, rows in members.items():
        leaf[node - inner] = RATE * np.clip(value(slope[rows].sum(), weight[rows].sum()), low[node], high[node])
        at[rows] = node - inner
    return feature, threshold, leaf, at


def _gain(step, g, h):
    return 2 * step * g - step * step * (h + SMOOTHING)
