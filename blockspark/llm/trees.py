"""Histogram gradient-boosted trees and their flat, vectorised evaluation.

Training is for a bounded sample in memory. Each feature is cut at up to ``bins``
quantiles; a tree grows depth by depth, the split being the one with the largest gain
in the second-order loss over histograms of gradients. All trees end up in four flat
arrays, and a batch of rows walks all trees at once with numpy indexing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Node ``k`` sends a row to ``child[k]`` if ``x[feature[k]] <= cut[k]``, else to the next one.

    A leaf is its own child with an infinite cut; ``value`` counts at leaves only.
    """

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row; rows and trees are walked together, a level at a time."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))[:, None]
        if not len(self.roots) or not len(x):
            return out
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            at = self.child[at] + (x[rows, self.feature[at]] > self.cut[at])
        return out + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 2.0, ridge: float = 1.0) -> Forest:
    """A forest for 0/1 labels. Without rows it is constant at one half; with one class, near that class."""
    n, width = x.shape
    if not n:
        empty = np.zeros(0)
        return Forest(empty.astype(int), empty, empty.astype(int), empty, empty.astype(int), 0, 0.0)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf")) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    feature: list[int] = []
    cut: list[float] = []
    child: list[int] = []
    value: list[float] = []
    roots: list[int] = []

    def node() -> int:
        feature.append(0)
        cut.append(np.inf)
        child.append(len(child))
        value.append(0.0)
        return len(child) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        root = node()
        roots.append(root)
        level = [(root, np.arange(n))]
        for d in range(depth + 1):
            nxt = []
            for k, rows in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                value[k] = -rate * g / (h + ridge)
                best = (1e-6, -1, -1)
                if d < depth and len(rows) >= 2:
                    for j in range(width):
                        gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], len(cuts[j]) + 1))[:-1]
                        hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], len(cuts[j]) + 1))[:-1]
                        gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                        gain[(hl < least * 0.05) | (h - hl < least * 0.05)] = -1
                        if len(gain) and gain[i := int(gain.argmax())] > best[0]:
                            best = (float(gain[i]), j, i)
                if best[1] < 0:
                    margin[rows] += value[k]
                    continue
                _, j, i = best
                left, right = node(), node()
                feature[k], cut[k], child[k] = j, float(cuts[j][i]), left
                below = binned[rows, j] <= i
                nxt += [(left, rows[below]), (right, rows[~below])]
            level = nxt
    # the right child follows the left one, and no finite x is above a leaf's infinite cut
    return Forest(np.array(feature), np.array(cut), np.array(child), np.array(value), np.array(roots), depth, start)
