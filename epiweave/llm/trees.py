"""Gradient-boosted trees on binned features, in numpy, with monotonic constraints.

A forest is kept as flat node arrays: feature, threshold, left and right child and value of every
node of every tree, roots first. Rows go left if their value is at most the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum over trees, all rows of a tree at once, one level at a time."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while True:
                inner = self.feature[node] >= 0
                if not inner.any():
                    break
                go_left = x[rows, np.maximum(self.feature[node], 0)] <= self.threshold[node]
                node = np.where(inner, np.where(go_left, self.left[node], self.right[node]), node)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def boost(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64,
    least: int = 20, smooth: float = 1.0, monotone: dict[int, int] | None = None, weight: np.ndarray | None = None,
) -> Forest:
    """Fit to logistic loss. ``monotone`` gives +1 (never falls) or -1 (never rises) by feature.

    A constrained split is taken only if its children's values are in order, and both subtrees are
    then held to their side of the middle, so the whole forest is monotone.
    """
    monotone = monotone or {}
    weight = np.ones(len(y)) if weight is None else weight
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    margin = np.full(len(y), base := float(np.log(share / (1 - share))))
    nodes: list[list] = []
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        me = len(nodes)
        nodes.append([-1, 0.0, me, me, float(np.clip(-total_g / (total_h + smooth), low, high)) * rate])
        best = None
        if level < depth and len(rows) >= 2 * least:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, f]
                gs, hs = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1], np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                ns = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                vl, vr = np.clip(-gs / (hs + smooth), low, high), np.clip(-(total_g - gs) / (total_h - hs + smooth), low, high)
                gain = gs**2 / (hs + smooth) + (total_g - gs) ** 2 / (total_h - hs + smooth)
                ok = (ns >= least) & (len(rows) - ns >= least)
                if f in monotone:
                    ok &= monotone[f] * (vr - vl) >= 0
                gain = np.where(ok, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > total_g**2 / (total_h + smooth) + 1e-6 and (best is None or gain[k] > best[0]):
                    best = (gain[k], f, k, (vl[k] + vr[k]) / 2)
        if best:
            _, f, k, middle = best
            goes = binned[rows, f] <= k
            bounds = {0: (low, high, low, high), 1: (low, middle, middle, high), -1: (middle, high, low, middle)}[monotone.get(f, 0)]
            left = grow(rows[goes], g, h, level + 1, bounds[0], bounds[1])
            right = grow(rows[~goes], g, h, level + 1, bounds[2], bounds[3])
            nodes[me][:4] = [f, float(cuts[f][k]), left, right]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        root = grow(np.arange(len(y)), g, h, 0, -np.inf, np.inf)
        roots.append(root)
        tree = Forest(*_arrays(nodes), np.array([root]), 0.0)
        margin = margin + tree.margin(x)
    return Forest(*_arrays(nodes), np.array(roots), base)


def _arrays(nodes: list[list]) -> tuple[np.ndarray, ...]:
    f, t, a, b, v = zip(*nodes)
    return np.array(f), np.array(t), np.array(a), np.array(b), np.array(v)
