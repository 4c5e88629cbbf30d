"""Gradient-boosted trees with monotone constraints, kept as flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """All trees in five node arrays; a leaf points to itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row, all trees at once, one step down per level."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -500, 500)))


def _best_split(codes, grad, hess, monotone, low, high, min_child, l2):
    """Feature, bin and the two child values with the largest gain that keep the order asked for."""
    g, h, best = grad.sum(), hess.sum(), None
    parent = g * g / (h + l2)
    for f in range(codes.shape[1]):
        n = np.cumsum(np.bincount(codes[:, f], minlength=BINS))[:-1]
        gl = np.cumsum(np.bincount(codes[:, f], grad, BINS))[:-1]
        hl = np.cumsum(np.bincount(codes[:, f], hess, BINS))[:-1]
        gr, hr = g - gl, h - hl
        vl = np.clip(-gl / (hl + l2), low, high)
        vr = np.clip(-gr / (hr + l2), low, high)
        gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - parent
        allowed = (n >= min_child) & (len(codes) - n >= min_child)
        if monotone[f]:
            allowed &= (vr - vl) * monotone[f] >= 0
        gain = np.where(allowed, gain, -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (gain[k], f, k, vl[k], vr[k])
    return best


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2,
        min_child: int = 10, l2: float = 1.0) -> Forest:
    """Boost logistic loss. monotone holds 1, -1 or 0 for each feature; values between children bound their subtrees."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(1) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if len(x) else np.zeros((0, x.shape[1]), int)
    rate_pos = min(max((y.sum() + 1) / (len(y) + 2), 1e-6), 1 - 1e-6)
    base = float(np.log(rate_pos / (1 - rate_pos)))
    margin, nodes, roots = np.full(len(y), base), [], []

    def grow(rows, level, low, high, value):
        at = len(nodes)
        nodes.append([0, np.inf, at, at, value * rate])
        if level == depth or len(rows) < 2 * min_child:
            margin[rows] += value * rate
            return at
        found = _best_split(codes[rows], grad[rows], hess[rows], monotone, low, high, min_child, l2)
        if found is None:
            margin[rows] += value * rate
            return at
        _, f, k, vl, vr = found
        mid, left = (vl + vr) / 2, codes[rows, f] <= k
        bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[monotone[f]]
        threshold = edges[f][k] if k < len(edges[f]) else np.inf
        l = grow(rows[left], level + 1, *bounds[0], vl)
        r = grow(rows[~left], level + 1, *bounds[1], vr)
        nodes[at] = [f, threshold, l, r, 0.0]
        return at

    for _ in range(trees if len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf, 0.0))
    cols = list(zip(*nodes)) if nodes else [(), (), (), (), ()]
    return Forest(np.array(cols[0], int), np.array(cols[1], float), np.array(cols[2], int), np.array(cols[3], int),
                  np.array(cols[4], float), np.array(roots, int), depth, base)
