"""Binary decision trees on histograms, in numpy, for bounded training samples.

Trees are stored complete (heap order), so that prediction is a few array look-ups per
level.  A node that isn't split sends every row left.  Training is deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """feature, threshold: (trees, 2^depth - 1); value: (trees, 2^depth)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.value.shape[1]))
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (len(v) - 1)]
        return out


def edges_of(x: np.ndarray, most: int = 48) -> list[np.ndarray]:
    out = []
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        if len(values) > most:
            values = np.unique(np.quantile(values, np.linspace(0, 1, most)))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def fit_tree(bins, edges, grad, hess, depth, min_leaf, smooth, rng, share):
    n, d = bins.shape
    inner, width = (1 << depth) - 1, 64
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(n, np.int64)
    for level in range(depth):
        first, nodes = (1 << level) - 1, 1 << level
        local = at - first
        best = np.full(nodes, 1e-9)
        choice = [None] * nodes
        for j in np.sort(rng.choice(d, max(1, int(round(d * share))), replace=False)):
            key = local * width + bins[:, j]
            g = np.bincount(key, grad, nodes * width).reshape(nodes, width)
            h = np.bincount(key, hess, nodes * width).reshape(nodes, width)
            c = np.bincount(key, minlength=nodes * width).reshape(nodes, width)
            gl, hl, cl = g.cumsum(1), h.cumsum(1), c.cumsum(1)
            gt, ht, ct = gl[:, -1:], hl[:, -1:], cl[:, -1:]
            gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
            gain[(cl < min_leaf) | (ct - cl < min_leaf)] = -1
            gain[:, len(edges[j]) :] = -1
            k = gain.argmax(1)
            for node in np.flatnonzero(gain[np.arange(nodes), k] > best):
                best[node], choice[node] = gain[node, k[node]], (j, k[node])
        right = np.zeros(n, bool)
        for node, found in enumerate(choice):
            if found is not None:
                j, k = found
                feature[first + node], threshold[first + node] = j, edges[j][k]
                own = local == node
                right[own] = bins[own, j] > k
        at = 2 * at + 1 + right
    leaf = at - inner
    g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
    return feature, threshold, g / (h + smooth), leaf


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)


def boosted(x, y, *, trees=80, depth=4, rate=0.15, min_leaf=8, smooth=1.0, seed=1) -> Forest:
    """Logistic gradient boosting; raw() gives log-odds."""
    edges = edges_of(x)
    bins, rng = binned(x, edges), np.random.default_rng(seed)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    raw, parts = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        f, t, v, leaf = fit_tree(bins, edges, y - p, p * (1 - p), depth, min_leaf, smooth, rng, 0.7)
        v = rate * np.clip(v, -4, 4)
        raw += v[leaf]
        parts.append((f, t, v))
    return Forest(*(np.stack(a) for a in zip(*parts)), base)


def random_forest(x, y, *, trees=60, depth=8, min_leaf=2, seed=1) -> Forest:
    """Bagged trees with random features at each level; raw() gives the share of positives."""
    edges = edges_of(x)
    bins, rng = binned(x, edges), np.random.default_rng(seed)
    parts = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        f, t, v, _ = fit_tree(bins[rows], edges, y[rows], np.ones(len(y)), depth, min_leaf, 1e-6, rng, max(0.3, x.shape[1] ** -0.5))
        parts.append((f, t, v / trees))
    return Forest(*(np.stack(a) for a in zip(*parts)), 0.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the knots (x, mean y) of the best non-decreasing steps."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum, count, x from, x to
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([b, 1, a, a])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]):
            s, n, _, to = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = to
    # A pinch of the neighbouring classes keeps scores off exact 0 and 1.
    knots = [(at, (s + 0.5 * (n and s / n) + 0.25 * (1 / (n + 1))) / (n + 0.5 + 0.5 / (n + 1))) for s, n, a, b in blocks for at in (a, b)]
    xs, ys = np.array([k[0] for k in knots]), np.maximum.accumulate(np.array([k[1] for k in knots]))
    return xs, np.clip(ys, 0, 1)
