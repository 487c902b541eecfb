"""Gradient-boosted trees for a bounded table of features, and their calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
NEVER = 1.1  # a threshold that no probability reaches


@dataclass
class Trees:
    """Complete trees of one depth: inner nodes test ``feature > cut``, leaves hold steps."""

    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    start: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        depth = int(np.log2(self.leaves.shape[1]))
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (len(feature))]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of the positive class."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def _grow(codes: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rate: float):
    inner = 2**depth - 1
    feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    node = np.zeros(len(codes), dtype=np.int64)
    for level in range(depth):
        low = 2**level - 1
        for n in range(low, 2 * low + 1):
            mine = np.flatnonzero(node == n)
            best = 1e-6
            total_g, total_h = g[mine].sum(), h[mine].sum()
            for f in range(codes.shape[1]):
                left_g = np.bincount(codes[mine, f], g[mine], BINS).cumsum()[:-1]
                left_h = np.bincount(codes[mine, f], h[mine], BINS).cumsum()[:-1]
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                b = int(gain.argmax()) if len(mine) else 0
                if len(mine) and b < len(edges[f]) and gain[b] > best:
                    best, feature[n], cut[n] = gain[b], f, edges[f][b]
            right = codes[mine, feature[n]] > np.searchsorted(edges[feature[n]], cut[n]) if np.isfinite(cut[n]) else np.zeros(len(mine), bool)
            node[mine] = 2 * n + 1 + right
    leaf = node - inner
    step = np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + 1)
    return feature, cut, rate * step, leaf


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3) -> Trees:
    """Fit all given rows by the gradient of the logistic loss; not calibrated yet."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    target = y.astype(float)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    model = Trees(*(np.zeros((0, 0)) for _ in range(3)), start=float(np.log(share / (1 - share))))
    margin, features, cuts, leaves = np.full(len(target), model.start), [], [], []
    for _ in range(trees):
        p = _logistic(margin)
        feature, cut, leaf, at = _grow(codes, edges, target - p, p * (1 - p), depth, rate)
        margin += leaf[at]
        features.append(feature), cuts.append(cut), leaves.append(leaf)
    model.features, model.cuts, model.leaves = np.array(features), np.array(cuts), np.array(leaves)
    return model


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray) -> None:
    """Fit slope and shift of the margins (Platt) to rows that the trees have not seen.

    Newton steps are halved until they lower the loss. Without rows of both classes the margins
    stay as they are.
    """
    if len(y) < 20 or y.min() == y.max():
        return
    m = np.clip(model.margin(x), -12, 12)
    target = y * (1 - 2 / (len(y) + 2)) + 1 / (len(y) + 2)  # smoothed targets keep the slope finite

    def loss(w: np.ndarray) -> float:
        z = w[0] * m + w[1]
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-4 * (w @ w))

    w = np.array([1.0, 0.0])
    for _ in range(25):
        p = _logistic(w[0] * m + w[1])
        gradient = np.array([((target - p) * m).sum(), (target - p).sum()]) - 1e-3 * w
        s = p * (1 - p)
        hessian = np.array([[(s * m * m).sum(), (s * m).sum()], [(s * m).sum(), s.sum()]]) + 1e-3 * np.eye(2)
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        while np.abs(step).max() > 1e-9 and loss(w + step) > now:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        w = w + step
    if w[0] > 0:
        model.slope, model.shift = float(w[0]), float(w[1])


def threshold(model: Trees, x: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Smallest probability from which the given rows, unseen before, reach ``precision``."""
    p = model.probability(x)
    order = np.argsort(-p, kind="stable")
    good = np.cumsum(y[order].astype(float)) / np.arange(1, len(order) + 1) >= precision
    last = np.flatnonzero(good)
    return max(0.5, float(p[order][last[-1]])) if len(last) else NEVER
