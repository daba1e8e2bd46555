"""Histogram gradient-boosted trees for two classes, and their flat form.

Features are cut into at most 255 bins at quantiles of the training rows; each tree grows by depth, its
splits found from sums of gradients per bin. A fitted model is five arrays (feature, threshold, left,
right, value) over the nodes of all trees, walked for all rows at once.
"""

from __future__ import annotations

import numpy as np


class FlatTrees:
    """Arrays over all nodes; a leaf has feature -1."""

    def __init__(self, base: float, roots: list[int], feature: list[int], threshold: list[float], left: list[int], right: list[int], value: list[float]) -> None:
        self.base, self.roots = base, np.array(roots, np.int32)
        self.feature, self.threshold = np.array(feature, np.int32), np.array(threshold)
        self.left, self.right, self.value = np.array(left, np.int32), np.array(right, np.int32), np.array(value)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
                at = np.where(inner, down, at)
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40))) if len(x) else np.zeros(0)


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: int = 20, shrink: float = 1.0
) -> FlatTrees:
    """Logistic loss. With one class only (or no rows), the model is a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [_cuts(x[:, j], bins) for j in range(x.shape[1])]
        code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.int64)
        flat = code + np.arange(x.shape[1]) * bins
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
            roots.append(len(feature))
            work = [(np.arange(len(y)), 0, None)]
            while work:
                rows, level, parent = work.pop()
                at = len(feature)
                if parent is not None:
                    (left if parent[1] else right)[parent[0]] = at
                g, h = grad[rows].sum(), hess[rows].sum()
                for store, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, -rate * g / (h + shrink))):
                    store.append(v)
                best = _split(flat[rows], grad[rows], hess[rows], x.shape[1], bins, least, shrink) if level < depth and len(rows) >= 2 * least else None
                if best is None:
                    margin[rows] += value[at]
                    continue
                j, b = best
                feature[at], threshold[at] = j, float(cuts[j][b])
                go = code[rows, j] <= b
                work += [(rows[~go], level + 1, (at, False)), (rows[go], level + 1, (at, True))]
    return FlatTrees(base, roots, feature, threshold, left, right, value)


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Between neighbouring values where these are few, else at quantiles."""
    values = np.unique(column)
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(flat: np.ndarray, grad: np.ndarray, hess: np.ndarray, width: int, bins: int, least: int, shrink: float) -> tuple[int, int] | None:
    one = flat.ravel()
    size = width * bins
    g = np.bincount(one, np.repeat(grad, width), size).reshape(width, bins).cumsum(1)
    h = np.bincount(one, np.repeat(hess, width), size).reshape(width, bins).cumsum(1)
    n = np.bincount(one, minlength=size).reshape(width, bins).cumsum(1)
    total_g, total_h, total_n = g[:, -1:], h[:, -1:], n[:, -1:]
    gain = g**2 / (h + shrink) + (total_g - g) ** 2 / (total_h - h + shrink) - total_g**2 / (total_h + shrink)
    gain[(n < least) | (total_n - n < least)] = -1
    j, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (int(j), int(b)) if gain[j, b] > 1e-6 else None
