"""Gradient-boosted trees for two classes and a calibrated threshold, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0)):
            column.append(x)
        self.value.append(value)
        return len(self.value) - 1

    def score(self, rows: np.ndarray) -> np.ndarray:
        feature, cut, left, right = (
            np.array(x) for x in (self.feature, self.cut, self.left, self.right)
        )
        at = np.zeros(len(rows), np.int64)
        while (inner := np.flatnonzero(feature[at] >= 0)).size:
            node = at[inner]
            below = rows[inner, feature[node]] <= cut[node]
            at[inner] = np.where(below, left[node], right[node])
        return np.array(self.value)[at]


def _grow(tree: Tree, rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, edges: list[np.ndarray],
          depth: int, rate: float) -> int:
    """Add the node for ``rows``: the split that gains most, or a leaf."""
    total, weight = slope.sum(), curve.sum()
    node = tree.add(rate * total / (weight + 1.0))
    best = (1e-6, -1, 0.0)
    if depth and len(rows) >= 20:
        for j, cuts in enumerate(edges):
            if not len(cuts):
                continue
            place = np.searchsorted(cuts, rows[:, j], "left")
            g = np.cumsum(np.bincount(place, slope, len(cuts) + 1))[:-1]
            h = np.cumsum(np.bincount(place, curve, len(cuts) + 1))[:-1]
            gain = g**2 / (h + 1.0) + (total - g) ** 2 / (weight - h + 1.0) - total**2 / (weight + 1.0)
            gain[(h < 0.5) | (weight - h < 0.5)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), j, float(cuts[k]))
    if best[1] >= 0:
        below = rows[:, best[1]] <= best[2]
        tree.feature[node], tree.cut[node] = best[1], best[2]
        tree.left[node] = _grow(tree, rows[below], slope[below], curve[below], edges, depth - 1, rate)
        tree.right[node] = _grow(tree, rows[~below], slope[~below], curve[~below], edges, depth - 1, rate)
    return node


@dataclass
class Boosted:
    """Trees for log-odds, and the line that calibrates them."""

    trees: list[Tree]
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        for tree in self.trees:
            out += tree.score(rows)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(rows) + self.shift, -40, 40)))


def fit_boosted(rows: np.ndarray, answer: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3) -> Boosted:
    """Boosting by Newton steps on the logistic loss, over binned features."""
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(rows.shape[1])]
    edges = [e[:-1] if len(e) and e[-1] >= rows[:, j].max() else e for j, e in enumerate(edges)]
    model, score = Boosted([]), np.zeros(len(rows))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = Tree()
        _grow(tree, rows, answer - p, p * (1 - p), edges, depth, rate)
        model.trees.append(tree)
        score += tree.score(rows)
    return model


def calibrate(model: Boosted, rows: np.ndarray, answer: np.ndarray) -> None:
    """Platt's line through the log-odds of rows that were not trained on."""
    x, slope, shift = model.raw(rows), 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -40, 40)))
        w = p * (1 - p) + 1e-6
        a, b, c = (w * x * x).sum() + 1e-3, (w * x).sum(), w.sum() + 1e-3
        g, h = ((answer - p) * x).sum() - 1e-3 * (slope - 1), (answer - p).sum() - 1e-3 * shift
        det = a * c - b * b
        if det <= 1e-12:
            break
        slope, shift = slope + (c * g - b * h) / det, shift + (a * h - b * g) / det
    model.slope, model.shift = float(slope), float(shift)


def threshold(probability: np.ndarray, answer: np.ndarray, precision: float) -> float:
    """The least probability from which on ``precision`` of the rows are right; over 1 if none."""
    order = np.argsort(-probability, kind="stable")
    right = np.cumsum(answer[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(right >= precision)
    return float(probability[order[good[-1]]]) if len(good) else 1.1
