"""Small histogram gradient-boosted trees and their compilation to Spark columns.

Training data is bounded by the caller and fits the driver; scoring is a
Spark column expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """x[feature] <= at goes left."""

    feature: int
    at: float
    left: Split | float
    right: Split | float


Tree = Split | float


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _grow(bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, least: int, l2: float) -> Tree:
    g, h = grad[rows].sum(), hess[rows].sum()
    value = float(g / (h + l2))
    if depth == 0 or len(rows) < 2 * least:
        return value
    best: tuple[float, int, int] | None = None
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        b = bins[rows, f]
        n = np.bincount(b, minlength=len(cut) + 1).cumsum()[:-1]
        gl = np.bincount(b, grad[rows], len(cut) + 1).cumsum()[:-1]
        hl = np.bincount(b, hess[rows], len(cut) + 1).cumsum()[:-1]
        gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
        gain[(n < least) | (len(rows) - n < least)] = -np.inf
        k = int(gain.argmax())
        if gain[k] > 1e-9 and (best is None or gain[k] > best[0] + 1e-12):
            best = (float(gain[k]), f, k)
    if best is None:
        return value
    _, f, k = best
    left = bins[rows, f] <= k
    return Split(f, float(cuts[f][k]), *(_grow(bins, cuts, grad, hess, r, depth - 1, least, l2) for r in (rows[left], rows[~left])))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, least: int = 8, l2: float = 1.0, bins: int = 32) -> tuple[float, list[Tree]]:
    """Boosted trees for the logistic loss: a base log-odds and trees to add (already scaled by rate)."""
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    cuts = []
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])
        mid = (v[:-1] + v[1:]) / 2
        cuts.append(mid if len(mid) < bins else np.unique(np.quantile(mid, np.linspace(0, 1, bins))))
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    score, out = np.full(len(y), base), []
    for _ in range(trees):
        q = sigmoid(score)
        tree = _grow(binned, cuts, y - q, q * (1 - q), np.arange(len(y)), depth, least, l2)
        tree = scaled(tree, rate)
        out.append(tree)
        score += predict(tree, x)
    return base, out


def scaled(tree: Tree, by: float) -> Tree:
    return Split(tree.feature, tree.at, scaled(tree.left, by), scaled(tree.right, by)) if isinstance(tree, Split) else tree * by


def predict(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(x), tree)
    return np.where(x[:, tree.feature] <= tree.at, predict(tree.left, x), predict(tree.right, x))


def column(tree: Tree, feature: Callable[[int], Column]) -> Column:
    """The tree as a CASE expression."""
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(feature(tree.feature) <= F.lit(tree.at), column(tree.left, feature)).otherwise(column(tree.right, feature))


def paths(tree: Tree, above: tuple = ()) -> list[tuple]:
    """Every node but the root as a rule: a conjunction of (feature, goes_left, at)."""
    if not isinstance(tree, Split):
        return []
    out = []
    for child, left in ((tree.left, True), (tree.right, False)):
        rule = (*above, (tree.feature, left, tree.at))
        out.append(rule)
        out += paths(child, rule)
    return out
