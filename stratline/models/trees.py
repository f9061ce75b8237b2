"""Regression trees grown from sums of gradient and hessian, level by level.

The sums come from elsewhere; here is what is done with them, which does not depend on the
number of rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class Plan:
    trees: int = 200
    depth: int = 4
    rate: float = 0.05
    l2: float = 1.0
    least: float = 1.0  # hessian of a leaf, at least; rows under squared loss
    subsample: float = 1.0
    positive_weight: float = 1.0
    logistic: bool = False
    seed: int = 42
    without_fold: int | None = None  # rows of this fold are not learnt from


@dataclass
class Tree:
    """Nodes as in a heap: the children of i are 2 i + 1 and 2 i + 2. A leaf has feature -1;
    a row goes left if its bin is at most `bin`."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def stump(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after so many levels."""
        at = np.zeros(len(bins), int)
        flat, rows = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
        for _ in range(levels):
            feature = self.feature.take(at)
            right = flat.take(rows + np.maximum(feature, 0)) > self.bin.take(at)
            at = np.where(feature < 0, at, 2 * at + 1 + right)
        return at


@dataclass
class Ensemble:
    plan: Plan
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def margins(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees[first:]:
            out += tree.value[tree.nodes(bins, self.plan.depth)]
        return out


def split(tree: Tree, level: int, g: np.ndarray, h: np.ndarray, plan: Plan) -> None:
    """Choose the best split of every node of a level, and the values of its children."""
    for k in range(2**level):
        node = 2**level - 1 + k
        if level and tree.feature[(node - 1) // 2] < 0:
            continue
        whole_g, whole_h = g[k, 0].sum(), h[k, 0].sum()
        if level == 0:
            tree.value[node] = leaf(whole_g, whole_h, plan)
        left_g, left_h = np.cumsum(g[k], 1)[:, :-1], np.cumsum(h[k], 1)[:, :-1]
        right_g, right_h = whole_g - left_g, whole_h - left_h
        # A little more than zero: the far side of a cut behind all rows sums to rounding.
        fits = (left_h >= max(plan.least, 1e-9 * whole_h)) & (right_h >= max(plan.least, 1e-9 * whole_h))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g**2 / (left_h + plan.l2) + right_g**2 / (right_h + plan.l2) - whole_g**2 / (whole_h + plan.l2)
        gain = np.where(fits, gain, -np.inf)
        # Sums come in any order: gains that differ by rounding count as equal, the first wins.
        best = gain.max(initial=-np.inf)
        if not np.isfinite(best) or best <= 1e-10 * (1 + whole_g**2 / (whole_h + plan.l2)):
            continue
        feature, at = np.unravel_index(int(np.argmax(gain >= best - 1e-9 * abs(best))), gain.shape)
        tree.feature[node], tree.bin[node], tree.gain[node] = feature, at, gain[feature, at]
        tree.value[2 * node + 1] = leaf(left_g[feature, at], left_h[feature, at], plan)
        tree.value[2 * node + 2] = leaf(right_g[feature, at], right_h[feature, at], plan)


def leaf(g: float, h: float, plan: Plan) -> float:
    return float(-plan.rate * g / (h + plan.l2)) if h + plan.l2 > 0 else 0.0


def can_split(tree: Tree, level: int) -> bool:
    """Whether a node of this level is the child of a split."""
    if level == 0:
        return True
    parents = np.arange(2 ** (level - 1) - 1, 2**level - 1)
    return bool((tree.feature[parents] >= 0).any())
