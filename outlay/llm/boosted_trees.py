"""Gradient boosting of shallow trees on counted feature rows, and the trees as column expressions.

Training sees one row per distinct feature combination with its number of
positive and negative cases, so its size depends on the features' value ranges
and not on the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 30
DEPTH = 2
RATE = 0.4
_RIDGE = 1.0


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    upto: int
    low: Leaf | Split
    high: Leaf | Split


def _grow(rows: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int) -> Leaf | Split:
    """The tree of largest gain: left are values up to a threshold."""
    total, curve = gradient.sum(), hessian.sum()
    best = (1e-9, None)
    if depth:
        for feature in range(rows.shape[1]):
            for upto in np.unique(rows[:, feature])[:-1]:
                low = rows[:, feature] <= upto
                g, h = gradient[low].sum(), hessian[low].sum()
                gain = g * g / (h + _RIDGE) + (total - g) ** 2 / (curve - h + _RIDGE) - total * total / (curve + _RIDGE)
                if gain > best[0]:
                    best = (gain, (feature, int(upto), low))
    if best[1] is None:
        return Leaf(float(RATE * total / (curve + _RIDGE)))
    feature, upto, low = best[1]
    return Split(
        feature,
        upto,
        _grow(rows[low], gradient[low], hessian[low], depth - 1),
        _grow(rows[~low], gradient[~low], hessian[~low], depth - 1),
    )


def _value(tree: Leaf | Split, row: np.ndarray) -> float:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.upto else tree.high
    return tree.value


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: list[Leaf | Split]

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.start + sum(_value(tree, row) for tree in self.trees) for row in rows])

    def column(self, feature: Callable[[int], Column]) -> Column:
        """The log-odds as nested CASE expressions."""

        def build(tree: Leaf | Split) -> Column:
            if isinstance(tree, Leaf):
                return F.lit(tree.value)
            return F.when(feature(tree.feature) <= tree.upto, build(tree.low)).otherwise(build(tree.high))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + build(tree)
        return total


def boost(rows: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> Boosted:
    """Fit to rows of small integers with their counts; without any case the log-odds are low."""
    count = positive + negative
    if not len(rows) or not count.sum():
        return Boosted(-10.0, [])
    start = float(np.log((positive.sum() + 0.5) / (negative.sum() + 0.5)))
    odds, trees = np.full(len(rows), start), []
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-odds))
        tree = _grow(rows, positive - count * chance, count * chance * (1 - chance), DEPTH)
        trees.append(tree)
        odds = odds + np.array([_value(tree, row) for row in rows])
    return Boosted(start, trees)


def calibrated_threshold(odds: np.ndarray, positive: np.ndarray, negative: np.ndarray, precision: float) -> float:
    """The lowest log-odds from which on at least ``precision`` of the cases are positive; infinite if there is none."""
    order = np.argsort(-odds, kind="stable")
    right, all_cases = np.cumsum(positive[order]), np.cumsum((positive + negative)[order])
    last_of_tie = np.r_[odds[order][1:] != odds[order][:-1], True] if len(order) else np.zeros(0, dtype=bool)
    good = np.flatnonzero(last_of_tie & (all_cases > 0) & (right >= precision * all_cases))
    return float(odds[order][good[-1]]) if len(good) else float("inf")
