"""Small linear models, fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Rows:
    """Sparse 0/1 rows: the numbers of the features that each row has."""

    def __init__(self, lists, width: int):
        self.sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.at = (np.concatenate([np.asarray(x, dtype=np.int64) for x in lists])
                   if len(lists) else np.empty(0, np.int64))
        self.row = np.repeat(np.arange(len(lists)), self.sizes)
        self.width = width

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at], minlength=len(self.sizes))

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, values[self.row], minlength=self.width)


def fit_logistic(rows: Rows, goal: np.ndarray, weight: np.ndarray | None = None,
                 penalty: float = 1.0, steps: int = 300,
                 centre: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, penalised by the squared distance
    of the weights from ``centre`` (zero), by accelerated gradient steps with one step size per
    feature."""
    n = max(1, len(goal))
    weight = np.ones(len(goal)) if weight is None else weight
    centre = np.zeros(rows.width) if centre is None else centre
    w, bias = centre.copy(), 0.0
    # The curvature of feature k is at most its weighted count times the row's feature number / 4.
    scale = rows.back(weight * (rows.sizes + 1)) / 4 + penalty
    bias_scale = max(1e-9, float(np.sum(weight * (rows.sizes + 1))) / 4)
    ahead_w, ahead_b, t = w, bias, 1.0
    for _ in range(steps if n else 0):
        error = weight * (sigmoid(rows.dot(ahead_w) + ahead_b) - goal)
        new_w = ahead_w - (rows.back(error) + penalty * (ahead_w - centre)) / scale
        new_b = ahead_b - float(error.sum()) / bias_scale
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = new_w + (t - 1) / t_next * (new_w - w)
        ahead_b = new_b + (t - 1) / t_next * (new_b - bias)
        w, bias, t = new_w, new_b, t_next
    return w, bias


def fit_scale(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that calibrate a logit (Platt's smoothed targets, Newton steps)."""
    positive, negative = float(label.sum()), float(len(label) - label.sum())
    if not positive or not negative:
        return 1.0, 0.0
    goal = np.where(label > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([logit, np.ones(len(logit))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ theta)
        grad = x.T @ (p - goal) + 1e-3 * (theta - [1.0, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def bounded_sample(df: DataFrame, most: int, *identity: Column) -> DataFrame:
    """At most ``most`` rows, the same at every run: those of least hash. Each task cuts to that
    many before anything moves."""
    return df.orderBy(F.xxhash64(*identity), *identity).limit(most)
