"""Small models fitted on the driver from bounded samples: logistic regression and Platt's calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps; ``y`` may be probabilities."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (y - p)) - penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w = w + step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept from scores (log odds) to calibrated log odds, with Platt's smoothed targets."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0.5, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = fit_logistic(scores[:, None], target, ridge=1e-3)
    return float(slope), float(offset)


class SparseLogistic:
    """Logistic regression on presence of features, rows given as offsets into one list of features."""

    def __init__(self, width: int, ridge: float = 1e-4, steps: int = 300, rate: float = 0.5):
        self.width, self.ridge, self.steps, self.rate = width, ridge, steps, rate

    def fit(self, features: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        n, w, b = len(y), np.zeros(self.width), 0.0
        row = np.repeat(np.arange(n), np.diff(offsets))
        square, square_b = np.full(self.width, 1e-8), 1e-8
        for _ in range(self.steps):
            p = sigmoid(np.bincount(row, weights=w[features], minlength=n) + b)
            miss = (p - y) / max(n, 1)
            g = np.bincount(features, weights=miss[row], minlength=self.width) + self.ridge * w
            gb = miss.sum()
            square, square_b = square + g * g, square_b + gb * gb
            w, b = w - self.rate * g / np.sqrt(square), b - self.rate * gb / np.sqrt(square_b)
        return w, float(b)
