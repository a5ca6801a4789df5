"""Small logistic regressions on bounded samples, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Linear:
    """weights . (x - mean) / scale + bias"""

    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 150) -> Linear:
    """Penalised maximum likelihood by accelerated gradient steps; the same for the same rows in any order
    but for rounding."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    # a value that hardly ever differs is not blown up
    scale = np.maximum(scale, 1e-3)
    z = (x - mean) / scale
    n, d = z.shape
    w, v, bias, bias_v = np.zeros(d), np.zeros(d), float(log_odds(np.array([y.mean()]))[0]), 0.0
    # largest curvature: of the logistic 1/4, of the data the largest eigenvalue, bounded by power steps
    q = np.ones(d) / np.sqrt(d)
    for _ in range(20):
        q = z.T @ (z @ q)
        size = np.linalg.norm(q)
        if size == 0:
            break
        q /= size
    step = 1 / (0.25 * (np.linalg.norm(z @ q) ** 2 + n) * 1.1 + ridge)
    for k in range(1, steps + 1):
        pull = (k - 1) / (k + 2)
        at, at_bias = w + pull * v, bias + pull * bias_v
        gap = logistic(z @ at + at_bias) - y
        new, new_bias = at - step * (z.T @ gap + ridge * at), at_bias - step * gap.sum()
        v, bias_v, w, bias = new - w, new_bias - bias, new, new_bias
    return Linear(w, bias, mean, scale)


def calibrate(margin: np.ndarray, y: np.ndarray) -> Linear:
    """Log odds of held-out rows as a straight line of one or more margins."""
    return fit(margin.reshape(len(y), -1), y, ridge=1.0, steps=400)
