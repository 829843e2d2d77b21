"""Small dense solvers for models fitted on a bounded sample, on the driver."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int = 100,
             memory: int = 8, tol: float = 1e-6) -> np.ndarray:
    """Limited-memory BFGS with backtracking; ``f`` returns the value and the gradient."""
    val, grad = f(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(grad).max() < tol:
            break
        q, alphas = grad.copy(), []
        for s, y, rho in reversed(steps):
            a = rho * (s @ q)
            alphas.append(a)
            q -= a * y
        if steps:
            s, y, _ = steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(q).sum())
        for (s, y, rho), a in zip(steps, reversed(alphas), strict=True):
            q += (a - rho * (y @ q)) * s
        slope, t = -(grad @ q), 1.0
        if slope >= 0:
            steps, q, slope = [], grad / max(1.0, np.abs(grad).sum()), -(grad @ grad) / max(1.0, np.abs(grad).sum())
        for _ in range(30):
            new = x - t * q
            nval, ngrad = f(new)
            if nval <= val + 1e-4 * t * slope:
                break
            t *= 0.5
        else:
            break
        s, y = new - x, ngrad - grad
        done = abs(val - nval) <= 1e-9 * max(1.0, abs(val))
        if s @ y > 1e-12:
            steps = [*steps[1 - memory:], (s, y, 1.0 / (s @ y))]
        x, val, grad = new, nval, ngrad
        if done:
            break
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def log_loss(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Weighted logistic loss of margins ``z`` for labels 0/1."""
    return float((w * (np.logaddexp(0.0, z) - y * z)).sum())
