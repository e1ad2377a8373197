"""Small ridge logistic regression by Newton steps."""

from __future__ import annotations

import numpy as np


def fit_logistic(features: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, constant: bool = True) -> np.ndarray:
    """Rows ``mean, scale, beta``; the last entry is the constant, which is 0 if not wanted."""
    n, d = features.shape
    weight = np.ones(n) if weight is None else weight
    mean, scale = (features.mean(axis=0), features.std(axis=0) + 1e-9) if constant else (np.zeros(d), np.ones(d))
    x = np.hstack([(features - mean) / scale, np.full((n, 1), float(constant))])
    beta, penalty = np.zeros(d + 1), ridge * np.eye(d + 1)
    penalty[-1, -1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        hessian = x.T @ ((weight * np.maximum(p * (1 - p), 1e-9))[:, None] * x) + penalty
        step = np.linalg.solve(hessian, x.T @ (weight * (label - p)) - penalty @ beta)
        beta = beta + step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return np.stack([np.append(mean, 0.0), np.append(scale, 1.0), beta])


def sigmoid(curve: np.ndarray, features: np.ndarray) -> np.ndarray:
    mean, scale, beta = curve
    z = ((features - mean[:-1]) / scale[:-1]) @ beta[:-1] + beta[-1]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
