"""Linear stacks and small networks as matrices."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def collapse(layers: Sequence[tuple]) -> tuple[np.ndarray, float]:
    """The one linear map (weight vector, bias) that a stack of linear layers with one output is."""
    weight, bias = (np.asarray(x, np.float64) for x in layers[0])
    for w, b in layers[1:]:
        w, b = np.asarray(w, np.float64), np.asarray(b, np.float64)
        weight, bias = w @ weight, w @ bias + b
    if weight.shape[0] != 1:
        raise ValueError(f"the last layer has {weight.shape[0]} outputs, not 1")
    return weight[0], float(bias[0])


def fold_batch_norm(weight, bias, mean, var, gamma, beta, eps: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """A linear layer that gives what the layer and the batch norm after it give."""
    scale = np.asarray(gamma) / np.sqrt(np.asarray(var) + eps)
    return np.asarray(weight) * scale[:, None], (np.asarray(bias) - mean) * scale + beta


def forward(x: np.ndarray, layers: Sequence[tuple]) -> np.ndarray:
    """ReLU between the layers, a sigmoid at the end."""
    x = x.astype(np.float64)
    for w, b in layers[:-1]:
        x = np.maximum(x @ w.T + b, 0)
    w, b = layers[-1]
    return 1 / (1 + np.exp(-(x @ w.T + b)[:, 0]))
