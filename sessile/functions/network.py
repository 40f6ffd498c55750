"""Forward pass of a small convolutional network that enlarges gray frames; weights are a parameter."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Output channels and window of each layer of the enlarging network.
LAYERS = ((64, 5), (64, 3), (32, 3), (9, 3))


def convolved(x: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Channels ``(c, h, w)`` under filters ``(o, c, k, k)``; zeros beyond the rim keep height and width."""
    k = weight.shape[-1]
    before = (k - 1) // 2
    padded = np.pad(x, ((0, 0), (before, k - 1 - before), (before, k - 1 - before)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, (k, k), axis=(1, 2))
    return np.einsum("chwij,ocij->ohw", windows, weight, optimize=True) + bias[:, None, None]


def shuffled(x: np.ndarray, times: int) -> np.ndarray:
    """``times * times`` channels dealt out over pixels: one channel, each side ``times`` as long."""
    _, h, w = x.shape
    return x.reshape(times, times, h, w).transpose(2, 0, 3, 1).reshape(h * times, w * times)


def network(weights: list[tuple[np.ndarray, np.ndarray]], times: int = 3) -> Callable[[np.ndarray], np.ndarray]:
    """A function from pixels in 0..1 to a frame ``times`` as high and wide; a layer is (filters, biases), followed by ReLU."""

    def run(image: np.ndarray) -> np.ndarray:
        x = image[None].astype(np.float32)
        for weight, bias in weights:
            x = np.maximum(convolved(x, weight.astype(np.float32), bias.astype(np.float32)), 0)
        return shuffled(x, times)

    return run


def load(path: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights of a NumPy archive: ``w0, b0, w1, b1, ...``."""
    with np.load(path) as f:
        return [(f[f"w{k}"], f[f"b{k}"]) for k in range(len(f.files) // 2)]


def plain(times: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights under which the network repeats each pixel: what is there before any training."""
    out, given = [], 1
    for channels, k in [*LAYERS[:-1], (times * times, LAYERS[-1][1])]:
        weight = np.zeros((channels, given, k, k), np.float32)
        weight[:, 0, k // 2, k // 2] = 1
        out.append((weight, np.zeros(channels, np.float32)))
        given = channels
    return out
