"""A small convolutional network over byte codes, in numpy.

Codes are embedded, filters of several widths run over the positions, each filter keeps its largest
response, and a softmax layer reads those. Trained with Adam on the cross entropy, a pass over some windows at a time, so
that passes over several sets can be averaged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CODES = 256
WIDTHS = (2, 3, 4)
SEED = 7
ROWS = 256  # windows that run at a time: their patches stay in the processor's cache


@dataclass
class ConvNet:
    embed: np.ndarray    # codes x e
    filters: np.ndarray  # (widest * e) x filters, narrow filters being zero past their width
    bias: np.ndarray
    out: np.ndarray      # filters x classes
    out_bias: np.ndarray

    @property
    def widest(self) -> int:
        return self.filters.shape[0] // self.embed.shape[1]

    def patches(self, codes: np.ndarray) -> np.ndarray:
        """Rows x positions x (widest * e)."""
        view = np.lib.stride_tricks.sliding_window_view(self.embed[codes].reshape(len(codes), -1),
                                                        self.filters.shape[0], axis=1)
        return np.ascontiguousarray(view[:, ::self.embed.shape[1]])

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        patches = self.patches(codes)
        n, positions, size = patches.shape
        return np.maximum((patches.reshape(-1, size) @ self.filters).reshape(n, positions, -1).max(1) + self.bias, 0)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """Class scores of windows (rows x length, uint8)."""
        parts = [self.pooled(codes[i:i + ROWS]) @ self.out + self.out_bias for i in range(0, len(codes), ROWS)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.out_bias)), np.float32)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def mask_of(widths: tuple[int, ...], each: int, size: int) -> np.ndarray:
    """Which entries of the filters are used: narrow ones end before the widest."""
    return np.concatenate([np.repeat((np.arange(max(widths) * size) < w * size)[:, None], each, 1) for w in widths], 1)


def start(classes: int, widths: tuple[int, ...] = WIDTHS, each: int = 12, size: int = 6, rng: np.random.Generator | None = None) -> list[np.ndarray]:
    """The state of a fit: the parameters of a network, Adam's means and squares of their gradients, its steps so far."""
    rng = rng or np.random.default_rng(SEED)
    mask, f = mask_of(widths, each, size), each * len(widths)
    net = ConvNet(rng.normal(0, 0.5, (CODES, size)).astype(np.float32),
                  (rng.normal(0, 1 / np.sqrt(max(widths) * size), mask.shape) * mask).astype(np.float32),
                  np.zeros(f, np.float32), rng.normal(0, 0.1, (f, classes)).astype(np.float32),
                  np.zeros(classes, np.float32))
    parameters = parameters_of(net)
    return [*parameters, *(np.zeros_like(p) for p in parameters * 2), np.zeros(1)]


def parameters_of(net: ConvNet) -> list[np.ndarray]:
    return [net.embed, net.filters, net.bias, net.out, net.out_bias]


def net_of(state: list[np.ndarray]) -> ConvNet:
    return ConvNet(*state[:5])


def epoch(state: list[np.ndarray], codes: np.ndarray, labels: np.ndarray, order: np.ndarray, widths: tuple[int, ...] = WIDTHS,
          batch: int = 64, rate: float = 0.005) -> list[np.ndarray]:
    """The state after one more pass, in the given order, over windows (rows x length, uint8) and their class numbers."""
    state = [x.copy() for x in state]
    net, parameters, means, squares, step = net_of(state), state[:5], state[5:10], state[10:15], state[15]
    f, size, widest = len(net.bias), net.embed.shape[1], net.widest
    mask = mask_of(widths, f // len(widths), size)
    for first in range(0, len(order), batch):
        rows = order[first:first + batch]
        x, y = codes[rows], labels[rows]
        patches = net.patches(x)
        n, positions, width = patches.shape
        response = (patches.reshape(-1, width) @ net.filters).reshape(n, positions, f)
        where = response.argmax(1)                                    # n x f
        top = np.take_along_axis(response, where[:, None], 1)[:, 0] + net.bias
        active = top > 0
        pooled = top * active
        error = softmax(pooled @ net.out + net.out_bias)
        error[np.arange(n), y] -= 1
        error /= n
        down = (error @ net.out.T) * active                           # n x f
        chosen = patches[np.arange(n)[:, None], where]                # n x f x width
        to_patch = down[:, :, None] * net.filters.T[None]             # n x f x width
        seen = x[np.arange(n)[:, None, None], where[:, :, None] + np.arange(widest)]  # n x f x widest
        flat = to_patch.reshape(-1, size)
        to_embed = np.stack([np.bincount(seen.ravel(), flat[:, k], CODES) for k in range(size)], 1)
        gradients = [to_embed, np.einsum("nf,nfw->wf", down, chosen) * mask, down.sum(0), pooled.T @ error, error.sum(0)]
        step += 1
        done = float(step[0])
        for p, g, m, s in zip(parameters, gradients, means, squares):
            m *= 0.9
            m += 0.1 * g
            s *= 0.999
            s += 0.001 * np.square(g)
            p -= (rate * (m / (1 - 0.9 ** done)) / (np.sqrt(s / (1 - 0.999 ** done)) + 1e-8)).astype(np.float32)
    return state


def train(codes: np.ndarray, labels: np.ndarray, classes: int, widths: tuple[int, ...] = WIDTHS, each: int = 12,
          size: int = 6, epochs: int = 4, batch: int = 64, rate: float = 0.005, seed: int = SEED) -> ConvNet:
    """Fit a network to windows (rows x length, uint8) and their class numbers. The seed fixes the result."""
    rng = np.random.default_rng(seed)
    state = start(classes, widths, each, size, rng)
    for _ in range(epochs):
        state = epoch(state, codes, labels, rng.permutation(len(codes)), widths, batch, rate)
    return net_of(state)
