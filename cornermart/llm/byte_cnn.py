"""A small convolutional network over bytes, trained in numpy.

Bytes are embedded, filters of several widths slide over a fixed-length window, the largest answer
of each filter in the window is kept, and a softmax layer reads those. For use, embedding and filters
are folded into tables by byte pair, so that a filter of width 2 costs one lookup per byte, one of
width 3 or 4 two.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 256
EMBEDDING = 8
FILTERS = 16
WIDTHS = (2, 3, 4)
BLOCK = 64  # windows answered at once


@dataclass(frozen=True)
class Network:
    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]  # by width: (width * EMBEDDING, FILTERS)
    biases: tuple[np.ndarray, ...]
    dense: np.ndarray
    offset: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Filter answers to the first pair of all widths, to a third byte, and to a second pair."""
        e = self.embedding
        parts = [w.reshape(-1, EMBEDDING, FILTERS) for w in self.filters]

        def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return ((e @ first)[:, None, :] + (e @ second)[None, :, :]).reshape(65536, FILTERS)

        heads = [pair(p[0], p[1]) + b for p, b in zip(parts, self.biases, strict=True)]
        third, second = e @ parts[1][2], pair(parts[2][2], parts[2][3])
        return tuple(np.ascontiguousarray(t, np.float32) for t in (np.concatenate(heads, axis=1), third, second))

    def probabilities(self, windows: np.ndarray, tables: tuple) -> np.ndarray:
        """Class probabilities of each row of WINDOW bytes."""
        head, third, second = tables
        out = np.empty((len(windows), len(self.offset)))
        n = WINDOW - 3  # places where the widest filter fits
        for at in range(0, len(windows), BLOCK):
            b = windows[at : at + BLOCK].astype(np.int32)
            codes = (b[:, :-1] << 8) | b[:, 1:]
            answers = head.take(codes[:, :n], axis=0)
            answers[:, :, FILTERS : 2 * FILTERS] += third.take(b[:, 2 : n + 2], axis=0)
            answers[:, :, 2 * FILTERS :] += second.take(codes[:, 2 : n + 2], axis=0)
            logits = np.maximum(answers.max(1), 0) @ self.dense + self.offset
            p = np.exp(logits - logits.max(1, keepdims=True))
            out[at : at + BLOCK] = p / p.sum(1, keepdims=True)
        return out


def train(windows: np.ndarray, label: np.ndarray, classes: int, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the softmax loss, rows in a fixed shuffled order."""
    rng = np.random.default_rng(seed)
    weights = [rng.normal(0, 0.5, (256, EMBEDDING))]
    weights += [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS)) for w in WIDTHS]
    weights += [np.zeros(FILTERS) for _ in WIDTHS]
    weights += [rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)), np.zeros(classes)]
    weights = [w.astype(np.float32) for w in weights]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    n, k, step = WINDOW - max(WIDTHS) + 1, len(WIDTHS), 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x, y = windows[rows], label[rows]
            here = np.arange(len(rows))
            embedded = weights[0][x]
            pooled, seen = [], []
            for i, w in enumerate(WIDTHS):
                strips = np.concatenate([embedded[:, j : j + n] for j in range(w)], axis=2)
                answers = strips @ weights[1 + i] + weights[1 + k + i]
                place = answers.argmax(1)
                best = np.take_along_axis(answers, place[:, None, :], 1)[:, 0]
                pooled.append(np.maximum(best, 0))
                seen.append((strips, place, best > 0))
            hidden = np.concatenate(pooled, axis=1)
            logits = hidden @ weights[-2] + weights[-1]
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[here, y] -= 1
            p /= len(rows)
            gradient = [np.zeros_like(w) for w in weights]
            gradient[-2], gradient[-1] = hidden.T @ p, p.sum(0)
            back = p @ weights[-2].T
            for i, w in enumerate(WIDTHS):
                strips, place, above = seen[i]
                g = back[:, i * FILTERS : (i + 1) * FILTERS] * above
                taken = strips[here[:, None], place]  # (rows, FILTERS, width * EMBEDDING)
                gradient[1 + i] = np.einsum("nfd,nf->df", taken, g)
                gradient[1 + k + i] = g.sum(0)
                to_strip = g[:, :, None] * weights[1 + i].T[None]
                for j in range(w):
                    np.add.at(gradient[0], x[here[:, None], place + j], to_strip[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
            step += 1
            pace = rate * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for w, g, a, b in zip(weights, gradient, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= pace * a / (np.sqrt(b) + 1e-7)
    return Network(weights[0], tuple(weights[1 : 1 + k]), tuple(weights[1 + k : 1 + 2 * k]), weights[-2], weights[-1])
