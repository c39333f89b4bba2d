"""Gradient-boosted trees for a yes/no target, on features cut into at most 16 bins."""

from __future__ import annotations

import numpy as np

BINS = 16


def bin_edges(x: np.ndarray) -> np.ndarray:
    """Up to BINS - 1 cut points a feature, from its quantiles."""
    cuts = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    out = np.full((x.shape[1], BINS - 1), np.inf)
    for f, row in enumerate(cuts):
        low, high = x[:, f].min(), x[:, f].max()
        distinct = np.unique(np.append(row, (low + high) / 2) if high > low else row)
        distinct = distinct[(distinct > low) & (distinct <= high)][:BINS - 1]
        out[f, :len(distinct)] = distinct
    return out


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[f], x[:, f], side="right") for f in range(x.shape[1])], axis=1).astype(np.uint8)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3,
        ridge: float = 1.0) -> tuple[np.ndarray, ...]:
    """(edges, feature, cut, leaf): complete trees of Newton steps on the log loss.

    feature and cut are rounds x (2^depth - 1), leaf rounds x 2^depth; a row goes right if its bin is above the cut.
    """
    edges = bin_edges(x)
    b = binned(x, edges).astype(np.int64)
    n, width = b.shape
    margin = np.zeros(n)
    feature = np.zeros((rounds, 2 ** depth - 1), dtype=np.int64)
    cut = np.full((rounds, 2 ** depth - 1), BINS, dtype=np.int64)
    leaf = np.zeros((rounds, 2 ** depth))
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            wide = 2 ** level
            best = np.zeros(wide)
            for f in range(width):
                cell = node * BINS + b[:, f]
                gs = np.bincount(cell, g, wide * BINS).reshape(wide, BINS).cumsum(axis=1)
                hs = np.bincount(cell, h, wide * BINS).reshape(wide, BINS).cumsum(axis=1)
                whole_g, whole_h = gs[:, -1:], hs[:, -1:]
                gain = (gs ** 2 / (hs + ridge) + (whole_g - gs) ** 2 / (whole_h - hs + ridge)
                        - whole_g ** 2 / (whole_h + ridge))
                at = gain.argmax(axis=1)
                top = gain[np.arange(wide), at]
                better = top > best + 1e-9
                places = wide - 1 + np.flatnonzero(better)
                feature[t, places], cut[t, places] = f, at[better]
                best = np.where(better, top, best)
            here = wide - 1 + node
            node = 2 * node + (b[np.arange(n), feature[t, here]] > cut[t, here])
        leaf[t] = -rate * np.bincount(node, g, 2 ** depth) / (np.bincount(node, h, 2 ** depth) + ridge)
        margin += leaf[t][node]
    return edges, feature, cut, leaf


def margins(model: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Log odds of each row."""
    edges, feature, cut, leaf = model
    b = binned(x, edges)
    rows, out = np.arange(len(x)), np.zeros(len(x))
    depth = int(np.log2(leaf.shape[1]))
    for t in range(len(leaf)):
        node = np.zeros(len(x), dtype=np.int64)
        for level in range(depth):
            here = 2 ** level - 1 + node
            node = 2 * node + (b[rows, feature[t, here]] > cut[t, here])
        out += leaf[t][node]
    return out
