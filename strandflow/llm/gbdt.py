"""Histogram gradient-boosted trees for a binary target, kept as flat arrays.

fit trains in numpy on rows in memory. grown trains on counted rows of codes wherever they
lie: it asks for sums by node, feature and code only, which tasks can add up. A fitted model
is four small arrays, and scoring walks all rows of a batch down all trees at once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    base: float
    feature: np.ndarray  # (trees, inner nodes) in heap order
    threshold: np.ndarray  # (trees, inner nodes); a row goes right if its value is above
    leaf: np.ndarray  # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out

    def first(self, k: int) -> Trees:
        return Trees(self.base, self.feature[:k], self.threshold[:k], self.leaf[:k])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
    return (values[1:] + values[:-1]) / 2


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Trees:
    """x: (rows, features); y: 0 or 1. Without rows, or with one class, a constant model."""
    n, inner = len(y), (1 << depth) - 1
    prior = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(prior / (1 - prior)))
    shape = (trees, inner)
    feature, threshold, leaf = np.zeros(shape, dtype=np.int64), np.full(shape, np.inf), np.zeros((trees, inner + 1))
    if n == 0 or y.min() == y.max():
        return Trees(base, feature[:0], threshold[:0], leaf[:0])
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    codes = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]  # each feature's in one piece of memory
    margin = np.full(n, base)
    for k in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)  # heap position
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            gain, best = np.full(many, 1e-6), [None] * many
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                cell = (node - first) * width + codes[j]
                gs = np.bincount(cell, g, many * width).reshape(many, width).cumsum(axis=1)
                hs = np.bincount(cell, h, many * width).reshape(many, width).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gains = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gains[(hl < least) | (ht - hl < least)] = 0
                at = gains.argmax(axis=1)
                for i in np.nonzero(gains[np.arange(many), at] > gain)[0]:
                    gain[i], best[i] = gains[i, at[i]], (j, e[at[i]])
            for i, found in enumerate(best):
                if found:
                    feature[k, first + i], threshold[k, first + i] = found
            node = 2 * node + 1 + (x[np.arange(n), feature[k][node]] > threshold[k][node])
        place = node - inner
        leaf[k] = -rate * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + l2)
        margin += leaf[k][place]
    return Trees(base, feature, threshold, leaf)


#: Codes that coded() gives, and parts of one to which gradients are rounded: sums of whole numbers do not depend on their order.
CODES, EXACT, STEPS = 96, 16, 4
PARTS = 2.0**24


def coded(x: np.ndarray) -> np.ndarray:
    """Whole numbers as codes: those below EXACT stay, of others STEPS codes share an octave."""
    x = np.maximum(x, 0)
    return np.minimum(np.where(x < EXACT, x, EXACT + np.floor(STEPS * np.log2(np.maximum(x, EXACT) / EXACT))), CODES - 1).astype(np.uint8)


def level_sums(x: np.ndarray, y: np.ndarray, counts: np.ndarray, models: list[Trees], margins: list[np.ndarray], level: int) -> np.ndarray:
    """Sums of gradients and curvatures, in parts of one, by model, node of a level of its last tree, feature and code. counts: (models, rows)."""
    many, rows = 1 << level, np.arange(len(y))
    out = np.zeros((len(models), many, x.shape[1], CODES, 2))
    for m, (model, margin) in enumerate(zip(models, margins)):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * PARTS) * counts[m], np.rint(p * (1 - p) * PARTS) * counts[m]
        node = np.zeros(len(y), dtype=np.int64)
        for i in range(level):
            at = node + (1 << i) - 1
            node = 2 * node + (x[rows, model.feature[-1][at]] > model.threshold[-1][at])
        node *= CODES
        for j in range(x.shape[1]):
            cell = node + x[:, j]
            out[m, :, j, :, 0] = np.bincount(cell, g, many * CODES).reshape(many, CODES)
            out[m, :, j, :, 1] = np.bincount(cell, h, many * CODES).reshape(many, CODES)
    return out


def held_sums(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> Callable[[list[Trees], int], np.ndarray]:
    """level_sums of rows in memory, whose margins are kept from tree to tree."""
    margins: list[np.ndarray] = []
    done = 0

    def sums(models: list[Trees], level: int) -> np.ndarray:
        nonlocal done
        if not margins:
            margins.extend(np.full(len(y), m.base) for m in models)
        while done < len(models[0].leaf) - 1:
            for m, model in enumerate(models):
                one = Trees(0.0, *(a[done : done + 1] for a in (model.feature, model.threshold, model.leaf)))
                margins[m] += one.margin(x)
            done += 1
        return level_sums(x, y, counts, models, margins, level)

    return sums


def grown(sums: Callable[[list[Trees], int], np.ndarray], totals: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, l2: float = 1.0, least: float = 1.0) -> list[Trees]:
    """Models fitted side by side. sums(models, level): level_sums of all rows, the last tree being grown; totals: (models, 2) numbers of rows of both classes."""
    inner, k_models = (1 << depth) - 1, len(totals)
    prior = (totals[:, 1] + 0.5) / (totals.sum(axis=1) + 1.0)
    base = np.log(prior / (1 - prior))
    feature, threshold = np.zeros((k_models, trees, inner), dtype=np.int64), np.full((k_models, trees, inner), np.inf)
    leaf = np.zeros((k_models, trees, inner + 1))
    models = [Trees(float(base[m]), feature[m], threshold[m], leaf[m]) for m in range(k_models)]
    for k in range(trees):
        for level in range(depth):
            every = sums([m.first(k + 1) for m in models], level) / PARTS
            for m in range(k_models):
                g, h = every[m, ..., 0], every[m, ..., 1]
                gs, hs = g.cumsum(axis=-1), h.cumsum(axis=-1)
                gl, hl, gt, ht = gs[..., :-1], hs[..., :-1], gs[..., -1:], hs[..., -1:]
                gains = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gains[(hl < least) | (ht - hl < least)] = 0
                for i, own in enumerate(gains):
                    j, code = divmod(int(own.argmax()), CODES - 1)
                    left, right = (gs[i, 0, -1], hs[i, 0, -1]), (0.0, 0.0)
                    if own[j, code] > 1e-6:
                        last = code  # the cut lies amid the codes that no row has
                        while not h[i, j, last + 1]:
                            last += 1
                        feature[m, k, (1 << level) - 1 + i], threshold[m, k, (1 << level) - 1 + i] = j, (code + last) / 2 + 0.5
                        left, right = (gl[i, j, code], hl[i, j, code]), (gt[i, j, 0] - gl[i, j, code], ht[i, j, 0] - hl[i, j, code])
                    if level == depth - 1:
                        leaf[m, k, 2 * i], leaf[m, k, 2 * i + 1] = (-rate * a / (b + l2) for a, b in (left, right))
    return models
