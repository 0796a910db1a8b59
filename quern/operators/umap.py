"""Neighbour embedding of one group of points, in numpy, and the SVD before it.

McInnes, Healy, Melville: UMAP (2018): cosine neighbours, smoothed distances, the
fuzzy union, a spectral start and stochastic descent.  Coordinates depend on the
seed alone.  Memory grows with the square of the points: callers bound them.
"""

from __future__ import annotations

import numpy as np


def gram(indptr: np.ndarray, index: np.ndarray, value: np.ndarray, features: int, block: int = 4096) -> np.ndarray:
    """Inner products of sparse rows, by dense blocks of their features."""
    n = len(indptr) - 1
    row = np.repeat(np.arange(n), np.diff(indptr))
    order = np.argsort(index, kind="stable")
    row, index, value = row[order], index[order], value[order]
    out = np.zeros((n, n))
    for start in range(0, features, block):
        a, b = np.searchsorted(index, (start, start + block))
        part = np.zeros((n, min(block, features - start)), np.float32)
        part[row[a:b], index[a:b] - start] = value[a:b]
        out += part @ part.T
    return out


def svd(inner: np.ndarray, k: int) -> np.ndarray:
    """Left singular vectors times singular values, from the inner products of the rows."""
    value, vector = np.linalg.eigh(inner)
    order = np.argsort(value)[::-1][:k]
    out = vector[:, order] * np.sqrt(np.maximum(value[order], 0))
    return out * np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] < 0, -1, 1)


def _graph(inner: np.ndarray, k: int) -> np.ndarray:
    """Fuzzy memberships of neighbours by cosine distance, symmetric."""
    n, norm = len(inner), np.sqrt(np.maximum(np.diag(inner), 1e-12))
    d = np.maximum(1 - inner / norm[:, None] / norm[None, :], 0)
    np.fill_diagonal(d, -1)
    near = np.argsort(d, axis=1, kind="stable")[:, 1 : k + 1]
    own = np.take_along_axis(d, near, axis=1)
    positive = np.where(own > 0, own, np.inf).min(axis=1)
    rho = np.where(np.isfinite(positive), positive, 0.0)
    low, high, sigma = np.zeros(n), np.full(n, np.inf), np.ones(n)
    for _ in range(64):  # the sum of memberships is to be log2 of k
        total = np.exp(-np.maximum(own - rho[:, None], 0) / sigma[:, None]).sum(axis=1)
        over = total > np.log2(k)
        high, low = np.where(over, sigma, high), np.where(over, low, sigma)
        sigma = np.where(np.isinf(high), sigma * 2, (low + high) / 2)
    sigma = np.maximum(sigma, 1e-3 * np.maximum(own.mean(axis=1), 1e-6))
    weights = np.zeros((n, n))
    np.put_along_axis(weights, near, np.exp(-np.maximum(own - rho[:, None], 0) / sigma[:, None]), axis=1)
    return weights + weights.T - weights * weights.T


def _curve(min_dist: float) -> tuple[float, float]:
    """a, b of 1 / (1 + a x^2b) nearest to the wanted fall-off, by damped Gauss-Newton steps."""
    x = np.linspace(1e-3, 3, 300)
    want = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist)))
    p, damp = np.array([1.5, 0.9]), 1e-2
    error = lambda q: 1 / (1 + q[0] * x ** (2 * q[1])) - want
    for _ in range(200):
        f = error(p)
        y = 1 / (1 + p[0] * x ** (2 * p[1])) ** 2
        jac = np.stack([-y * x ** (2 * p[1]), -y * p[0] * x ** (2 * p[1]) * 2 * np.log(x)], axis=1)
        step = np.linalg.solve(jac.T @ jac + damp * np.eye(2), -jac.T @ f)
        if (error(p + step) ** 2).sum() < (f**2).sum():
            p, damp = p + step, damp / 2
        else:
            damp *= 4
    return float(p[0]), float(p[1])


def _start(graph: np.ndarray, dim: int, rng: np.random.Generator) -> np.ndarray:
    """The leading eigenvectors of the normalised graph after the first, by subspace iteration."""
    n = len(graph)
    scale = 1 / np.sqrt(np.maximum(graph.sum(axis=1), 1e-12))
    q = rng.normal(size=(n, dim + 1))
    for _ in range(60):
        q, _ = np.linalg.qr(q + scale[:, None] * (graph @ (scale[:, None] * q)))
    small = q.T @ (scale[:, None] * (graph @ (scale[:, None] * q)))
    value, vector = np.linalg.eigh((small + small.T) / 2)
    out = (q @ vector[:, np.argsort(value)[::-1]])[:, 1:]
    return out * (10 / max(np.abs(out).max(), 1e-9)) + rng.normal(scale=1e-4, size=out.shape)


def umap(inner: np.ndarray, neighbors: int, dim: int, min_dist: float = 0.1, seed: int = 42, epochs: int | None = None, negatives: int = 5) -> np.ndarray:
    """Coordinates (float32) of rows with these inner products."""
    n, rng = len(inner), np.random.default_rng(seed)
    if n <= dim + 2:
        return np.pad(svd(inner, dim), ((0, 0), (0, max(0, dim - n)))).astype(np.float32)
    graph = _graph(inner, max(2, min(neighbors, n - 1)))
    a, b = _curve(min_dist)
    epochs = epochs or 300
    head, tail = np.nonzero(graph > graph.max() / epochs)
    rate = graph[head, tail] / graph.max()
    y = _start(graph, dim, rng)
    due = np.zeros(len(head))
    for epoch in range(epochs):
        due += rate
        now = np.flatnonzero(due >= 1)
        due[now] -= 1
        i, j = head[now], tail[now]
        alpha = 1 - epoch / epochs
        step = y[i] - y[j]
        square = (step * step).sum(axis=1)
        pull = np.where(square > 0, -2 * a * b * np.maximum(square, 1e-12) ** (b - 1) / (1 + a * square**b), 0)
        move = np.clip(pull[:, None] * step, -4, 4) * alpha
        change = np.stack([np.bincount(i, move[:, c], n) - np.bincount(j, move[:, c], n) for c in range(dim)], axis=1)
        i, k = np.repeat(i, negatives), rng.integers(0, n, len(i) * negatives)
        step = y[i] - y[k]
        square = (step * step).sum(axis=1)
        push = np.where(i != k, 2 * b / ((0.001 + square) * (1 + a * square**b)), 0)
        move = np.clip(push[:, None] * step, -4, 4) * alpha
        change += np.stack([np.bincount(i, move[:, c], n) for c in range(dim)], axis=1)
        count = np.maximum(np.bincount(head[now], minlength=n), 1)
        y = y + change / np.sqrt(count)[:, None] / 2
    return y.astype(np.float32)
