"""Hierarchical density clustering of one group of points, in numpy.

Campello, Moulavi, Sander: Density-Based Clustering Based on Hierarchical Density
Estimates (2013).  Core distances, a minimum spanning tree of mutual
reachability, the tree of merges condensed by a least size, and the selection of
the clusters of most excess mass.  Memory grows with the square of the points:
callers bound them.
"""

from __future__ import annotations

import numpy as np


def distances(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    squares = (x * x).sum(axis=1)
    d = squares[:, None] + squares[None, :] - 2 * (x @ x.T)
    np.fill_diagonal(d, 0)
    return np.sqrt(np.maximum(d, 0))


def spanning_tree(d: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Edges (a, b, weight) of a minimum spanning tree of mutual reachability, by weight."""
    n = len(d)
    open_, best, source = np.ones(n, bool), np.full(n, np.inf), np.zeros(n, np.int64)
    edges, at = np.zeros((n - 1, 3)), 0
    for i in range(n - 1):
        open_[at] = False
        reach = np.maximum(np.maximum(d[at], core[at]), core)
        nearer = open_ & (reach < best)
        best[nearer], source[nearer] = reach[nearer], at
        at_next = int(np.argmin(np.where(open_, best, np.inf)))
        edges[i] = source[at_next], at_next, best[at_next]
        at = at_next
    return edges[np.argsort(edges[:, 2], kind="stable")]


def merges(edges: np.ndarray, n: int) -> np.ndarray:
    """(left, right, distance, size) of each merge; merge i makes node n + i."""
    parent, size = np.arange(2 * n - 1), np.concatenate([np.ones(n, np.int64), np.zeros(n - 1, np.int64)])
    out = np.zeros((n - 1, 4))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, b, w) in enumerate(edges):
        a, b = root(int(a)), root(int(b))
        parent[a] = parent[b] = n + i
        size[n + i] = size[a] + size[b]
        out[i] = a, b, w, size[n + i]
    return out


def condensed(tree: np.ndarray, n: int, least: int) -> list[tuple[int, int, float, int]]:
    """(cluster, point or cluster, density, size): what leaves a cluster, and at which density.

    Points are 0 to n - 1; the root is cluster n, and parents come before children.
    """
    out, label, following = [], {2 * n - 2: n}, n + 1
    size = lambda node: 1 if node < n else int(tree[node - n, 3])

    def points(node: int) -> list[int]:
        found, todo = [], [node]
        while todo:
            x = todo.pop()
            if x < n:
                found.append(x)
            else:
                todo += [int(tree[x - n, 1]), int(tree[x - n, 0])]
        return found

    todo = [2 * n - 2]
    while todo:
        node = todo.pop(0)
        own, (left, right, w, _) = label[node], tree[node - n]
        density = 1 / w if w > 0 else np.inf
        large = [int(c) for c in (left, right) if size(int(c)) >= least]
        for child in (int(left), int(right)):
            if child not in large:
                out += [(own, p, density, 1) for p in points(child)]
            elif len(large) == 2:
                label[child] = following
                out.append((own, following, density, size(child)))
                following += 1
            else:
                label[child] = own
            if child in large and child >= n:
                todo.append(child)
            elif child in large:
                out.append((label[child], child, density, 1))
    return out


def _selected(rows: list[tuple[int, int, float, int]], n: int, epsilon: float) -> set[int]:
    """Clusters of most excess mass; never the root."""
    birth, children, stability = {n: 0.0}, {}, {}
    for parent, child, density, _ in rows:
        if child >= n:
            birth[child] = density
            children.setdefault(parent, []).append(child)
    for parent, _, density, size in rows:
        gained = (density - birth[parent]) * size if density != birth[parent] else 0.0
        stability[parent] = stability.get(parent, 0.0) + gained
    chosen: set[int] = set()

    def below(c: int) -> list[int]:
        found, todo = [], list(children.get(c, ()))
        while todo:
            x = todo.pop()
            found.append(x)
            todo += children.get(x, ())
        return found

    for c in sorted(birth, reverse=True):
        if c == n:
            continue
        rest = sum(stability.get(x, 0.0) for x in children.get(c, ()))
        if children.get(c) and rest > stability.get(c, 0.0):
            stability[c] = rest
        else:
            chosen -= set(below(c))
            chosen.add(c)
    if epsilon > 0:  # clusters that split nearer than epsilon go back to what they split from
        up = {x: c for c, xs in children.items() for x in xs}
        merged = set()
        for c in chosen:
            while up[c] != n and birth[c] > 1 / epsilon:
                c = up[c]
            merged.add(c)
        chosen = merged - {x for c in merged for x in below(c)}
    return chosen


def hdbscan(x: np.ndarray, min_cluster_size: int, min_samples: int | None = None, epsilon: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(labels, probabilities): clusters from 0, noise -1 with probability 0.

    The core distance is that to the min_samples-th neighbour, the point itself
    not counted.  Fewer points than a cluster needs are all noise.
    """
    n = len(x)
    labels, probs = np.full(n, -1, np.int64), np.zeros(n)
    least = max(2, min_cluster_size)
    if n < max(2, least):
        return labels, probs
    d = distances(x)
    k = min(n - 1, min_samples if min_samples is not None else min_cluster_size)
    core = np.partition(d, k, axis=1)[:, k]
    rows = condensed(merges(spanning_tree(d, core), n), n, least)
    chosen = sorted(_selected(rows, n, epsilon))
    number = {c: i for i, c in enumerate(chosen)}
    home, top = {n: None}, {}
    for parent, child, density, _ in rows:  # parents come first
        if child >= n:
            home[child] = child if child in number else home[parent]
        top[parent] = max(top.get(parent, 0.0), density)
    for parent, child, density, _ in rows:
        if child < n and (own := parent if parent in number else home[parent]) is not None:
            labels[child] = number[own]
            most = top[own]
            probs[child] = 1.0 if not 0 < most < np.inf else min(density, most) / most
    return labels, probs
