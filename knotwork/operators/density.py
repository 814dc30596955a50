"""Spanning trees of blocks, and the clusters of a spanning tree, as numpy arrays."""

from __future__ import annotations

import numpy as np

#: Distances below this count as this.
NEAR = 1e-9


def spanning_edges(distance: np.ndarray, one: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of a minimum spanning tree, grown from the first row.

    Rows and columns are the same vertices if ``one``; else every edge is between a row and a column."""
    n, m = distance.shape
    total = n if one else n + m
    if total < 2 or not n or not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    best, source = np.full(total, np.inf), np.zeros(total, np.int64)
    done = np.zeros(total, bool)
    rows, cols, out = (np.zeros(total - 1, np.int64), np.zeros(total - 1, np.int64), np.zeros(total - 1))
    reach = [(slice(0, n), distance)] if one else [(slice(n, total), distance), (slice(0, n), distance.T)]
    at = 0
    for k in range(total):
        done[at] = True
        best[at] = np.inf
        part, d = reach[0] if one or at < n else reach[1]
        row = d[at if one or at < n else at - n]
        nearer = (row < best[part]) & ~done[part]
        best[part][nearer] = row[nearer]
        source[part][nearer] = at
        if k == total - 1:
            break
        at = int(best.argmin())
        a, b = int(source[at]), at
        if not one:
            a, b = (a, b - n) if a < n else (b, a - n)
        rows[k], cols[k], out[k] = a, b, best[at]
    return rows, cols, out


def _linkage(n: int, u: np.ndarray, v: np.ndarray, distance: np.ndarray) -> tuple[list[int], list[int], list[float], list[int]]:
    """(left, right, 1 / distance, size) of the nodes n, n + 1, … made by joining along the edges from the least distance on."""
    root, top, size = list(range(n)), list(range(n)), [1] * n
    left, right, inverse = [], [], []
    order = np.lexsort((v, u, distance))
    for a, b, d in zip(u[order].tolist(), v[order].tolist(), distance[order].tolist()):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        left.append(top[a])
        right.append(top[b])
        inverse.append(1 / max(d, NEAR))
        size.append(size[top[a]] + size[top[b]])
        root[b] = a
        top[a] = len(size) - 1
    return left, right, inverse, size


def condensed_labels(n: int, u: np.ndarray, v: np.ndarray, distance: np.ndarray, least: int = 2) -> np.ndarray:
    """A label for each of n points of a spanning tree, -1 for noise: the most stable clusters of at least ``least`` points.

    Going down from the whole, a split into two parts of at least ``least`` points begins two clusters; otherwise the points of
    the lesser part leave the cluster, which goes on in the other. A cluster's stability is the sum over its points of 1 /
    distance where they leave it, less that where it begins."""
    if n < 2:
        return np.full(n, -1)
    left, right, inverse, size = _linkage(n, u, v, distance)
    parent, begins, stability = [-1], [0.0], [0.0]  # of clusters; 0 is the whole
    of = np.zeros(n, np.int64)  # the cluster that a point leaves last
    todo = [(len(size) - 1, 0)]
    while todo:
        node, cluster = todo.pop()
        if node < n:
            of[node] = cluster  # a single point goes on as a cluster only for least = 1
            continue
        a, b, at = left[node - n], right[node - n], inverse[node - n]
        if size[a] >= least and size[b] >= least:
            stability[cluster] += size[node] * (at - begins[cluster])
            for child in (a, b):
                parent.append(cluster)
                begins.append(at)
                stability.append(0.0)
                todo.append((child, len(parent) - 1))
            continue
        for child in (a, b):
            if size[child] >= least:
                todo.append((child, cluster))
            else:
                stability[cluster] += size[child] * (at - begins[cluster])
                leaving = [child]
                while leaving:
                    x = leaving.pop()
                    if x < n:
                        of[x] = cluster
                    else:
                        leaving += [left[x - n], right[x - n]]
    inside = [0.0] * len(parent)
    taken = [False] * len(parent)
    for c in range(len(parent) - 1, 0, -1):  # children come after their parents
        taken[c] = not inside[c] > stability[c]
        inside[parent[c]] += stability[c] if taken[c] else inside[c]
    label = [-1] * len(parent)
    for c in range(1, len(parent)):
        label[c] = label[parent[c]] if label[parent[c]] >= 0 else c if taken[c] else -1
    return np.array(label)[of]
