"""Plain all-pairs versions of the iterative operators, for small inputs only."""

from __future__ import annotations

import numpy as np


def core(x: np.ndarray, k: int) -> np.ndarray:
    return np.sort(dist(x), axis=1)[:, k - 1]


def dist(x: np.ndarray) -> np.ndarray:
    total = np.zeros((len(x), len(x)))
    for d in range(x.shape[1]):
        total += (x[:, d][:, None] - x[:, d][None, :]) ** 2
    return np.sqrt(total)


def tree(x: np.ndarray, k: int) -> list[tuple[float, int, int]]:
    """Kruskal over all pairs in (weight, i, j) order."""
    c = core(x, k)
    w = np.maximum(dist(x), np.maximum(c[:, None], c[None, :]))
    i, j = np.triu_indices(len(x), 1)
    order = np.lexsort((j, i, w[i, j]))
    up = list(range(len(x)))

    def find(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    out = []
    for e in order:
        a, b = find(i[e]), find(j[e])
        if a != b:
            up[b] = a
            out.append((float(w[i[e], j[e]]), int(i[e]), int(j[e])))
    return out


def clusters(x: np.ndarray, k: int, m: int, eps: float) -> np.ndarray:
    """Leaf clusters by walking the binary merge tree from the top."""
    n = len(x)
    edges = tree(x, k)
    kids, size, weight = {}, {v: 1 for v in range(n)}, {}
    top = {v: v for v in range(n)}
    group = {v: [v] for v in range(n)}
    for t, (w, i, j) in enumerate(edges):
        a, b = top[i], top[j]
        node = n + t
        kids[node], size[node], weight[node] = (a, b), size[a] + size[b], w
        group[node] = group.pop(a) + group.pop(b)
        for v in group[node]:
            top[v] = node
    root = n + len(edges) - 1
    parent, birth, below, fell = {}, {}, {"root": []}, {}
    stack = [(root, "root")]
    while stack:
        node, cluster = stack.pop()
        if node < n:
            fell[node] = cluster
            continue
        a, b = kids[node]
        if size[a] >= m and size[b] >= m:
            for c in (a, b):
                parent[c], birth[c], below[c] = cluster, weight[node], []
                below[cluster].append(c)
                stack.append((c, c))
        else:
            stack += [(a, cluster), (b, cluster)]
    selected = set()
    for leaf in [c for c in below if c != "root" and not below[c]]:
        at = leaf
        if birth[leaf] < eps:
            while parent[at] != "root":
                at = parent[at]
                if birth[at] > eps:
                    break
        selected.add(at)
    labels = np.full(n, -1)
    numbers = {}
    for v in range(n):
        at = fell[v]
        while at != "root" and at not in selected:
            at = parent[at]
        if at != "root":
            labels[v] = numbers.setdefault(at, len(numbers))
    return labels


def same_partition(a: np.ndarray, b: np.ndarray) -> bool:
    """Equal up to renumbering, noise fixed."""
    if not np.array_equal(a == -1, b == -1):
        return False
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    return len({p[0] for p in pairs}) == len(pairs) == len({p[1] for p in pairs})


def week_loop(sold: dict[str, set[int]]) -> dict[str, tuple[int, int, tuple[int, int] | None]]:
    """Weekly update of (alpha, beta) and the state at the last sold week, arm by arm."""
    out = {}
    for arm, weeks in sold.items():
        a = b = 1
        last = None
        for w in range(1, 53):
            if w in weeks:
                a += 1
                last = (a, b)
            else:
                b += 1
        out[arm] = (a, b, last)
    return out
