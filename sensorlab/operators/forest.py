"""Random forest over quantile-binned rows: bootstrap, feature subsets, Gini splits.

A node's bootstrap counts, its features and its best split depend on the seed, the tree, the
node's path and the rows alone, so a tree comes out the same whether a node is split from
histograms that Spark adds up or from the rows of one task (``plans.forests``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U64 = np.uint64
CELLS = 1 << 21           # histogram cells that are held at once
# P(count <= k) of a Poisson(1) count, the bootstrap of a large table
POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.r_[1.0, np.arange(1, 18)]))


@dataclass(frozen=True)
class Spec:
    trees: int = 100
    max_depth: int = 30
    subset: int = 4           # features tried at a node
    classes: int = 2
    bins: int = 33            # bin 0 holds missing values
    seed: int = 42


@dataclass
class Tree:
    """Nodes level by level: children of a split node are next to each other."""
    feature: np.ndarray       # -1: leaf
    edge: np.ndarray          # last bin of the left side
    left: np.ndarray          # index of the left child
    counts: np.ndarray        # rows of each class (bootstrap counts)
    gains: np.ndarray         # summed gain of each feature

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while len(live):
            live = live[self.feature[at[live]] >= 0]
            node = at[live]
            at[live] = self.left[node] + (x[live, self.feature[node]] > self.edge[node])
        return at


def leaf(counts: np.ndarray, features: int) -> Tree:
    return Tree(np.array([-1], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), counts[None], np.zeros(features))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _salt(seed: int, tree: int) -> np.uint64:
    return U64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))


def bootstrap(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    u = (mixed(mixed(keys.astype(np.int64).view(U64)) + _salt(seed, tree)) >> U64(11)) * 2.0**-53
    return np.searchsorted(POISSON, u, side="right").astype(np.uint8)


def node_features(paths: np.ndarray, spec: Spec, tree: int, features: int) -> np.ndarray:
    """The features tried at each node, ascending (nodes, subset)."""
    at = mixed(paths.astype(np.int64).view(U64) + _salt(spec.seed + 1, tree))[:, None]
    drawn = mixed(at + (np.arange(features).astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    return np.sort(np.argsort(drawn, axis=1, kind="stable")[:, :min(spec.subset, features)], axis=1)


def _purity(counts: np.ndarray) -> np.ndarray:
    """Sum of squared class counts over the node's count, by entry (..., classes)."""
    total = np.zeros(counts.shape[:-1])
    squares = np.zeros(counts.shape[:-1])
    for k in range(counts.shape[-1]):
        total += counts[..., k]
        squares += counts[..., k] ** 2
    return squares / np.maximum(total, 1)


def best_splits(hist: np.ndarray, tried: np.ndarray):
    """(gain, feature, edge) of the best split of each node from counts (nodes, tried, bins, classes); gain 0
    where there is none.  The gain is the decrease of Gini impurity times the node's count.  Equal gains:
    the first feature, the lowest edge."""
    nodes, _, bins, _ = hist.shape
    low = np.cumsum(hist, axis=2)
    total = low[:, :, -1:]
    low = low[:, :, :-1]
    high = total - low
    gain = _purity(low) + _purity(high) - _purity(total)
    valid = (low.sum(axis=3) > 0) & (high.sum(axis=3) > 0)
    gain = np.where(valid, gain, 0.0).reshape(nodes, -1)
    at = gain.argmax(axis=1)
    best = gain[np.arange(nodes), at]
    weight = total[:, 0, 0].sum(axis=1)
    return np.where(best > 1e-12 * weight, best, 0.0), tried[np.arange(nodes), at // (bins - 1)], at % (bins - 1)


def may_split(counts: np.ndarray) -> np.ndarray:
    """Nodes with rows of more than one class."""
    return (counts > 0).sum(axis=1) > 1


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, spec: Spec, tree: int, path: int = 1) -> Tree:
    """The part of a tree below a node, from the node's rows; level by level, all nodes of a level at once."""
    n, features = x.shape
    flat = np.ascontiguousarray(x.T).ravel()
    k, bins = spec.classes, spec.bins
    y, w = y.astype(np.int64), w.astype(float)
    depth = path.bit_length() - 1
    rows, size, paths = np.arange(n), np.array([n]), np.array([path], np.int64)
    out: list[tuple] = []
    gains, first = np.zeros(features), 0
    while len(size):
        node = np.repeat(np.arange(len(size)), size)
        counts = np.bincount(node * k + y[rows], w[rows], len(size) * k).reshape(-1, k)
        feature, edge = np.full(len(size), -1), np.zeros(len(size), np.int64)
        if depth < spec.max_depth:
            # leaves leave: their rows are not read again
            live = np.flatnonzero(may_split(counts))
            number = np.full(len(size), -1)
            number[live] = np.arange(len(live))
            rows = rows[number[node] >= 0]
            size = size[live]
            tried = node_features(paths[live], spec, tree, features)
            ends = np.r_[0, np.cumsum(size)]
            step = max(1, CELLS // (tried.shape[1] * bins * k)) if len(live) else 1
            for a in range(0, len(live), step):
                b = min(a + step, len(live))
                part = rows[ends[a]:ends[b]]
                of = np.repeat(np.arange(b - a), size[a:b])
                label, weight = y[part], w[part]
                hist = np.empty((b - a, tried.shape[1], bins, k))
                for j in range(tried.shape[1]):
                    value = flat[tried[a:b, j][of] * n + part]
                    cell = (of * bins + value) * k + label
                    hist[:, j] = np.bincount(cell, weight, (b - a) * bins * k).reshape(b - a, bins, k)
                gain, f, e = best_splits(hist, tried[a:b])
                split = gain > 0
                feature[live[a:b]], edge[live[a:b]] = np.where(split, f, -1), e
                gains += np.bincount(f[split], gain[split], features)
        split = feature >= 0
        left = np.zeros(len(split), np.int64)
        left[split] = first + len(split) + 2 * np.arange(split.sum())
        out.append((feature, edge, left, counts))
        first += len(split)
        if not split.any():
            break
        of = np.repeat(live, size)
        keep = split[of]
        rows, of = rows[keep], of[keep]
        right = flat[feature[of] * n + rows] > edge[of]
        child = 2 * (np.cumsum(split) - 1)[of] + right
        # stable partition of every node's rows
        size = np.bincount(child, minlength=2 * int(split.sum()))
        rights = np.cumsum(right)
        lefts = np.arange(1, len(rows) + 1) - rights
        start = np.r_[0, np.cumsum(size)[:-1]]
        seen = np.r_[0, np.cumsum(size[0::2])[:-1]], np.r_[0, np.cumsum(size[1::2])[:-1]]
        pair = child >> 1
        place = np.where(right, start[child] + rights - 1 - seen[1][pair], start[child] + lefts - 1 - seen[0][pair])
        moved = np.empty_like(rows)
        moved[place] = rows
        rows = moved
        paths = np.stack([2 * paths[split], 2 * paths[split] + 1], axis=1).ravel()
        depth += 1
    feature, edge, left, counts = (np.concatenate(p) for p in zip(*out))
    return Tree(feature.astype(np.int16), edge.astype(np.uint8), left.astype(np.int32), counts, gains)
