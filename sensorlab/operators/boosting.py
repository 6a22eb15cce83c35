"""Second-order boosting over quantile-binned histograms, several models in step.

The growth of trees sees rows only through histograms of (gradient, hessian, rows) per node,
feature and bin, so the same code grows trees from the rows of one task (:class:`TaskRows`)
and from a table of any size whose histograms Spark adds up (``plans.boosters.SparkRows``).

* Bin 0 holds missing values; each split learns the side they go to.
* ``leaves > 0``: best-first growth, the leaf with the largest gain is split next until the
  tree has that many leaves.  Children are evaluated in waves (every leaf that may still be
  split), and the best-first order is replayed over what is known, so a wave saves passes
  without changing the tree.  ``leaves = 0``: every node is split down to ``max_depth``.
* Of two siblings the smaller one is counted, the other is the parent less its sibling.
* ``alpha`` and ``lam`` are the L1 and L2 penalties in gain and leaf value.
* Two classes: one tree a round on the logistic loss.  More: one tree per class and
  round on the softmax loss, all from one pass.

Bagging takes rows by a hash of (row key, seed, round): the same rows wherever they are stored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import asdict, dataclass, field

import numpy as np

U64 = np.uint64
WAVE = 6          # leaves of a best-first tree whose children are counted at once (by a task)
LARGE_NODE = 16_384      # rows from which a task parts and counts a node by itself
GROUP_CELLS = 4_096      # cells of the row counts of a group of features


@dataclass(frozen=True)
class Spec:
    """Parameters of one booster, and the rows that it learns from (fold, share of its order)."""
    rounds: int = 100
    rate: float = 0.1
    max_depth: int = 0            # 0: no limit
    leaves: int = 31              # 0: no limit, depth by depth
    min_rows: int = 20
    min_hessian: float = 1e-3
    alpha: float = 0.0
    lam: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    classes: int = 2
    seed: int = 42
    fold: int = 0
    share: float = 1.0

    @property
    def trees(self) -> int:
        return 1 if self.classes == 2 else self.classes


@dataclass
class Node:
    path: int                     # 1 for the root, 2 p and 2 p + 1 for the children of p
    depth: int
    total: np.ndarray             # gradient, hessian, rows
    hist: np.ndarray | None = None
    gain: float = 0.0
    split: tuple | None = None    # feature, last bin of the left side, missing values go left
    kids: tuple | None = None
    place: tuple | None = None    # where a row holder keeps the rows of the node


@dataclass
class Tree:
    feature: list = field(default_factory=list)       # -1: leaf
    bin: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of binned values."""
        if len(x) >= LARGE_NODE:
            return self._leaf_of_many(x)
        feature, edge, missing, left, right = (np.array(v) for v in (
            self.feature, self.bin, self.missing_left, self.left, self.right))
        at = np.zeros(len(x), np.int64)
        live = np.flatnonzero(feature[at] >= 0)
        while len(live):
            node = at[live]
            value = x[live, feature[node]]
            goes_left = np.where(value == 0, missing[node], value <= edge[node])
            at[live] = np.where(goes_left, left[node], right[node])
            live = live[feature[at[live]] >= 0]
        return at

    def _leaf_of_many(self, x: np.ndarray) -> np.ndarray:
        """``leaf_of`` node by node: faster for many rows."""
        out = np.zeros(len(x), np.int64)
        columns, missing = np.ascontiguousarray(x.T), bool((x == 0).any())
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.feature[node] < 0:
                out[rows] = node
                continue
            left = goes_left(columns[self.feature[node]].take(rows), self.bin[node], self.missing_left[node], missing)
            todo += [(self.left[node], rows[left]), (self.right[node], rows[~left])]
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(x)]


def goes_left(value: np.ndarray, edge: int, missing_left: bool, missing: bool) -> np.ndarray:
    """Whether rows with these bins of one feature go left; ``missing``: there may be bins 0."""
    left = value <= edge
    return left if missing_left or not missing else left & (value > 0)


# ------------------------------------------------------------------ histograms of large nodes
def feature_groups(radix: list[int]) -> list[list[int]]:
    """Features dealt to few groups of at most ``GROUP_CELLS`` cells (the product of their numbers of
    bins), most bins first; the rows of a group are counted at once and summed to each feature's bins."""
    groups: list[list] = []
    for f in sorted(range(len(radix)), key=lambda f: -radix[f]):
        fits = [g for g in groups if g[0] * radix[f] <= GROUP_CELLS]
        if fits:
            fits[0][0] *= radix[f]
            fits[0][1].append(f)
        else:
            groups.append([radix[f], [f]])
    return [g for _, g in groups]


class LargeHistograms:
    """Histograms of many rows of binned columns: the sums of gradient and hessian go through a feature's
    bins together, in the order of the rows, so they are those of ``np.bincount`` to the last bit."""

    def __init__(self, columns: np.ndarray, bins: int):
        self.columns, self.bins = columns, bins
        self.radix = [int(v) + 1 for v in columns.max(axis=1)]
        self.groups, self.codes = feature_groups(self.radix), []
        for group in self.groups:
            code = np.zeros(columns.shape[1], np.uint16)
            for f in group:
                code = code * np.uint16(self.radix[f]) + columns[f]
            self.codes.append(code)

    def __call__(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """(features, bins, 3): gradient, hessian and number of the rows by feature and bin."""
        out = np.zeros((len(self.columns), self.bins, 3))
        both = np.empty(len(rows), complex)
        both.real, both.imag = g.take(rows), h.take(rows)
        for f, column in enumerate(self.columns):
            sums = np.zeros(self.bins, complex)
            np.add.at(sums, column.take(rows).astype(np.intp), both)
            out[f, :, 0], out[f, :, 1] = sums.real, sums.imag
        for group, code in zip(self.groups, self.codes):
            shape = [self.radix[f] for f in group]
            cells = np.bincount(code.take(rows).astype(np.intp), minlength=math.prod(shape)).reshape(shape)
            for a, f in enumerate(group):
                out[f, :self.radix[f], 2] = cells.sum(axis=tuple(b for b in range(len(group)) if b != a))
        return out


# ------------------------------------------------------------------ loss
def start_margins(counts: np.ndarray) -> np.ndarray:
    """Margins of the class shares, one per tree of a round."""
    share = np.clip(counts / max(counts.sum(), 1), 1e-15, 1 - 1e-15)
    return np.array([np.log(share[1] / share[0])]) if len(share) == 2 else np.log(share)


def probabilities(margins: np.ndarray) -> np.ndarray:
    """(classes, rows) from the margins (trees, rows)."""
    if len(margins) == 1:
        p = 1 / (1 + np.exp(-margins[0]))
        return np.stack([1 - p, p])
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def gradients(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by each margin, (trees, rows) each."""
    if len(margins) == 1:
        p = 1 / (1 + np.exp(-margins))
        return p - (y == 1), p * (1 - p)
    p, k = probabilities(margins), len(margins)
    return p - (np.arange(k)[:, None] == y), k / (k - 1) * p * (1 - p)


def bagged(keys: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Whether each row is in the bag of a round."""
    if share >= 1:
        return np.ones(len(keys), bool)
    x = keys.astype(np.int64).view(U64) + U64((seed * 1_000_003 + turn) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return (x ^ (x >> U64(31))) < U64(int(share * 2**64))


# ------------------------------------------------------------------ splits
def _score(g, h, alpha, lam):
    shrunk = np.maximum(np.abs(g) - alpha, 0) if np.any(alpha) else g
    return shrunk * shrunk / (h + lam + 1e-12)


def best_splits(hist: np.ndarray, specs: list[Spec], allowed: np.ndarray):
    """(gain, feature, bin, missing left) of the best split of each histogram (nodes, features,
    bins, 3); gain 0 where there is none.  Equal gains: the first feature, the lowest bin."""
    r, f, b, _ = hist.shape
    alpha, lam, min_rows, min_h = np.array([(s.alpha, s.lam, max(s.min_rows, 1), s.min_hessian) for s in specs],
                                           float).T[:, :, None, None]
    total = hist[:, 0].sum(axis=1)                                   # the same for every feature
    g, h, n = (total[:, k][:, None, None] for k in range(3))
    own = _score(g, h, alpha, lam)
    low = np.cumsum(hist[:, :, 1:b - 1], axis=2)                     # known values up to each bin
    missing = hist[:, :, :1]
    sides = [low]
    if missing[..., 2].any():
        sides.append(low + missing)
    best = None
    for missing_left, side in enumerate(sides):
        gl, hl, nl = side[..., 0], side[..., 1], side[..., 2]
        gr, hr, nr = g - gl, h - hl, n - nl
        gain = _score(gl, hl, alpha, lam) + _score(gr, hr, alpha, lam) - own
        fit = (nl >= min_rows) & (nr >= min_rows) & (hl >= min_h) & (hr >= min_h)
        gain = np.where(fit & allowed[:, :, None], gain, 0.0).reshape(r, -1)
        at = gain.argmax(axis=1)
        value = gain[np.arange(r), at]
        if best is None:
            best = [value, at, np.zeros(r, bool)]
        else:
            better = value > best[0]
            best = [np.where(better, value, best[0]), np.where(better, at, best[1]), better]
    gain, at, left = best
    gain = np.where(gain > 1e-9, gain, 0.0)
    return gain, at // (b - 2), at % (b - 2) + 1, left


# ------------------------------------------------------------------ growth
def _replay(root: Node, spec: Spec, wave: int) -> tuple[list[Node], list[Node]]:
    """Best-first order over the known nodes: (split nodes, those whose children are unknown, at most ``wave``)."""
    heap = [(-root.gain, root.path, root)] if root.gain > 0 else []
    chosen, unknown = [], []
    while heap and (spec.leaves == 0 or len(chosen) + 1 < spec.leaves):
        node = heapq.heappop(heap)[2]
        chosen.append(node)
        if node.kids is None:
            unknown.append(node)
            if spec.leaves and len(unknown) == wave:        # what comes after is less and less certain
                break
            continue
        for kid in node.kids:
            if kid.gain > 0:
                heapq.heappush(heap, (-kid.gain, kid.path, kid))
    return chosen, unknown


def _evaluate(nodes: list[Node], hist: np.ndarray, specs: list[Spec], allowed: np.ndarray):
    # nodes at the depth limit, or with too few rows or too little hessian for two sides, stay leaves
    may = [i for i, (node, spec) in enumerate(zip(nodes, specs))
           if not 0 < spec.max_depth <= node.depth and node.total[2] >= 2 * max(spec.min_rows, 1)
           and node.total[1] >= 2 * spec.min_hessian]
    for node in nodes:
        node.hist = None
    if not may:
        return
    hist, some = (hist, allowed) if len(may) == len(nodes) else (hist[may], allowed[may])
    found = zip(*(v.tolist() for v in best_splits(hist, [specs[i] for i in may], some)))
    for k, (i, (gain, *split)) in enumerate(zip(may, found)):
        if gain > 0:
            nodes[i].gain, nodes[i].split, nodes[i].hist = gain, tuple(split), hist[k]


def _tree(root: Node, chosen: list[Node], spec: Spec) -> tuple[Tree, list[Node]]:
    """The tree of the split nodes, and the node of each of its entries."""
    split, tree, order = {id(n) for n in chosen}, Tree(), []
    todo = [(root, None, None)]
    while todo:
        node, side, parent = todo.pop()
        i = len(order)
        order.append(node)
        if side is not None:
            side[parent] = i
        if id(node) in split:
            feature, edge, missing_left = node.split
            tree.gain.append(node.gain)
            tree.value.append(0.0)
            todo += [(node.kids[0], tree.left, i), (node.kids[1], tree.right, i)]
        else:
            feature, edge, missing_left = -1, 0, False
            g, h, _ = node.total.tolist()
            tree.gain.append(0.0)
            tree.value.append(-math.copysign(max(abs(g) - spec.alpha, 0.0), g) / (h + spec.lam + 1e-12) * spec.rate)
        tree.feature.append(feature)
        tree.bin.append(edge)
        tree.missing_left.append(missing_left)
        tree.left.append(0)
        tree.right.append(0)
    return tree, order


def grow(rows, specs: list[Spec], allowed: np.ndarray) -> list[tuple[Tree, list[Node]]]:
    """One tree per entry of ``specs`` (several entries may be the classes of one model).

    ``rows.roots()`` gives the histograms of all rows of each tree and ``rows.children(wanted)``, for (tree,
    node) pairs, the histogram of one child of each and whether that is the left one.  ``rows.wave`` leaves of
    a best-first tree are counted ahead; it changes no tree."""
    hist = rows.roots()
    roots = [Node(1, 0, h[0].sum(axis=0), h, place=rows.whole(t)) for t, h in enumerate(hist)]
    _evaluate(roots, hist, specs, allowed)
    done: list = [None] * len(roots)
    live = list(range(len(roots)))
    while live:
        wanted, still = [], []
        for t in live:
            chosen, unknown = _replay(roots[t], specs[t], rows.wave)
            if unknown:
                wanted += [(t, n) for n in unknown]
                still.append(t)
            else:
                done[t] = _tree(roots[t], chosen, specs[t])
        live = still
        if not wanted:
            continue
        counted, is_left, places = rows.children(wanted)
        is_left = np.asarray(is_left)
        rest = np.stack([n.hist for _, n in wanted]) - counted
        both = np.empty((len(wanted), 2, *counted.shape[1:]))
        both[is_left, 0], both[is_left, 1] = counted[is_left], rest[is_left]
        both[~is_left, 0], both[~is_left, 1] = rest[~is_left], counted[~is_left]
        totals = both[:, :, 0].sum(axis=2)
        new, owner = [], []
        for i, (t, node) in enumerate(wanted):
            node.kids = tuple(Node(2 * node.path + k, node.depth + 1, totals[i, k], both[i, k], place=places[i][k])
                              for k in range(2))
            node.hist = None
            new += node.kids
            owner += [t, t]
        _evaluate(new, both.reshape(-1, *both.shape[2:]), [specs[t] for t in owner], allowed[owner])
    return done


def allowed_features(spec: Spec, turn: int, k: int, features: int) -> np.ndarray:
    out = np.ones(features, bool)
    if spec.colsample < 1:
        keep = max(1, round(spec.colsample * features))
        out[:] = False
        out[np.random.default_rng([spec.seed, turn, k]).permutation(features)[:keep]] = True
    return out


@dataclass
class Model:
    """A fitted booster: margins of the start and one list of trees a round."""
    spec: Spec
    start: np.ndarray
    rounds: list = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.repeat(self.start[:, None], len(x), axis=1)
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[k] += tree.margin(x)
        return out

    def importance(self, features: int) -> np.ndarray:
        """Share of the total gain by feature."""
        out = np.zeros(features)
        for trees in self.rounds:
            for tree in trees:
                for f, gain in zip(tree.feature, tree.gain):
                    if f >= 0:
                        out[f] += gain
        return out / (out.sum() or 1.0)

    def to_dict(self) -> dict:
        return {"spec": asdict(self.spec), "start": self.start.tolist(),
                "rounds": [[vars(t) for t in trees] for trees in self.rounds]}

    @staticmethod
    def from_dict(d: dict) -> "Model":
        return Model(Spec(**d["spec"]), np.array(d["start"]), [[Tree(**t) for t in trees] for trees in d["rounds"]])


def boost(rows, specs: list[Spec], features: int) -> list[Model]:
    """Fit all models in step: round r grows the trees of every model that has that many rounds."""
    models = [Model(s, start_margins(n)) for s, n in zip(specs, rows.class_counts())]
    rows.start([m.start for m in models])
    for turn in range(max((s.rounds for s in specs), default=0)):
        live = [m for m, s in enumerate(specs) if s.rounds > turn]
        owner = [(m, k) for m in live for k in range(specs[m].trees)]
        rows.begin(turn, owner)
        allowed = np.stack([allowed_features(specs[m], turn, k, features) for m, k in owner])
        grown = grow(rows, [specs[m] for m, _ in owner], allowed)
        for m in live:
            models[m].rounds.append([])
        for (m, _), (tree, _) in zip(owner, grown):
            models[m].rounds[-1].append(tree)
        rows.finish(owner, grown)
    return models


# ------------------------------------------------------------------ rows of one task
class TaskRows:
    """Binned rows held by one task.  Rows a model does not learn from weigh 0 and are only scored."""

    wave = WAVE

    def __init__(self, x, y, share, keys, specs: list[Spec], bins: int):
        self.x, self.y, self.keys, self.specs, self.bins = x, y, keys, specs, bins
        self.n, self.features = x.shape
        self.columns = np.ascontiguousarray(x.T)
        self.values = self.columns.ravel()
        self.large = LargeHistograms(self.columns, bins) if self.n >= LARGE_NODE else None
        self.missing = bool((x == 0).any())
        self.learns = [share < s.share for s in specs]

    def class_counts(self):
        return [np.bincount(self.y[w], minlength=s.classes).astype(float) for s, w in zip(self.specs, self.learns)]

    def start(self, starts):
        self.margins = [np.repeat(s[:, None], self.n, axis=1) for s in starts]

    def begin(self, turn, owner):
        self.g, self.h = np.empty((2, len(owner) * self.n))
        w = []
        for t, (m, k) in enumerate(owner):
            if k == 0:
                bag = self.learns[m] & bagged(self.keys, self.specs[m].seed, turn, self.specs[m].subsample)
                both = gradients(self.margins[m], self.y)
            mine = slice(t * self.n, (t + 1) * self.n)
            self.g[mine], self.h[mine] = both[0][k], both[1][k]
            w.append(bag)
        # histograms read the rows in the bag; the others are scored by the finished tree
        self.used = [np.flatnonzero(bag) for bag in w]
        self.rest = [np.flatnonzero(~bag) for bag in w]
        self.order = np.concatenate(self.used)
        ends = np.cumsum([len(u) for u in self.used])
        self.spans = [(int(e - len(u)), int(e)) for e, u in zip(ends, self.used)]

    def whole(self, t):
        return self.spans[t]

    def _histogram(self, row, t):
        """Histogram of many rows of a tree."""
        mine = slice(t * self.n, (t + 1) * self.n)
        return self.large(row, self.g[mine], self.h[mine])

    def _histograms(self, row, tree, size):
        """Histograms of runs of rows: run i has ``size[i]`` rows of tree ``tree[i]``."""
        runs, bins = len(size), self.bins
        at = row + np.repeat(tree * self.n, size)
        g, h = self.g[at], self.h[at]
        offset = np.repeat(np.arange(runs) * bins, size)
        out = np.empty((runs, self.features, bins, 3))
        for f in range(self.features):
            cell = self.columns[f][row] + offset
            for j, v in enumerate((g, h, None)):
                out[:, f, :, j] = np.bincount(cell, v, runs * bins).reshape(runs, bins)
        return out

    def roots(self):
        out = np.empty((len(self.used), self.features, self.bins, 3))
        small = [t for t, u in enumerate(self.used) if len(u) < LARGE_NODE]
        for t, used in enumerate(self.used):
            if len(used) >= LARGE_NODE:
                out[t] = self._histogram(used, t)
        if small:
            used = [self.used[t] for t in small]
            out[small] = self._histograms(np.concatenate(used), np.array(small), np.array([len(u) for u in used]))
        return out

    def children(self, wanted):
        hists = np.empty((len(wanted), self.features, self.bins, 3))
        is_left, places, small = [True] * len(wanted), [()] * len(wanted), []
        for i, (t, node) in enumerate(wanted):
            if node.place[1] - node.place[0] < LARGE_NODE:
                small.append(i)
            else:
                hists[i], is_left[i], places[i] = self._part_large(t, node)
        if small:
            hists[small], sides, spans = self._part_small([wanted[i] for i in small])
            for i, side, span in zip(small, sides, spans):
                is_left[i], places[i] = side, span
        return hists, is_left, places

    def _part_large(self, t, node):
        """Parts the rows of a large node: (histogram of the smaller side, whether that is the left one, places)."""
        (start, end), (feature, edge, missing_left) = node.place, node.split
        row = self.order[start:end]
        left = goes_left(self.columns[feature].take(row), edge, missing_left, self.missing)
        sides = row[left], row[~left]
        middle = start + len(sides[0])
        self.order[start:middle], self.order[middle:end] = sides
        is_left = len(sides[0]) <= len(sides[1])
        picked = sides[0 if is_left else 1]
        if len(picked) >= LARGE_NODE:
            hist = self._histogram(picked, t)
        else:
            hist = self._histograms(picked, np.array([t]), np.array([len(picked)]))[0]
        return hist, is_left, ((start, middle), (middle, end))

    def _part_small(self, wanted):
        """``_part_large`` of several nodes at once."""
        tree = np.array([t for t, _ in wanted])
        start, end = np.array([n.place for _, n in wanted]).T
        size = end - start
        feature, edge, missing = (np.array(v) for v in zip(*[n.split for _, n in wanted]))
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(start - first, size)
        row = self.order[at]
        value = self.values[row + np.repeat(feature * self.n, size)]
        left = value <= np.repeat(edge, size)
        if self.missing:
            left &= (value > 0) | np.repeat(missing, size)
        # stable partition of every span: the rows of the left sides in order, then those of the right sides
        lefts = np.add.reduceat(left, first, dtype=np.int64)
        to_left = at < np.repeat(start + lefts, size)
        left_rows, right_rows = row[left], row[~left]
        self.order[at[to_left]] = left_rows
        self.order[at[~to_left]] = right_rows
        is_left = 2 * lefts <= size
        rights = size - lefts
        pick_left, pick_right = np.repeat(is_left, lefts), np.repeat(~is_left, rights)
        hists = np.empty((len(wanted), self.features, self.bins, 3))
        hists[is_left] = self._histograms(left_rows[pick_left], tree[is_left], lefts[is_left])
        hists[~is_left] = self._histograms(right_rows[pick_right], tree[~is_left], rights[~is_left])
        places = [((a, m), (m, e)) for a, m, e in zip(start.tolist(), (start + lefts).tolist(), end.tolist())]
        return hists, is_left.tolist(), places

    def finish(self, owner, grown):
        for t, ((m, k), (tree, order)) in enumerate(zip(owner, grown)):
            margin = self.margins[m][k]
            for i, node in enumerate(order):
                if tree.feature[i] < 0:
                    margin[self.order[node.place[0]:node.place[1]]] += tree.value[i]
            if len(self.rest[t]):
                margin[self.rest[t]] += tree.margin(self.x[self.rest[t]])

    def confusions(self, m: int) -> dict[tuple, int]:
        """Rows by (learned from, class, predicted class) of a model."""
        k = self.specs[m].classes
        predicted = probabilities(self.margins[m]).argmax(axis=0)
        cell = (self.learns[m] * k + self.y) * k + predicted
        count = np.bincount(cell, minlength=2 * k * k).reshape(2, k, k)
        return {(a, b, d): int(count[a, b, d]) for a in range(2) for b in range(k) for d in range(k) if count[a, b, d]}
