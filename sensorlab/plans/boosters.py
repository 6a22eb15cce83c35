"""Boosters of :mod:`sensorlab.operators.boosting` over Spark tables.

Rows are binned once into blocks of packed bytes (one byte a value), written to the shared
folder with their fold, class, key and place in the fold's order.  ``train`` fits any number
of models over them:

* ``SparkRows``: all models in step.  Each wave of nodes is one Spark job: tasks route their
  records (joined blocks) to the smaller children of the wave's nodes and add up histograms keyed
  by (model, node); the sums come to the driver (models x nodes x features x bins numbers,
  whatever the rows; small ones of each task without a shuffle).  The margins of all models travel
  with the records; a round's trees are added to them in the first job of the next round, and every
  ``WRITTEN_ROUNDS`` rounds the records are written.  Blocks that nothing is learned from are scored
  when all trees are grown.
* Folds of at most ``TASK_ROWS`` rows need no job per wave: the models of a fold are dealt to
  tasks that hold the fold's blocks and grow the same trees there (the test compares both).
* Larger folds whose records fit ``TASK_BYTES`` go to tasks too (``TaskRecords``, one model at a time)
  if there are enough models to keep a good part of the cores busy.

Cut points are quantiles; with weights they come from summaries that are merged on the way.
"""

from __future__ import annotations

import json
import math
import operator
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model as MLModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.operators import boosting as bo
from sensorlab.session import checkpoint_dir, cut_lineage, ship_package

c = F.col

BINS = 64                  # bin 0 holds missing values
BLOCK_ROWS = 65_536
TASK_ROWS = 1_000_000      # rows of a fold that one task may hold (about 250 bytes a row while it grows trees)
TASK_BYTES = 384 << 20     # larger folds of which one task may hold the records while it fits one model
JOBS_COST = 8              # core seconds of the jobs over a table for one core second of such a task, about
SKETCH = 16                # points of a summary per bin
PART_ROWS = 4_000_000      # rows of a task when all tasks work on one table
WRITTEN_ROUNDS = 8         # rounds whose margins are kept by Spark's cache before they are written
JOINED_ROWS = 262_144      # rows of a record of ``SparkRows``, fewer if their margins take more than ``MARGIN_BYTES``
MARGIN_BYTES = 32 << 20
TREES_AT_ONCE = 4_096      # trees that are sent to score the rows that nothing is learned from
DIRECT_BYTES = 64 << 20    # histograms of all tasks that may come to the driver without being added up first
NEVER = math.inf           # place of a row that is only scored
BLOCKS = "fold int, rows long, x binary, y binary, share binary, keys binary"


# ------------------------------------------------------------------ cut points
def quantile_cuts(df: DataFrame, column: str, features: int, bins: int = BINS) -> list[list[float]]:
    """Ascending cut points of each entry of an array column, from one aggregation."""
    at = [i / (bins - 1) for i in range(1, bins - 1)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(c(column)[f]), c(column)[f]), at, 20_000).alias(str(f))
                   for f in range(features)]).first()
    return [sorted(set(row[f] or [])) for f in range(features)]


def summary(values: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """At most about ``size`` points that stand for weighted values: each one carries the weight of
    the values since the point before it, so merged summaries stay summaries."""
    order = np.argsort(values, kind="stable")
    values, total = values[order], np.cumsum(weights[order])
    if not len(values):
        return values, total
    step = total[-1] / size
    last = np.r_[values[1:] != values[:-1], True]                 # the last of equal values
    values, total = values[last], total[last]
    cell = np.ceil(total / step - 1e-9) if step else np.arange(len(total))
    keep = np.r_[cell[1:] != cell[:-1], True]
    return values[keep], np.diff(np.r_[0.0, total[keep]])


def _sketch(size: int):
    def run(batches):
        held: dict[int, list] = {}
        part = None
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, -1)
            w = batch.column(1).to_numpy()
            for f in range(x.shape[1]):
                known = ~np.isnan(x[:, f])
                new = (x[known, f], w[known])
                old = held.get(f)
                held[f] = summary(*(np.concatenate(p) for p in zip(old, new)) if old else new, size)
        if held:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            f = np.repeat(list(held), [len(v) for v, _ in held.values()])
            v, w = (np.concatenate([s[k] for s in held.values()]) for k in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), part), pa.int32()), pa.array(f, pa.int32()),
                                              pa.array(v), pa.array(w)], names=["part", "feature", "v", "w"])
    return run


def weighted_cuts(df: DataFrame, column: str, weight, features: int, bins: int = BINS) -> list[list[float]]:
    """Cut points at equal shares of the weight: one summary per task and feature, merged in
    groups of 64 tasks until one is left."""
    ship_package(df.sparkSession)
    size = SKETCH * bins

    def merge(table: pa.Table) -> pa.Table:
        v, w = summary(table["v"].to_numpy(), table["w"].to_numpy(), size)
        return pa.table({"part": pa.array(np.full(len(v), table["part"][0].as_py() // 64), pa.int32()),
                         "feature": pa.array(np.full(len(v), table["feature"][0].as_py()), pa.int32()), "v": v, "w": w})

    schema = "part int, feature int, v double, w double"
    parts = cut_lineage(df.select(c(column), weight.cast("double").alias("_w")).mapInArrow(_sketch(size), schema))
    top = parts.agg(F.max("part")).first()[0] or 0
    while True:
        parts = parts.withColumn("group", F.floor(c("part") / 64)).groupBy("group", "feature").applyInArrow(
            lambda t: merge(t.drop_columns("group")), schema)
        top //= 64
        if top == 0:
            break
    points: dict[int, list] = {f: [] for f in range(features)}
    for r in parts.orderBy("feature", "v").collect():               # at most features * size rows
        points[r["feature"]].append((r["v"], r["w"]))
    cuts = []
    for f in range(features):
        v, w = (np.array([p[k] for p in points[f]]) for k in range(2))
        total = np.cumsum(w)
        at = total[-1] * np.arange(1, bins - 1) / (bins - 1) if len(w) else []
        cuts.append(sorted({float(v[i]) for i in np.searchsorted(total, np.asarray(at) * (1 - 1e-12))}))
    return cuts


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bins of raw values (rows, features): 0 if missing, else 1 + the cut points below the value."""
    out = np.empty(values.shape, np.uint8)
    for f, edges in enumerate(cuts):
        out[:, f] = np.where(np.isnan(values[:, f]), 0, 1 + np.searchsorted(np.array(edges, float), values[:, f]))
    return out


def pack(df: DataFrame, cuts: list[list[float]], fold: int = 0, share=None) -> DataFrame:
    """Blocks of the rows (features array, code int, key long); ``share`` is a row's place in [0, 1) in
    its fold's order, ``NEVER`` for rows that are only scored."""
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                values = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(cuts))
                arrays = [binned(values.astype(float), cuts), *(part.column(k).to_numpy(zero_copy_only=False).astype(t)
                                                                 for k, t in ((1, np.int16), (2, float), (3, np.int64)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fold], pa.int32()), pa.array([part.num_rows], pa.int64()),
                     *[pa.array([a.tobytes()], pa.binary()) for a in arrays]],
                    names=["fold", "rows", "x", "y", "share", "keys"])

    share = F.lit(0.0) if share is None else share
    return df.select("features", c("code").cast("int"), share.cast("double").alias("_share"),
                     c("key").cast("long").alias("_key")).mapInArrow(run, BLOCKS)


def _unpacked(x, y, share, keys, features: int):
    return (np.frombuffer(x, np.uint8).reshape(-1, features), np.frombuffer(y, np.int16).astype(np.int64),
            np.frombuffer(share, float), np.frombuffer(keys, np.int64))


# ------------------------------------------------------------------ rows of a Spark table
def _joined(most_rows: int, features: int, keys: bool):
    """Records of at most about ``most_rows`` rows of a fold from its blocks: codes of the bins of groups of
    features, class, share (one number if it is the same for all), key (if ``keys``) and no margins yet."""
    def record(fold, parts):
        x, y, share, key = (np.concatenate(p) for p in zip(*parts))
        radix = [int(v) + 1 for v in x.max(axis=0)]
        groups, codes = bo.feature_groups(radix), []
        for group in groups:
            code = np.zeros(len(y), np.uint16)
            for f in group:
                code = code * np.uint16(radix[f]) + x[:, f]
            codes.append(code)
        same = share.min() == share.max()
        return {"fold": fold, "missing": bool((x == 0).any()), "codes": codes,
                "groups": [(tuple(group), tuple(radix[f] for f in group)) for group in groups],
                "y": y.astype(np.int8 if y.max() < 128 else np.int16), "share": float(share[0]) if same else share,
                "keys": key if keys else None, "margins": None}

    def run(rows):
        held, n, of = [], 0, None
        for r in rows:
            if not r["rows"]:
                continue
            part = _unpacked(r["x"], r["y"], r["share"], r["keys"], features)
            kind = (r["fold"], bool(np.isinf(part[2]).all()))            # rows that are only scored stay apart
            if held and (kind != of or n + len(part[1]) > most_rows):
                yield record(of[0], held)
                held, n = [], 0
            held.append(part)
            n, of = n + len(part[1]), kind
        if held:
            yield record(of[0], held)
    return run


@lru_cache(4096)
def _bin_of(shape: tuple, a: int) -> np.ndarray:
    """The bin of the feature at place ``a`` of a group for each code of the group."""
    return (np.arange(math.prod(shape)) // math.prod(shape[a + 1:]) % shape[a]).astype(np.uint8)


class _Sides:
    """Which rows of a record go left at a split, looked up by the code of the feature's group."""

    def __init__(self, record):
        self.missing = record["missing"]
        self.place = {f: (code, shape, a) for (group, shape), code in zip(record["groups"], record["codes"])
                      for a, f in enumerate(group)}

    def __call__(self, rows, f: int, edge: int, missing_left: bool) -> np.ndarray:
        code, shape, a = self.place[f]
        left = bo.goes_left(_bin_of(shape, a), edge, missing_left, self.missing)
        return left.take(code if rows is None else code.take(rows))


def _reached(sides: _Sides, rows, splits: dict[int, tuple], asked: dict[int, int]):
    """(request, its rows) for the asked paths, from those rows of a record that are in the tree (None: all);
    only the nodes above the asked ones are parted."""
    above = set()
    for path in asked:
        while path > 1 and path >> 1 not in above:
            path >>= 1
            above.add(path)
    todo = [(1, rows)]
    while todo:
        path, rows = todo.pop()
        if path in asked:
            yield asked[path], rows
        if path not in above:
            continue
        left = sides(rows, *splits[path])
        for kid in (2 * path, 2 * path + 1):
            if kid in above or kid in asked:
                side = ~left if kid & 1 else left
                todo.append((kid, np.flatnonzero(side) if rows is None else rows[side]))


def _histogram(record, rows, g: np.ndarray, h: np.ndarray, features: int, bins: int) -> np.ndarray:
    """(features, bins, 3): gradient, hessian (both of the given rows) and number of the rows (None: all)."""
    out = np.zeros((features, bins, 3))
    for (group, shape), code in zip(record["groups"], record["codes"]):
        cell = (code if rows is None else code.take(rows)).astype(np.intp)
        for j, w in enumerate((g, h, None)):
            if len(g) < bo.GROUP_CELLS:
                for a, f in enumerate(group):
                    out[f, :, j] = np.bincount(_bin_of(shape, a).take(cell), w, bins)
                continue
            cells = np.bincount(cell, w, math.prod(shape)).reshape(shape)     # features of a group are summed at once
            for a, f in enumerate(group):
                out[f, :shape[a], j] = cells.sum(axis=tuple(b for b in range(len(group)) if b != a))
    return out


def _add_leaves(sides: _Sides, tree: bo.Tree, margin: np.ndarray) -> None:
    """Adds the value of each row's leaf to its margin."""
    todo = [(0, None)]
    while todo:
        node, rows = todo.pop()
        if tree.feature[node] < 0:
            margin[slice(None) if rows is None else rows] += tree.value[node]
            continue
        left = sides(rows, tree.feature[node], tree.bin[node], tree.missing_left[node])
        for kid, side in ((tree.left[node], left), (tree.right[node], ~left)):
            kept = np.flatnonzero(side) if rows is None else rows[side]
            if len(kept):
                todo.append((kid, kept))


def _bag(record, spec: bo.Spec, turn: int):
    """Rows of a record that a model learns from in a round (None: all)."""
    mine = record["share"] < spec.share
    if spec.subsample < 1:
        mine = mine & bo.bagged(record["keys"], spec.seed, turn, spec.subsample)
    if np.all(mine):
        return None
    return np.flatnonzero(np.broadcast_to(mine, len(record["y"])))


def _class_counts(record, spec: bo.Spec) -> np.ndarray:
    """Rows of each class that a model learns from."""
    learned = record["y"][np.broadcast_to(record["share"] < spec.share, len(record["y"]))]
    return np.bincount(learned, minlength=spec.classes)


def _confusion(record, spec: bo.Spec, margin: np.ndarray) -> np.ndarray:
    """Rows by (learned from, class, predicted class)."""
    learned = np.broadcast_to(record["share"] < spec.share, len(record["y"]))
    cell = (learned * spec.classes + record["y"]) * spec.classes + bo.probabilities(margin).argmax(axis=0)
    return np.bincount(cell, minlength=2 * spec.classes ** 2).reshape(2, spec.classes, -1)


def _left_is_smaller(node: bo.Node) -> bool:
    """Whether the left side of a node's split has no more rows than the right one."""
    f, edge, missing_left = node.split
    rows = node.hist[f, :, 2]
    return bool(2 * (rows[1:edge + 1].sum() + (rows[0] if missing_left else 0)) <= rows.sum())


class TaskRecords:
    """Row holder of ``boosting.boost`` for one model over the records of a fold held by one task: what a round
    needs besides the margins are the probabilities and the numbers of the rows, so many rows fit."""

    wave = bo.WAVE

    def __init__(self, records: list[dict], spec: bo.Spec, features: int, bins: int):
        self.records, self.spec, self.features, self.bins = records, spec, features, bins
        self.sides = [_Sides(r) for r in records]

    def class_counts(self):
        return [sum((_class_counts(r, self.spec) for r in self.records), np.zeros(self.spec.classes))]

    def start(self, starts):
        self.margins = [np.repeat(starts[0][:, None], len(r["y"]), axis=1) for r in self.records]

    def begin(self, turn, owner):
        self.p, self.rows = [], []                         # by record; rows: by tree, those of each path
        for r, margin in zip(self.records, self.margins):
            used = _bag(r, self.spec, turn)
            empty = used is not None and not len(used)
            self.p.append(None if empty else bo.probabilities(margin)[-self.spec.trees:])
            self.rows.append([{} if empty else {1: None if used is None else used.astype(np.int32)} for _ in owner])

    def whole(self, t):
        return 1

    def _histogram(self, i, t, rows):
        """Histogram of some rows of a record (None: all)."""
        p, y, k = self.p[i][t], self.records[i]["y"], self.spec.classes
        if rows is not None:
            p, y = p.take(rows), y.take(rows)
        g, h = (p - (y == 1), p * (1 - p)) if k == 2 else (p - (y == t), k / (k - 1) * p * (1 - p))
        return _histogram(self.records[i], rows, g, h, self.features, self.bins)

    def roots(self):
        out = np.zeros((self.spec.trees, self.features, self.bins, 3))
        for i, trees in enumerate(self.rows):
            for t, held in enumerate(trees):
                if 1 in held:
                    out[t] += self._histogram(i, t, held[1])
        return out

    def children(self, wanted):
        out = np.zeros((len(wanted), self.features, self.bins, 3))
        is_left = [_left_is_smaller(node) for _, node in wanted]
        for i, trees in enumerate(self.rows):
            for j, (t, node) in enumerate(wanted):
                if node.path not in trees[t]:
                    continue
                rows = trees[t].pop(node.path)
                left = self.sides[i](rows, *node.split)
                for kid, side in ((2 * node.path, left), (2 * node.path + 1, ~left)):
                    kept = np.flatnonzero(side) if rows is None else rows[side]
                    if len(kept):
                        trees[t][kid] = kept.astype(np.int32, copy=False)
                        if is_left[j] == (kid % 2 == 0):
                            out[j] += self._histogram(i, t, trees[t][kid])
        return out, is_left, [(2 * n.path, 2 * n.path + 1) for _, n in wanted]

    def finish(self, owner, grown):
        self.p = self.rows = None
        for sides, margin in zip(self.sides, self.margins):
            for k, (tree, _) in enumerate(grown):
                _add_leaves(sides, tree, margin[k])

    def confusion(self) -> dict[tuple, int]:
        n = sum(_confusion(r, self.spec, margin) for r, margin in zip(self.records, self.margins))
        return {tuple(map(int, key)): int(n[tuple(key)]) for key in np.argwhere(n)}


class SparkRows:
    """Row holder of ``boosting.grow`` over written blocks: one job per wave, all models in step."""

    wave = 16

    def __init__(self, blocks: DataFrame, specs: list[bo.Spec], features: int, bins: int = BINS):
        self.spark, self.specs, self.features, self.bins = blocks.sparkSession, specs, features, bins
        checkpoint_dir(self.spark)
        rows = blocks.agg(F.sum("rows")).first()[0] or 0
        cores = self.spark.sparkContext.defaultParallelism
        self.tasks = cores * max(1, math.ceil(rows / (PART_ROWS * cores)))
        self.place, trees = {}, {}           # model -> first margin among those of its fold; fold -> its margins
        for m, s in enumerate(specs):
            self.place[m] = trees.get(s.fold, 0)
            trees[s.fold] = self.place[m] + s.trees
        most_rows = min(JOINED_ROWS, MARGIN_BYTES // (8 * max(trees.values())))
        # plain records, dealt evenly: a job over them starts in less than half the time of one over a table
        dealt = (blocks.select("fold", "rows", "x", "y", "share", "keys").repartition(self.tasks)
                 .sortWithinPartitions("fold", F.xxhash64("keys")))
        records = dealt.rdd.mapPartitions(_joined(most_rows, features, any(s.subsample < 1 for s in specs)))
        only_scored = lambda r: isinstance(r["share"], float) and math.isinf(r["share"])
        self.state = records.filter(lambda r: not only_scored(r)).persist(StorageLevel.MEMORY_AND_DISK)
        self.apart = records.filter(only_scored)       # no tree is grown from them: scored when all are grown
        self.cached, self.unwritten = [self.state], 0
        self.starts = None
        self.grown: list[tuple] = []

    def _ready(self):
        """Plain values that the tasks need besides the records."""
        specs, place, starts = self.specs, self.place, self.starts

        def margins_of(record):
            """(margins by model, all margins) of one record."""
            mine = [m for m, s in enumerate(specs) if s.fold == record["fold"]]
            if record["margins"] is not None:
                all_ = record["margins"]
            elif mine and starts:
                all_ = np.concatenate([np.repeat(np.array(starts[m])[:, None], len(record["y"]), axis=1) for m in mine])
            else:
                all_ = np.zeros((0, len(record["y"])))
            return {m: all_[place[m]:place[m] + specs[m].trees] for m in mine}, all_
        return margins_of

    def class_counts(self):
        specs = self.specs

        def run(r):
            for m, s in enumerate(specs):
                if s.fold == r["fold"]:
                    yield from (((m, k), int(n)) for k, n in enumerate(_class_counts(r, s)))

        counts = [np.zeros(s.classes) for s in specs]
        for (m, k), n in self.state.flatMap(run).reduceByKey(operator.add, self.tasks).collect():
            counts[m][k] = n
        return counts

    def start(self, starts):
        self.starts = [s.tolist() for s in starts]

    def begin(self, turn, owner):
        self.turn, self.owner = turn, owner
        self.splits: list[dict] = [{} for _ in owner]

    def whole(self, t):
        return 1

    def _sums(self, requests):
        margins_of, specs, turn, owner = self._ready(), self.specs, self.turn, self.owner
        splits, features, bins = self.splits, self.features, self.bins
        by_tree: dict[int, dict] = {}
        for i, (t, path) in enumerate(requests):
            by_tree.setdefault(t, {})[path] = i

        def count(records):
            sums: dict[int, np.ndarray] = {}
            for r in records:
                margins, _ = margins_of(r)
                ready, sides = {}, _Sides(r)
                for t, asked in by_tree.items():
                    m, k = owner[t]
                    if m not in margins:
                        continue
                    if m not in ready:                    # the same for all classes of a model
                        ready[m] = (_bag(r, specs[m], turn), bo.gradients(margins[m], r["y"]) if specs[m].trees > 1 else None)
                    used, both = ready[m]
                    for i, rows in _reached(sides, used, splits[t], asked):
                        if rows is not None and not len(rows):
                            continue
                        at = slice(None) if rows is None else rows
                        if both is not None:
                            g, h = both[0][k][at], both[1][k][at]
                        else:
                            g, h = (v[0] for v in bo.gradients(margins[m][:, at], r["y"][at]))
                        hist = _histogram(r, rows, g, h, features, bins)
                        sums[i] = sums[i] + hist if i in sums else hist
            return sums.items()

        out = np.zeros((len(requests), features, bins, 3))
        parts = self.state.mapPartitions(count)
        if self.tasks * out.nbytes > DIRECT_BYTES:
            parts = parts.reduceByKey(operator.add, self.tasks)
        for i, hist in parts.collect():
            out[i] += hist
        for old in self.cached[:-1]:                  # the job above has filled the last one
            old.unpersist()
        del self.cached[:-1]
        return out

    def roots(self):
        return self._sums([(t, 1) for t in range(len(self.owner))])

    def children(self, wanted):
        """The side with fewer rows is counted; the parent's histogram tells which one that is."""
        requests, is_left = [], []
        for t, node in wanted:
            self.splits[t][node.path] = node.split
            is_left.append(_left_is_smaller(node))
            requests.append((t, 2 * node.path + (not is_left[-1])))
        return self._sums(requests), is_left, [(2 * n.path, 2 * n.path + 1) for _, n in wanted]

    def finish(self, owner, grown):
        margins_of = self._ready()
        trees = [(m, k, vars(tree)) for (m, k), (tree, _) in zip(owner, grown)]
        self.grown += trees

        def run(r):
            (by_model, all_), sides = margins_of(r), _Sides(r)
            for m, k, tree in trees:
                if m in by_model:
                    _add_leaves(sides, bo.Tree(**tree), by_model[m][k])
            return {**r, "margins": all_}

        # filled, and every few rounds written, by the next job that reads the records
        self.state = self.state.map(run).persist(StorageLevel.MEMORY_AND_DISK)
        self.cached.append(self.state)
        self.unwritten = (self.unwritten + 1) % WRITTEN_ROUNDS
        if not self.unwritten:
            self.state.checkpoint()
        self.counts = None

    def release(self):
        for old in self.cached:
            old.unpersist()
        self.cached = []

    def _scored_apart(self):
        """The records that no tree was grown from, with their margins; some trees at a time."""
        state, margins_of = self.apart, self._ready()
        for a in range(0, len(self.grown), TREES_AT_ONCE):
            trees = self.grown[a:a + TREES_AT_ONCE]

            def run(r, trees=trees):
                (by_model, all_), sides = margins_of(r), _Sides(r)
                for m, k, tree in trees:
                    if m in by_model:
                        _add_leaves(sides, bo.Tree(**tree), by_model[m][k])
                return {**r, "margins": all_}

            state = state.map(run).persist(StorageLevel.MEMORY_AND_DISK)
            self.cached.append(state)
            state.count()
            for old in self.cached[1:-1]:             # the first one holds the rows that trees were grown from
                old.unpersist()
            del self.cached[1:-1]
        return state

    def confusions(self, m: int) -> dict[tuple, int]:
        if getattr(self, "counts", None) is None:
            margins_of, specs = self._ready(), self.specs

            def run(r):
                margins, _ = margins_of(r)
                for k, margin in margins.items():
                    n = _confusion(r, specs[k], margin)
                    yield from (((k, *map(int, key)), int(n[tuple(key)])) for key in np.argwhere(n))
            for old in self.cached[:-1]:
                old.unpersist()
            del self.cached[:-1]
            parts = [self.state.flatMap(run), self._scored_apart().flatMap(run)]
            self.counts = [x for p in parts for x in p.reduceByKey(operator.add, self.tasks).collect()]  # models x classes^2 rows
        out: dict[tuple, int] = {}
        for key, n in self.counts:
            if key[0] == m:
                out[key[1:]] = out.get(key[1:], 0) + n
        return out


def routed(x: np.ndarray, splits: dict[int, tuple]) -> np.ndarray:
    """Path of the node that each row is in, given the splits by path."""
    deep = bool(splits) and max(splits) >= 1 << 61              # paths of over 60 levels need Python's integers
    at = np.ones(len(x), object if deep else np.int64)
    for path in sorted(splits):
        f, edge, missing_left = splits[path]
        mine = np.flatnonzero(at == path)
        value = x[mine, f]
        left = np.where(value == 0, missing_left, value <= edge)
        at[mine] = np.where(left, 2 * path, 2 * path + 1)
    return at


# ------------------------------------------------------------------ training
@dataclass
class Fitted:
    spec: bo.Spec
    confusion: dict           # (learned from, class, predicted) -> rows
    model: bo.Model | None    # only if asked for


def _dealt(specs: list[bo.Spec], groups: int) -> list[list[int]]:
    """Indices of the specs in at most ``groups`` lots of like cost, costliest first."""
    lots = [[0.0, []] for _ in range(max(1, min(groups, len(specs))))]
    for i in sorted(range(len(specs)), key=lambda i: -specs[i].rounds * specs[i].trees):
        lot = min(lots, key=lambda x: x[0])
        lot[0] += specs[i].rounds * specs[i].trees
        lot[1].append(i)
    return [x for _, x in lots]


def _lots(blocks: DataFrame, specs: list[bo.Spec]) -> DataFrame:
    """Blocks by lot: a lot is one fold and some of its models."""
    spark = blocks.sparkSession
    folds = sorted({s.fold for s in specs})
    lots = []
    for fold in folds:
        mine = [i for i, s in enumerate(specs) if s.fold == fold]
        # several lots per core, so that the last one does not hold up the end
        for lot in _dealt([specs[i] for i in mine], math.ceil(6 * spark.sparkContext.defaultParallelism / len(folds))):
            lots.append((len(lots), fold, json.dumps([[mine[i], asdict(specs[mine[i]])] for i in lot])))
    table = spark.createDataFrame(lots, "lot int, fold int, specs string")
    return (blocks.join(F.broadcast(table), "fold").select("lot", "specs", "fold", "rows", "x", "y", "share", "keys")
            .repartitionByRange(len(lots), "lot").sortWithinPartitions("lot", F.xxhash64("keys")))


def _one_by_one(blocks: DataFrame, specs: list[bo.Spec], features: int, bins: int, models: bool) -> list[Fitted]:
    """Each task gets the blocks of a large fold and fits some of the fold's models, one after the other."""
    def run(rows):
        for _, lot in groupby(rows, key=lambda r: r["lot"]):
            first = next(lot)
            wanted = [(i, bo.Spec(**s)) for i, s in json.loads(first["specs"])]
            joined = _joined(JOINED_ROWS, features, any(s.subsample < 1 for _, s in wanted))
            records = list(joined(chain([first], lot)))
            for i, spec in wanted:
                held = TaskRecords(records, spec, features, bins)
                model = bo.boost(held, [spec], features)[0]
                yield i, held.confusion(), model.to_dict() if models else None

    out: list = [None] * len(specs)
    for i, confusion, model in _lots(blocks, specs).rdd.mapPartitions(run).collect():
        out[i] = Fitted(specs[i], confusion, bo.Model.from_dict(model) if models else None)
    return out


def _in_tasks(blocks: DataFrame, specs: list[bo.Spec], features: int, bins: int, models: bool) -> list[Fitted]:
    """Each task gets the blocks of one fold and some of the fold's models."""
    def run(batches):
        held, last = [], None

        def fit():
            numbers, mine = zip(*[(i, bo.Spec(**s)) for i, s in json.loads(last[1])])
            x, y, share, keys = (np.concatenate(p) for p in zip(*held))
            rows = bo.TaskRows(x, y, share, keys, list(mine), bins)
            fitted = bo.boost(rows, list(mine), features)
            out = [(i, json.dumps([[*k, v] for k, v in rows.confusions(j).items()]),
                    json.dumps(fitted[j].to_dict()) if models else None) for j, i in enumerate(numbers)]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (
                pa.int32(), pa.string(), pa.string()))], names=["spec", "confusion", "model"])

        for batch in batches:
            for r in batch.to_pylist():
                if last is not None and r["lot"] != last[0]:
                    yield fit()
                    held = []
                last = (r["lot"], r["specs"])
                held.append(_unpacked(r["x"], r["y"], r["share"], r["keys"], features))
        if last is not None:
            yield fit()

    got = (_lots(blocks, specs).select("lot", "specs", "x", "y", "share", "keys")
           .mapInArrow(run, "spec int, confusion string, model string").collect())
    out: list = [None] * len(specs)
    for r in got:
        out[r["spec"]] = Fitted(specs[r["spec"]], {tuple(x[:3]): x[3] for x in json.loads(r["confusion"])},
                                bo.Model.from_dict(json.loads(r["model"])) if models else None)
    return out


def _row_bytes(spec: bo.Spec, features: int) -> int:
    """About the bytes of a row in ``TaskRecords``: codes, class, key and share; margin, probability and row
    number of each tree of a round."""
    return features + 18 + 20 * spec.trees


def train(blocks: DataFrame, specs: list[bo.Spec], features: int, bins: int = BINS, models: bool = False,
          task_rows: int = TASK_ROWS) -> list[Fitted]:
    """Fit every spec over written blocks; with ``models`` the fitted trees come back too."""
    ship_package(blocks.sparkSession)
    size = {r["fold"]: r["n"] for r in blocks.groupBy("fold").agg(F.sum("rows").alias("n")).collect()}
    out: list = [None] * len(specs)
    small = [i for i, s in enumerate(specs) if size.get(s.fold, 0) <= task_rows]
    large = [i for i, s in enumerate(specs) if size.get(s.fold, 0) > task_rows]
    if small:
        for i, f in zip(small, _in_tasks(blocks, [specs[i] for i in small], features, bins, models)):
            out[i] = f
    lean = [i for i in large if task_rows and size[specs[i].fold] * _row_bytes(specs[i], features) <= TASK_BYTES]
    if JOBS_COST * len(lean) > blocks.sparkSession.sparkContext.defaultParallelism:
        large = [i for i in large if i not in lean]
        for i, f in zip(lean, _one_by_one(blocks, [specs[i] for i in lean], features, bins, models)):
            out[i] = f
    if large:
        mine = [specs[i] for i in large]
        rows = SparkRows(blocks.where(c("fold").isin(sorted({s.fold for s in mine}))), mine, features, bins)
        fitted = bo.boost(rows, mine, features)
        for j, i in enumerate(large):
            out[i] = Fitted(specs[i], rows.confusions(j), fitted[j] if models else None)
        rows.release()
    return out


# ------------------------------------------------------------------ Spark ML stages
class BoosterModel(MLModel, DefaultParamsReadable, DefaultParamsWritable):
    """Scores a ``features`` vector: probability (vector) and prediction (class code)."""

    trees = Param(Params._dummy(), "trees", "the fitted booster and its cut points as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: str | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=trees)

    def _parts(self):
        d = json.loads(self.getOrDefault(self.trees))
        return bo.Model.from_dict(d["model"]), d["cuts"]

    @property
    def featureImportances(self):
        model, cuts = self._parts()
        return DenseVector(model.importance(len(cuts)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        shared = dataset.sparkSession.sparkContext.broadcast(self.getOrDefault(self.trees))

        @F.pandas_udf("array<double>")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            d = json.loads(shared.value)
            model, cuts = bo.Model.from_dict(d["model"]), d["cuts"]
            for values in batches:
                raw = np.array(values.tolist(), float).reshape(len(values), len(cuts))
                yield pd.Series(list(bo.probabilities(model.margins(binned(raw, cuts))).T))

        out = dataset.withColumn("_scored", scored(vector_to_array("features")))
        best = F.array_position("_scored", F.array_max("_scored")) - 1
        return out.withColumn("probability", array_to_vector("_scored")).withColumn(
            "prediction", best.cast("double")).drop("_scored")


class Booster(Estimator):
    """Fits one booster on (features vector, label code); ``weighted`` takes cut points at equal
    shares of the starting hessian instead of plain quantiles."""

    def __init__(self, spec: bo.Spec, label_col: str = "label", key_col: str = "udi", weighted: bool = False, bins: int = BINS):
        super().__init__()
        self.spec, self.label_col, self.key_col, self.weighted, self.bins = spec, label_col, key_col, weighted, bins

    def _fit(self, dataset: DataFrame) -> BoosterModel:
        rows = dataset.select(vector_to_array("features").alias("features"), c(self.label_col).cast("int").alias("code"),
                              c(self.key_col).cast("long").alias("key"))
        features = len(rows.first()["features"])
        if self.weighted:
            cuts = weighted_cuts(rows, "features", start_hessian(rows, self.spec.classes), features, self.bins)
        else:
            cuts = quantile_cuts(rows, "features", features, self.bins)
        blocks = cut_lineage(pack(rows, cuts, self.spec.fold))
        fitted = train(blocks, [self.spec], features, self.bins, models=True)[0]
        return BoosterModel(trees=json.dumps({"model": fitted.model.to_dict(), "cuts": cuts}))


def start_hessian(rows: DataFrame, classes: int):
    """Column of the hessian at the starting margins (the sum over classes for more than two)."""
    counts = np.zeros(classes)
    for r in rows.groupBy("code").count().collect():               # one row per class
        counts[r["code"]] = r["count"]
    p = bo.probabilities(bo.start_margins(counts)[:, None])[:, 0]
    return F.lit(float(p[1] * p[0] if classes == 2 else classes / (classes - 1) * (p * (1 - p)).sum()))
