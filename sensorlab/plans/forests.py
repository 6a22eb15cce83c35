"""The forest of :mod:`sensorlab.operators.forest` over Spark tables.

Rows are binned once into blocks (``boosters.pack``).  Nodes with more than ``TASK_ROWS`` rows are split
from histograms, one Spark job per level for all trees; then each node's rows (bins, class, bootstrap
count) are shuffled to a task that grows the tree below it.  The grown pieces are a table in the
checkpoint folder; only the sums of gains come to the driver.  The bound says where a node is split;
it changes no tree.

Scoring joins distinct binned inputs with the pieces: blocks of inputs go to every lot of trees, votes are
whole numbers (leaf shares times 2^40), so their sums are the same in any order.
"""

from __future__ import annotations

import json
import math
import operator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model as MLModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlab.operators import forest as fo
from sensorlab.plans import boosters
from sensorlab.session import cut_lineage, ship_package

c = F.col

TASK_ROWS = 1_000_000      # drawn rows of a node that one task may hold (about 100 bytes a row while it grows)
SCORED = 4096              # distinct inputs of a block that is scored
VOTE = 1 << 40             # a leaf's whole share
PIECES = ("tree int, path long, route string, feature binary, edge binary, left binary, counts binary, "
          "gains array<double>")


def _route(splits: dict[int, tuple], path: int) -> str:
    """The splits on the way to a node, as JSON: (feature, edge, goes right) from the root on."""
    steps = []
    while path > 1:
        f, edge = splits[path >> 1][:2]
        steps.append([f, edge, path & 1])
        path >>= 1
    return json.dumps(steps[::-1])


def _reached(x: np.ndarray, route: str) -> np.ndarray:
    """The rows that arrive at a piece."""
    mine = np.ones(len(x), bool)
    for f, edge, right in json.loads(route):
        mine &= (x[:, f] > edge) == bool(right)
    return np.flatnonzero(mine)


def _top(state, spec: fo.Spec, features: int, rows: int, task_rows: int):
    """(splits by tree and path, summed gains by tree and feature, nodes to grow, leaves with their counts):
    the levels above the tasks."""
    splits: list[dict] = [{} for _ in range(spec.trees)]
    gains = np.zeros((spec.trees, features))
    ready, leaves, large = [], [], [(t, 1) for t in range(spec.trees)]
    if rows <= task_rows:
        return splits, gains, large, leaves
    while large:
        by_tree: dict[int, list] = {}
        for i, (t, path) in enumerate(large):
            by_tree.setdefault(t, []).append((i, path))
        tried = np.stack([fo.node_features(np.array([path]), spec, t, features)[0] for t, path in large])

        def count(records, by_tree=by_tree, tried=tried, splits=splits):
            sums = {}
            for x, y, keys in records:
                for t, asked in by_tree.items():
                    w = fo.bootstrap(keys, spec.seed, t).astype(float)
                    at = boosters.routed(x, splits[t])
                    for i, path in asked:
                        mine = np.flatnonzero((at == path) & (w > 0))
                        if i not in sums:
                            sums[i] = np.zeros((tried.shape[1], spec.bins, spec.classes))
                        for j, f in enumerate(tried[i]):
                            cell = x[mine, f].astype(np.int64) * spec.classes + y[mine]
                            sums[i][j] += np.bincount(cell, w[mine], spec.bins * spec.classes).reshape(spec.bins, -1)
            return sums.items()

        found = dict(state.mapPartitions(count).reduceByKey(operator.add).collect())
        below = []
        for i, (t, path) in enumerate(large):
            if i not in found:                             # no row was drawn
                continue
            counts = found[i][:1].sum(axis=1)
            if counts.sum() <= task_rows:
                ready.append((t, path))
                continue
            gain, f, edge = (v[0] for v in fo.best_splits(found[i][None], tried[i:i + 1]))
            if path.bit_length() > spec.max_depth or not fo.may_split(counts)[0] or gain <= 0:
                leaves.append((t, path, counts[0]))
                continue
            splits[t][path] = (int(f), int(edge), True)
            gains[t, f] += gain
            below += [(t, 2 * path), (t, 2 * path + 1)]
        large = below
    return splits, gains, sorted(ready), leaves


def grown(blocks: DataFrame, spec: fo.Spec, features: int, task_rows: int = TASK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """(table of pieces, importance of each feature) of a forest over written blocks."""
    spark = blocks.sparkSession
    ship_package(spark)
    rows = blocks.agg(F.sum("rows")).first()[0] or 0

    def unpacked(r):
        x, y, _, keys = boosters._unpacked(r["x"], r["y"], r["share"], r["keys"], features)
        return x, y, keys

    state = blocks.rdd.map(unpacked)
    splits, gains, groups, leaves = _top(state, spec, features, rows, task_rows)
    by_tree: dict[int, list] = {}
    for g, (t, path) in enumerate(groups):
        by_tree.setdefault(t, []).append((g, path))

    def dealt(record):
        x, y, keys = record
        for t, mine in by_tree.items():
            w = fo.bootstrap(keys, spec.seed, t)
            at = boosters.routed(x, splits[t]) if splits[t] else None
            for g, path in mine:
                taken = np.flatnonzero(w > 0 if at is None else (w > 0) & (at == path))
                if len(taken):
                    yield g, (x[taken].tobytes(), y[taken].astype(np.int16).tobytes(), w[taken].tobytes())

    def grow(records):
        held: dict[int, list] = {}
        for g, part in records:
            held.setdefault(g, []).append(part)
        for g, parts in held.items():
            x, y, w = (np.frombuffer(b"".join(p[i] for p in parts), kind) for i, kind in enumerate((np.uint8, np.int16, np.uint8)))
            t, path = groups[g]
            yield row(t, path, fo.grow(x.reshape(-1, features), y, w, spec, t, path))

    def row(t, path, tree):
        return (t, path, _route(splits[t], path), tree.feature.tobytes(), tree.edge.tobytes(), tree.left.tobytes(),
                tree.counts.astype(np.int64).tobytes(), tree.gains.tolist())

    # one task per node, so that a task holds at most ``task_rows`` drawn rows
    made = state.flatMap(dealt).partitionBy(max(1, len(groups)), lambda g: g).mapPartitions(grow)
    table = spark.createDataFrame(made, PIECES, verifySchema=False)
    if leaves:                                             # of the levels above: a few nodes
        table = table.unionByName(spark.createDataFrame([row(t, path, fo.leaf(counts, features)) for t, path, counts in leaves], PIECES))
    pieces = cut_lineage(table)
    for r in pieces.groupBy("tree").agg(*[F.sum(c("gains")[f]).alias(f"g{f}") for f in range(features)]).collect():
        gains[r["tree"]] += [r[f"g{f}"] for f in range(features)]
    gains /= np.maximum(gains.sum(axis=1, keepdims=True), 1e-300)       # every tree weighs the same
    total = gains.sum(axis=0)
    return pieces, total / (total.sum() or 1.0)


def _votes(features: int, classes: int):
    """Votes of each lot of pieces for each block of inputs; the pieces of a lot come first."""
    def run(batches):
        lot, pieces = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["lot"] != lot:
                    lot, pieces = r["lot"], []
                if r["codes"] is None:
                    tree = fo.Tree(np.frombuffer(r["feature"], np.int16), np.frombuffer(r["edge"], np.uint8),
                                   np.frombuffer(r["left"], np.int32), None, None)
                    pieces.append((r["route"], tree, np.frombuffer(r["counts"], np.int64).reshape(-1, classes)))
                    continue
                x = np.frombuffer(r["codes"], np.uint8).reshape(-1, features)
                votes = np.zeros((len(x), classes), np.int64)
                for route, tree, counts in pieces:
                    mine = _reached(x, route)
                    if len(mine):
                        leaf = counts[tree.leaf_of(x[mine])]
                        votes[mine] += np.rint(leaf / leaf.sum(axis=1, keepdims=True) * VOTE).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["codes"][:features]], pa.binary()), pa.array([r["codes"]], pa.binary()),
                     pa.array([votes.tobytes()], pa.binary())], names=["head", "codes", "votes"])
    return run


def _summed(features: int, classes: int):
    """Share of the votes of each input of a block."""
    def run(table: pa.Table) -> pa.Table:
        codes = table["codes"][0].as_py()
        votes = sum(np.frombuffer(v, np.int64) for v in table["votes"].to_pylist()).reshape(-1, classes)
        share = votes / votes.sum(axis=1, keepdims=True)
        return pa.table({"_code": pa.array([codes[i:i + features] for i in range(0, len(codes), features)], pa.binary()),
                         "_scored": pa.array(share.tolist(), pa.list_(pa.float64()))})
    return run


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.instance.pieces.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        self.instance.pieces.write.mode("overwrite").parquet(f"{path}/pieces")


class _Reader(MLReader):
    def load(self, path: str):
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ForestModel(spark.read.parquet(f"{path}/pieces"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class ForestModel(MLModel, MLWritable, MLReadable):
    """Scores a ``features`` vector: probability (vector, mean leaf share of the trees) and prediction (class code)."""

    fitted = Param(Params._dummy(), "fitted", "classes, cut points and importances as JSON", TypeConverters.toString)

    def __init__(self, pieces: DataFrame, fitted: str | None = None):
        super().__init__()
        self.pieces = pieces
        if fitted is not None:
            self._set(fitted=fitted)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()

    @property
    def featureImportances(self):
        return DenseVector(json.loads(self.getOrDefault(self.fitted))["importances"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        ship_package(spark)
        d = json.loads(self.getOrDefault(self.fitted))
        cuts, classes, features = d["cuts"], d["classes"], len(d["cuts"])

        @F.pandas_udf("binary")
        def code(values: pd.Series) -> pd.Series:
            raw = np.array(values.tolist(), float).reshape(len(values), features)
            return pd.Series([row.tobytes() for row in boosters.binned(raw, cuts)], dtype=object)

        def blocked(batches):
            for batch in batches:
                codes = batch.column(0).to_pylist()
                for i in range(0, len(codes), SCORED):
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(codes[i:i + SCORED])], pa.binary())], names=["codes"])

        coded = dataset.withColumn("_code", code(vector_to_array("features")))
        lots = max(1, min(spark.sparkContext.defaultParallelism, d["trees"]))
        blocks = coded.select("_code").distinct().mapInArrow(blocked, "codes binary")
        dealt = (self.pieces.select((c("tree") % lots).alias("lot"), "route", "feature", "edge", "left", "counts")
                 .unionByName(blocks.select(F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"), "codes"),
                              allowMissingColumns=True))
        votes = (dealt.repartition(lots, "lot").sortWithinPartitions("lot", c("codes").isNotNull())
                 .mapInArrow(_votes(features, classes), "head binary, codes binary, votes binary"))
        scored = votes.groupBy("head").applyInArrow(_summed(features, classes), "_code binary, _scored array<double>")
        out = coded.join(scored, "_code").drop("_code")
        best = F.array_position("_scored", F.array_max("_scored")) - 1
        return out.withColumn("probability", array_to_vector("_scored")).withColumn(
            "prediction", best.cast("double")).drop("_scored")


class Forest(Estimator):
    """Fits a forest on (features vector, label code); every row's bootstrap follows its key and inputs."""

    def __init__(self, classes: int = 2, label_col: str = "label", key_col: str = "udi", trees: int = 100,
                 max_depth: int = 30, seed: int = 42, bins: int = 33, task_rows: int = TASK_ROWS):
        super().__init__()
        self.classes, self.label_col, self.key_col, self.trees = classes, label_col, key_col, trees
        self.max_depth, self.seed, self.bins, self.task_rows = max_depth, seed, bins, task_rows

    def _fit(self, dataset: DataFrame) -> ForestModel:
        rows = dataset.select(vector_to_array("features").alias("features"), c(self.label_col).cast("int").alias("code"),
                              c(self.key_col).alias("_id"))
        rows = rows.select("features", "code", F.xxhash64("_id", "features").alias("key"))
        features = len(rows.first()["features"])
        cuts = boosters.quantile_cuts(rows, "features", features, self.bins)
        spec = fo.Spec(self.trees, self.max_depth, math.ceil(math.sqrt(features)), self.classes, self.bins, self.seed)
        pieces, importances = grown(cut_lineage(boosters.pack(rows, cuts)), spec, features, self.task_rows)
        return ForestModel(pieces, json.dumps({"classes": self.classes, "cuts": cuts, "trees": self.trees,
                                               "importances": importances.tolist()}))
