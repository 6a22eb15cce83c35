"""Stratified split and folds, standard scaling, exact k-NN within class, SMOTE.

Row order is a function of the row key (a hash), never of the physical row order, so
every result is reproducible and independent of partitioning.

* split: a per-class quota of the hash order.  Counts per (class, hash bucket) decide
  most rows with no shuffle of the rows themselves; only the one bucket per class that
  straddles the quota is ranked.
* k-NN: rows of a class are cut into k-d cells of about ``block_size`` rows (a bounded sample places
  the cuts, every row is routed).  A cell finds the neighbours inside it with numpy; the k-th distance
  then bounds which other cells can hold a closer row (their box must come within that distance),
  and a row is sent to those only.  Where many rows are equal, the first k + 1 of each point by key
  stand for all of them.  Exact; a task holds a few cells and at most ``QUERY_ROWS`` rows of others at once.
* SMOTE: synthetic rows come from ``spark.range``; base row, neighbour and gap are
  hashes of the synthetic row's id; base and neighbour features arrive by equi-joins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sensorlab.functions.exprs import counter_random_sql, dround, key_hash
from sensorlab.functions.ordered import running_totals
from sensorlab.session import cut_lineage, ship_package

c = F.col


# ---------------------------------------------------------------- split and folds
def _ordered(df: DataFrame, key: str, seed: int, hash_kind: str, buckets: int) -> DataFrame:
    h = key_hash(key, seed, hash_kind)
    return df.withColumn("_h", h).withColumn("_b", F.pmod(c("_h"), F.lit(buckets)))


def _bucket_table(ordered: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """(label, bucket) → rows before the bucket in class order, rows in it, class quota.

    At most #classes x #buckets rows; the window runs per class over those rows."""
    counts = ordered.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n_c = F.sum("_cnt").over(Window.partitionBy(label))
    return counts.select(label, "_b", "_cnt",
                         F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_before"),
                         F.floor(F.lit(test_fraction) * n_c + 0.5).alias("_quota"))


def split_cutoffs(df: DataFrame, label: str, key: str, test_fraction: float, seed: int,
                  hash_kind: str, buckets: int) -> list[tuple]:
    """(label, bucket, hash, key) of the last test row of each class with test rows, in (bucket, hash,
    key) order.  Two aggregations: rows per (class, bucket) name the one bucket of a class
    that holds its quota, and counts of that bucket's keys name the row.  One row a class
    reaches the driver."""
    ordered = _ordered(df.select(label, key), key, seed, hash_kind, buckets)
    edges = (_bucket_table(ordered, label, test_fraction)
             .where((c("_before") < c("_quota")) & (c("_before") + c("_cnt") >= c("_quota"))).collect())
    if not edges:
        return []
    inside, place, rest = F.lit(False), F.lit(0), F.lit(0)
    for i, r in enumerate(edges):
        mine = c(label).eqNullSafe(F.lit(r[label])) & (c("_b") == r["_b"])
        inside = inside | mine
        place = F.when(mine, i).otherwise(place)
        rest = F.when(mine, r["_quota"] - r["_before"]).otherwise(rest)
    keys = (ordered.where(inside).groupBy(place.alias("_class"), rest.alias("_rest"), "_h", c(key).alias("_key"))
            .agg(F.count(F.lit(1)).alias("_cnt")))
    so_far = Window.partitionBy("_class").orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, 0)
    found = (keys.withColumn("_upto", F.sum("_cnt").over(so_far)).where(c("_upto") >= c("_rest"))
             .groupBy("_class").agg(F.min(F.struct("_h", "_key")).alias("_at")).collect())
    return [(edges[r["_class"]][label], edges[r["_class"]]["_b"], r["_at"]["_h"], r["_at"]["_key"]) for r in found]


def stratified_split(df: DataFrame, label: str = "label", key: str = "udi",
                     test_fraction: float = 0.2, seed: int = 42, hash_kind: str = "xxhash64",
                     buckets: int | None = None) -> DataFrame:
    """Adds boolean ``is_test``: per class exactly floor(fraction * n_c + 0.5) test rows,
    the first ones in (bucket, hash, key) order.  The exact cut-off of each class is found by two aggregations;
    the split itself is a projection and moves no row.  ``df`` is read three times: pass a written
    table.  Keys are unique; rows that share the cut-off's key stay together."""
    buckets = buckets or (1024 if hash_kind == "arith" else 65536)
    ordered = _ordered(df, key, seed, hash_kind, buckets)
    is_test = F.lit(False)
    for value, bucket, h, last in split_cutoffs(df, label, key, test_fraction, seed, hash_kind, buckets):
        before = (c("_b") < bucket) | ((c("_b") == bucket) & ((c("_h") < h) | ((c("_h") == h) & (c(key) <= F.lit(last)))))
        is_test = F.when(c(label).eqNullSafe(F.lit(value)), before).otherwise(is_test)
    return ordered.withColumn("is_test", is_test).drop("_h", "_b")


def stratified_folds(df: DataFrame, k: int = 5, label: str = "label", key: str = "udi",
                     seed: int = 42, hash_kind: str = "xxhash64",
                     buckets: int | None = None) -> DataFrame:
    """Adds ``fold`` in 0..k-1: rank in class hash order modulo k, so every fold gets
    floor or ceil of n_c / k rows of each class.  Ranks are bucket offsets plus a row
    number inside (class, bucket): the window never spans a whole class."""
    buckets = buckets or (1024 if hash_kind == "arith" else 65536)
    ordered = _ordered(df, key, seed, hash_kind, buckets)
    table = _bucket_table(ordered, label, 0.0).select(label, "_b", "_before")
    j = ordered.join(table, [label, "_b"])
    w = Window.partitionBy(label, "_b").orderBy("_h", key)
    rank0 = c("_before") + F.row_number().over(w) - 1
    return j.withColumn("fold", F.pmod(rank0, F.lit(k)).cast("int")).drop("_h", "_b", "_before")


# ---------------------------------------------------------------- standard scaler
@dataclass
class ScalerModel:
    """Per-feature mean and population std (zero std → 1), fitted on training rows."""
    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame, digits: int | None = None) -> DataFrame:
        out = df
        for f, m in self.means.items():
            z = (c(f) - F.lit(m)) / F.lit(self.stds[f])
            if digits is not None:
                z = dround(z, digits)
            out = out.withColumn(f, z)
        return out


def fit_standard_scaler(train: DataFrame, features: Sequence[str]) -> ScalerModel:
    """One aggregate pass; the fitted model is 2 numbers per feature."""
    aggs = []
    for f in features:
        aggs += [F.avg(c(f).cast("double")).alias(f"m_{f}"), F.stddev_pop(c(f).cast("double")).alias(f"s_{f}")]
    row = train.agg(*aggs).first()
    means = {f: float(row[f"m_{f}"]) for f in features}
    stds = {f: (float(row[f"s_{f}"]) if row[f"s_{f}"] else 1.0) or 1.0 for f in features}
    return ScalerModel(means, stds)


def standard_scale(train: DataFrame, test: DataFrame | None, features: Sequence[str]):
    model = fit_standard_scaler(train, features)
    return model.transform(train), (model.transform(test) if test is not None else None), model


# ---------------------------------------------------------------- exact k-NN
CELL_ROWS = 4096         # rows of a k-d cell; the cells of a class are the groups that tasks search
LEAF_ROWS = 256          # candidates that are compared at once inside a cell
CELL_SAMPLE = 32         # rows of the sample per cell; they only place the cuts
SAMPLE_ROWS = 1 << 18    # rows of the whole sample, which comes to the driver
QUERY_ROWS = 1 << 16     # rows from other cells that one group answers
MAX_PARTS = 2048


def _sq_dist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances (len(a) x len(b)), features summed left to right (the same
    order of operations as a SQL sum of squared differences)."""
    d = np.zeros((a.shape[0], b.shape[0]))
    diff = np.empty_like(d)  # one scratch buffer, reused in place for every feature
    for j in range(a.shape[1]):
        np.subtract(a[:, j][:, None], b[:, j][None, :], out=diff)
        np.multiply(diff, diff, out=diff)
        np.add(d, diff, out=d)
    return d


def _box_dist(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Distance of each row to a box, summed like ``_sq_dist``: rounding never lifts it above
    the distance to a row in the box."""
    d = np.zeros(len(x))
    for j in range(x.shape[1]):
        gap = np.maximum(np.maximum(lo[j] - x[:, j], x[:, j] - hi[j]), 0.0)
        d += gap * gap
    return np.sqrt(d)


def _leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in leaves of at most ``size`` rows, halved along the widest axis."""
    todo, out = [np.arange(len(x))], []
    while todo:
        idx = todo.pop()
        if len(idx) <= size:
            out.append(idx)
            continue
        part = x[idx]
        order = np.argpartition(part[:, np.ptp(part, axis=0).argmax()], len(idx) // 2)
        todo += [idx[order[:len(idx) // 2]], idx[order[len(idx) // 2:]]]
    return out


def _keep_best(dist: np.ndarray, nb: np.ndarray, rows: np.ndarray, d: np.ndarray, keys: np.ndarray):
    """Merge candidates (row, distance, key) into the k nearest of each row, ties by key."""
    k = dist.shape[1]
    touched = np.unique(rows)
    old_row, old_pos = np.nonzero(np.isfinite(dist[touched]))
    r = np.r_[rows, touched[old_row]]
    d = np.r_[d, dist[touched[old_row], old_pos]]
    key = np.r_[keys, nb[touched[old_row], old_pos]]
    order = np.lexsort((key, d, r))
    r, d, key = r[order], d[order], key[order]
    pos = np.arange(len(r)) - np.searchsorted(r, r, side="left")
    keep = pos < k
    dist[r[keep], pos[keep]], nb[r[keep], pos[keep]] = d[keep], key[keep]


def nearest(q: np.ndarray, qk: np.ndarray, x: np.ndarray, xk: np.ndarray, k: int, bound: np.ndarray | None = None):
    """(distances, keys), (len(q) x k) each, of the k nearest rows of ``x`` with another key and at most
    ``bound`` away; infinite where there are fewer.  ``bound=None``: ``q`` and ``x`` are the same rows.
    A leaf of ``x`` is compared with the rows whose k-th distance reaches its box."""
    dist, nb = np.full((len(q), k), np.inf), np.zeros((len(q), k), xk.dtype)
    leaves = _leaves(x, LEAF_ROWS)
    own = np.full(len(q), -1)
    if bound is None:
        bound = np.full(len(q), np.inf)
        for n, idx in enumerate(leaves):
            own[idx] = n
            d = np.sqrt(_sq_dist(x[idx], x[idx]))
            d[xk[idx][:, None] == xk[idx][None, :]] = np.inf
            kth = np.partition(d, min(k, len(idx)) - 1, axis=1)[:, min(k, len(idx)) - 1]
            r, s = np.nonzero((d <= kth[:, None]) & np.isfinite(d))
            _keep_best(dist, nb, idx[r], d[r, s], xk[idx][s])
    for n, idx in enumerate(leaves):
        part, keys = x[idx], xk[idx]
        limit = np.minimum(bound, dist[:, k - 1])
        near = np.flatnonzero((own != n) & (_box_dist(q, part.min(axis=0), part.max(axis=0)) <= limit))
        for i in range(0, len(near), 4096):
            rows = near[i:i + 4096]
            d = np.sqrt(_sq_dist(q[rows], part))
            r, s = np.nonzero((d <= limit[rows][:, None]) & np.isfinite(d))
            other = qk[rows[r]] != keys[s]
            if other.any():
                r, s = r[other], s[other]
                _keep_best(dist, nb, rows[r], d[r, s], keys[s])
    return dist, nb


@dataclass
class Cells:
    """k-d cuts of every class: rows with x[axis] <= at go left; a cell has axis -1 and its number."""
    axis: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cell: np.ndarray
    roots: list[int]
    first: list[int]                  # smallest cell of each class
    lo: np.ndarray | None = None      # boxes by cell
    hi: np.ndarray | None = None

    @staticmethod
    def build(samples: list[np.ndarray], leaf: int) -> "Cells":
        nodes, roots, first, cells = [], [], [], 0
        for sample in samples:
            roots.append(len(nodes))
            first.append(cells)
            nodes.append(None)
            todo = [(roots[-1], sample)]
            while todo:
                me, x = todo.pop()
                cut = _cut(x) if len(x) > leaf + leaf // 2 else None
                if cut is None:
                    nodes[me] = (-1, 0.0, 0, 0, cells)
                    cells += 1
                    continue
                axis, at = cut
                left = x[:, axis] <= at
                nodes[me] = (axis, at, len(nodes), len(nodes) + 1, -1)
                todo += [(len(nodes), x[left]), (len(nodes) + 1, x[~left])]
                nodes += [None, None]
        return Cells(*map(np.array, zip(*nodes)), roots, first)

    def of(self, cls: np.ndarray, x: np.ndarray) -> np.ndarray:
        at = np.array(self.roots)[cls]
        live = np.flatnonzero(self.axis[at] >= 0)
        while len(live):
            node = at[live]
            left = x[live, self.axis[node]] <= self.at[node]
            at[live] = np.where(left, self.left[node], self.right[node])
            live = live[self.axis[at[live]] >= 0]
        return self.cell[at]

    def reached(self, cell: int, x: np.ndarray, radius: np.ndarray):
        """(row, cell) for the other cells of the class that a row within ``radius`` may be in."""
        rows, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        todo = [(self.roots[int(np.searchsorted(self.first, cell, side="right")) - 1], np.arange(len(x)))]
        while todo:
            node, idx = todo.pop()
            if not len(idx):
                continue
            if self.axis[node] < 0:
                to = int(self.cell[node])
                if to != cell and np.isfinite(self.lo[to, 0]):
                    idx = idx[_box_dist(x[idx], self.lo[to], self.hi[to]) <= radius[idx]]
                    rows.append(idx)
                    cells.append(np.full(len(idx), to))
                continue
            gap = x[idx, self.axis[node]] - self.at[node]
            todo += [(self.left[node], idx[gap <= radius[idx]]), (self.right[node], idx[-gap <= radius[idx]])]
        return np.concatenate(rows), np.concatenate(cells)


def _cut(x: np.ndarray):
    """(axis, value) that halves the rows best along the axis of the largest spread, or None."""
    for axis in np.argsort(-x.std(axis=0), kind="stable"):
        v = np.sort(x[:, axis])
        mid = v[len(v) // 2]
        below = np.searchsorted(v, mid, side="left")
        upto = np.searchsorted(v, mid, side="right")
        choices = [(abs(2 * n - len(v)), v[n - 1]) for n in (below, upto) if 0 < n < len(v)]
        if choices:
            return int(axis), float(min(choices)[1])
    return None


def _matrix(column: pa.ChunkedArray | pa.Array, features: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, features)


def _first_copies(base: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows that may be a neighbour when many rows are equal, the first k + 1 of each point by key, and
    (_key, _nb, _dist) of the other rows: the first k of their point."""
    w = Window.partitionBy("_cls", "_x").orderBy("_key")
    first = cut_lineage(base.withColumn("_rn", F.row_number().over(w)).where(c("_rn") <= k + 1))
    nbs = (first.where(c("_rn") <= k).groupBy("_cls", "_x").agg(F.collect_list("_key").alias("_nbs")))
    rest = base.join(first.select("_key"), "_key", "left_anti").join(nbs, ["_cls", "_x"])
    return first.drop("_rn"), rest.select("_key", F.explode("_nbs").alias("_nb"), F.lit(0.0).alias("_dist"))


def knn_within_class(df: DataFrame, features: Sequence[str], k: int = 5, label: str = "label",
                     key: str = "udi", block_size: int = CELL_ROWS, materialized: bool = False) -> DataFrame:
    """k nearest same-class rows (Euclidean, ties by neighbour key), exact.

    Returns (key, neighbor_key, rank 1..k, distance).  Rows without a key or with a missing or infinite
    feature have no neighbours and are none.  ``block_size`` is about the rows of a cell; ``materialized=True``
    says ``df`` is already a cheap read (a filter / projection of a checkpoint), so it is not written out again."""
    spark = df.sparkSession
    ship_package(spark)
    feats, d = list(features), len(features)
    known = c(key).isNotNull() & c(label).isNotNull()
    for f in feats:
        known = known & (F.abs(c(f).cast("double")) < float("inf"))
    base = df.where(known).select(c(key).alias("_key"), c(label).alias("_cls"),
                                  F.array(*[c(f).cast("double") for f in feats]).alias("_x"))
    # the class rows are read by the counts, the sample and the cells
    if not materialized:
        base = cut_lineage(base)
    key_type = df.schema[key].dataType
    found_type = T.StructType([T.StructField("_key", key_type), T.StructField("_nb", key_type),
                               T.StructField("_dist", T.DoubleType())])

    def cells_of(base):
        """The cells of the rows, the rows with their cell, and the largest cell."""
        sizes = {r[0]: int(r[1]) for r in base.groupBy("_cls").count().collect()}  # one row per class
        classes = sorted(sizes, key=str)
        total = sum(sizes.values())
        cell_rows = max(block_size, math.ceil(total * CELL_SAMPLE / SAMPLE_ROWS))
        cut = [v for v in classes if sizes[v] > cell_rows]
        samples = {v: np.zeros((0, d)) for v in classes}
        if cut:
            share = min(1.0, CELL_SAMPLE / cell_rows)
            picked = (base.where(c("_cls").isin(cut) & (F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) < share * (1 << 20)))
                      .select("_cls", "_x").toArrow())
            owner, x = np.array(picked["_cls"].to_pylist(), object), _matrix(picked["_x"], d)
            samples.update({v: x[owner == v] for v in cut})
        cells = Cells.build([samples[v] for v in classes], CELL_SAMPLE)
        code = F.lit(0)
        for i, v in enumerate(classes):
            code = F.when(c("_cls") == F.lit(v), i).otherwise(code)

        def routed(batches):
            for batch in batches:
                cell = cells.of(batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(2), d))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *batch.columns[1:]],
                                                 names=["_cell", "_key", "_x"])

        rows = cut_lineage(base.select(code.alias("_code"), "_key", "_x").mapInArrow(
            routed, T.StructType([T.StructField("_cell", T.IntegerType()), T.StructField("_key", key_type),
                                  T.StructField("_x", T.ArrayType(T.DoubleType()))])))
        n = int(cells.cell.max()) + 1 if len(cells.cell) else 0
        cells.lo, cells.hi = np.full((n, d), np.inf), np.full((n, d), -np.inf)
        largest = 0
        for r in rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), *[
                agg(c("_x")[j]).alias(f"{name}{j}") for name, agg in (("lo", F.min), ("hi", F.max))
                for j in range(d)]).collect():                    # one row per cell
            cells.lo[r["_cell"]] = [r[f"lo{j}"] for j in range(d)]
            cells.hi[r["_cell"]] = [r[f"hi{j}"] for j in range(d)]
            largest = max(largest, r["n"])
        return cells, rows, largest, cell_rows

    cells, rows, largest, cell_rows = cells_of(base) if base.limit(1).count() else (None, None, 0, 0)
    if rows is None:
        return spark.createDataFrame([], T.StructType([
            T.StructField(key, key_type), T.StructField(f"neighbor_{key}", key_type),
            T.StructField("rank", T.IntegerType()), T.StructField("distance", T.DoubleType())]))
    copies = None
    if largest > 4 * cell_rows:             # only equal rows cannot be cut
        base, copies = _first_copies(base, k)
        cells, rows, _, _ = cells_of(base)
    parts = min(len(cells.lo), MAX_PARTS)
    arrow_type = to_arrow_type(key_type)

    def flat(key, dist, nb):
        r, s = np.nonzero(np.isfinite(dist))
        return [pa.array(key[r], arrow_type), pa.array(nb[r, s], arrow_type), pa.array(dist[r, s])]

    def in_cell(table: pa.Table) -> pa.Table:
        """Neighbours in the cell, and the rows with the other cells that a closer one may be in."""
        key, x = table["_key"].to_numpy(), _matrix(table["_x"], d)
        dist, nb = nearest(x, key, x, key, k)
        near = flat(key, dist, nb)
        r, to = cells.reached(table["_cell"][0].as_py(), x, dist[:, k - 1])
        n, m = len(near[0]), len(r)
        points = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * d, pa.int32()), pa.array(x[r].ravel()))
        return pa.table([
            pa.concat_arrays([near[0], pa.array(key[r], arrow_type)]), pa.concat_arrays([near[1], pa.nulls(m, arrow_type)]),
            pa.concat_arrays([near[2], pa.array(dist[r, k - 1])]), pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(to, pa.int32())]),
            pa.concat_arrays([pa.nulls(n, pa.list_(pa.float64())), points])], names=["_key", "_nb", "_dist", "_cell", "_x"])

    local = cut_lineage(rows.repartition(parts, "_cell").groupBy("_cell").applyInArrow(in_cell, T.StructType([
        *found_type.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_x", T.ArrayType(T.DoubleType()))])))
    queries = local.where(c("_cell").isNotNull()).select("_cell", "_key", "_x", c("_dist").alias("_bound"))
    found = local.where(c("_cell").isNull()).select("_key", "_nb", "_dist")
    asked = [(r[0], math.ceil(r[1] / QUERY_ROWS)) for r in queries.groupBy("_cell").count().collect()]  # one row per cell

    def from_others(asking: pa.Table, table: pa.Table) -> pa.Table:
        key, x = asking["_key"].to_numpy(), _matrix(asking["_x"], d)
        dist, nb = nearest(x, key, _matrix(table["_x"], d), table["_key"].to_numpy(), k, asking["_bound"].to_numpy())
        return pa.table(flat(key, dist, nb), names=["_key", "_nb", "_dist"])

    if asked:
        batches = F.broadcast(spark.createDataFrame(asked, "_cell int, _n long"))
        cell = ["_cell", "_batch"]
        parts = min(sum(n for _, n in asked), MAX_PARTS)
        queries = queries.join(batches, "_cell").withColumn("_batch", F.pmod(F.xxhash64("_key"), c("_n"))).drop("_n")
        answering = rows.join(batches, "_cell").withColumn(
            "_batch", F.explode(F.sequence(F.lit(0).cast("long"), c("_n") - 1))).drop("_n")
        remote = (queries.repartition(parts, *cell).groupBy(*cell)
                  .cogroup(answering.repartition(parts, *cell).groupBy(*cell)).applyInArrow(from_others, found_type))
        found = found.unionByName(remote)
    if copies is not None:
        found = found.unionByName(copies)
    # keep the k best per row: a row has k neighbours of its own cell and only closer ones of others
    best = found.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_dist", "_nb"))).alias("_c"))
    top = best.select("_key", F.posexplode(F.slice("_c", 1, k)).alias("_pos", "_s"))
    return top.select(c("_key").alias(key), c("_s._nb").alias(f"neighbor_{key}"),
                      (c("_pos") + 1).cast("int").alias("rank"), c("_s._dist").alias("distance"))


# ---------------------------------------------------------------- SMOTE
def dense_index(df: DataFrame, label: str, key: str, seed: int = 42, hash_kind: str = "xxhash64") -> DataFrame:
    """Adds ``_idx`` 0..n_c-1 per class in key-hash order (two-level ranks)."""
    h = df.withColumn("_hk", key_hash(key, seed, hash_kind).cast("double")).withColumn("_one", F.lit(1))
    r = running_totals(h, "_hk", ["_one"], groups=[label], tiebreak=[key])
    return r.withColumn("_idx", (c("_one_cum") - 1).cast("long")).drop("_hk", "_one", "_one_cum")


def smote(df: DataFrame, features: Sequence[str], label: str = "label", key: str = "udi",
          k: int = 5, seed: int = 42, k_cap: bool = False, materialized: bool = False,
          hash_kind: str = "xxhash64") -> DataFrame:
    """Lift every class to the size of the largest one with synthetic rows
    x + u * (neighbour - x), u in [0, 1), neighbour one of the k nearest same-class rows.

    Returns the input rows (``is_synthetic`` false) plus the synthetic ones (negative keys).
    Base row, neighbour rank and u are numbers of a counter-based generator that SQL states
    too; with ``hash_kind="arith"`` so is the order that base rows are counted in.
    A class with n_c <= k raises, as the library does, unless ``k_cap`` uses n_c - 1.
    ``materialized=True``: ``df`` is already a cheap read of a checkpoint."""
    feats = list(features)
    spark = df.sparkSession
    # the input is read by the class counts, the k-NN, the dense index and both joins
    df = df.select(key, label, *feats)
    if not materialized:
        df = cut_lineage(df)
    counts = {r[0]: int(r[1]) for r in df.groupBy(label).count().collect()}  # one row per class
    n_max = max(counts.values())
    need = {cl: n_max - n for cl, n in counts.items() if n < n_max}
    originals = df.select(key, label, *feats).withColumn("is_synthetic", F.lit(False))
    if not need:
        return originals
    for cl, n in counts.items():
        if cl in need and n <= k and not k_cap:
            raise ValueError(f"class {cl!r} has {n} rows; SMOTE needs more than k={k}")
        if cl in need and n < 2:
            raise ValueError(f"class {cl!r} has {n} row; SMOTE needs a neighbour")
    small = df.where(c(label).isin(list(need)))
    k_eff = {cl: (min(k, counts[cl] - 1) if k_cap else k) for cl in need}
    # k rows per row of the smaller classes; written, so that a lost executor does not repeat the search
    nn = cut_lineage(knn_within_class(small, feats, k=k, label=label, key=key, materialized=True))
    indexed = dense_index(small, label, key, seed, hash_kind)
    # synthetic ids: one range, cut into per-class slices by cumulative offsets
    order = sorted(need, key=str)
    offsets, acc = [], 0
    for cl in order:
        offsets.append((cl, acc, need[cl]))
        acc += need[cl]
    ids = spark.range(acc).withColumnRenamed("id", "_sid")
    cls_expr, n_expr, k_expr = None, None, None
    for cl, start, _cnt in offsets:
        cond = c("_sid") >= start
        cls_expr = F.lit(cl) if cls_expr is None else F.when(cond, F.lit(cl)).otherwise(cls_expr)
        n_expr = F.lit(counts[cl]) if n_expr is None else F.when(cond, F.lit(counts[cl])).otherwise(n_expr)
        k_expr = F.lit(k_eff[cl]) if k_expr is None else F.when(cond, F.lit(k_eff[cl])).otherwise(k_expr)

    def drawn(stream):
        return F.expr(counter_random_sql("_sid", stream))

    syn = (ids.withColumn(label, cls_expr.cast(df.schema[label].dataType))
           .withColumn("_idx", drawn(seed) % n_expr.cast("long"))
           .withColumn("rank", (drawn(seed + 1) % k_expr.cast("long") + 1).cast("int"))
           .withColumn("_u", drawn(seed + 2) % (1 << 20) / float(1 << 20)))
    base = indexed.select(label, "_idx", c(key).alias("_base"), *[c(f).alias(f"_x_{f}") for f in feats])
    syn = syn.join(base, [label, "_idx"])
    nb = nn.select(c(key).alias("_base"), "rank", c(f"neighbor_{key}").alias("_nbk"))
    syn = syn.join(nb, ["_base", "rank"])
    nbf = df.select(c(key).alias("_nbk"), *[c(f).alias(f"_y_{f}") for f in feats])
    syn = syn.join(nbf, "_nbk")
    new_cols = [(c(f"_x_{f}") + c("_u") * (c(f"_y_{f}") - c(f"_x_{f}"))).alias(f) for f in feats]
    # synthetic rows get negative keys (-1, -2, ...): unique, so later hash orders
    # (folds) spread them instead of piling them into one bucket
    synthetic = syn.select((-(c("_sid") + 1)).cast(df.schema[key].dataType).alias(key), label, *new_cols,
                           F.lit(True).alias("is_synthetic"))
    return originals.unionByName(synthetic)


def class_balance(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    b = before.groupBy(label).agg(F.count(F.lit(1)).alias("before"))
    a = after.groupBy(label).agg(F.count(F.lit(1)).alias("after"))
    return b.join(a, label, "full").fillna(0, ["before", "after"])
