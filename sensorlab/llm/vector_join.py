"""Exact metric range join of embeddings (operator 9).

Two vectors link when their cosine reaches ``threshold``, that is when their unit vectors
are at most r = sqrt(2 - 2 * threshold) apart.  Pivots (vectors taken by the order of a hash
of their id) partition the unit vectors into cells of the nearest pivot.  A vector x of cell
i is replicated into a later cell j unless the triangle inequality keeps every vector of j
beyond r: no replica if d(x, p_j) - R_j > r (R_j is the cell's radius) or if x is farther
than r from the plane between p_i and p_j, (d(x, p_j)^2 - d(x, p_i)^2) / (2 d(p_i, p_j)) > r.
Cells then join on their own, in blocks of about ``block`` rows by ``block`` rows, so no task
holds a whole cell.

Equal vectors are one representative with a number of copies.  A block counts the links of
each vector and emits a spanning forest of its links, never its pairs, so groups of
thousands of near copies stay linear.  Components are those of :mod:`sensorlab.llm.graph`.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing
and are components of their own; only vectors of equal length are compared.  Rows with a
null id are dropped.  Rows that repeat an id are separate vectors.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm.graph import components
from sensorlab.llm.storage import written
from sensorlab.session import ship_package

c = F.col

THRESHOLD = 0.95
BLOCK = 2048
MAX_PIVOTS = 1024     # pivots per vector length on the driver; larger cells only get more blocks
SLACK = 1e-9          # on bounds, for rounding; it only adds candidates


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(m: np.ndarray) -> np.ndarray:
    big = np.abs(m).max(axis=1, keepdims=True)      # scaling first keeps tiny and huge values exact
    m = m / big
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ p.T)))


def _by_length(batch):
    """(length, row numbers) for the vector lengths of a batch."""
    lengths = np.array(batch.column(1).value_lengths())
    return [(int(n), np.flatnonzero(lengths == n)) for n in np.unique(lengths)]


def _homes(shared):
    def run(batches):
        pivots = shared.value
        for batch in batches:
            for n, at in _by_length(batch):
                part = batch.take(pa.array(at))
                d = _distances(unit(_matrix(part.column(1))), pivots[n])
                home = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(at), n)), pa.array(home.astype(np.int64)),
                     pa.array(d[np.arange(len(at)), home])], names=["vec_id", "length", "cell", "d"])
    return run


def _part(ids: np.ndarray, parts: np.ndarray, salt: int) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


def _reach(x: np.ndarray, p: np.ndarray, radius: np.ndarray, size: np.ndarray, r: float):
    """(vector, cell) pairs of a block of unit vectors: its own cell and every later cell
    that may hold a vector within r, and whether the cell is its own."""
    between = _distances(p, p)
    between[between == 0] = 1e-300
    d = _distances(x, p)
    home = d.argmin(axis=1)
    k = np.arange(len(x))
    near = d[k, home][:, None]
    plane = (d * d - near * near) / (2 * between[home])
    reach = (plane <= r + SLACK) & (d - radius <= r + SLACK) & (size > 0)
    reach &= np.arange(len(p)) > home[:, None]
    reach[k, home] = True
    at, cell = np.nonzero(reach)
    return at, cell, cell == home[at]


def _probe_counts(shared, r: float):
    def run(batches):
        pivots, radius, size = shared.value
        for batch in batches:
            for n, at in _by_length(batch):
                total = np.zeros(len(pivots[n]), np.int64)
                x = unit(_matrix(batch.take(pa.array(at)).column(1)))
                for lo in range(0, len(x), 1024):
                    total += np.bincount(_reach(x[lo:lo + 1024], pivots[n], radius[n], size[n], r)[1],
                                         minlength=len(total))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), n)), pa.array(np.arange(len(total))),
                                                  pa.array(total)], names=["length", "cell", "k"])
    return run


def _replicas(shared, r: float, block: int):
    """Rows (length, cell, a, b, side, own, vec_id, copies, v) for the tasks (a, b) of a cell:
    side 0 is one of its core block a, side 1 one of its probe block b."""
    def run(batches):
        pivots, radius, size, probes = shared.value
        for batch in batches:
            for n, rows in _by_length(batch):
                cores = np.maximum(1, -(-size[n] // block))
                tests = np.maximum(1, -(-probes[n] // (2 * block)))
                for lo in range(0, len(rows), 256):
                    part = batch.take(pa.array(rows[lo:lo + 256]))
                    ids = part.column(0).to_numpy()
                    at, cell, own = _reach(unit(_matrix(part.column(1))), pivots[n], radius[n], size[n], r)
                    sides = []
                    for side, sel, parts in ((0, np.flatnonzero(own), tests), (1, np.arange(len(at)), cores)):
                        times = parts[cell[sel]]
                        i = np.repeat(sel, times)
                        each = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                        mine = _part(ids[at[i]], (cores if side == 0 else tests)[cell[i]], side)
                        a, b = (mine, each) if side == 0 else (each, mine)
                        sides.append(np.stack([at[i], cell[i], a, b, np.full(len(i), side), own[i]], axis=1))
                    g = np.concatenate(sides).astype(np.int64)
                    for lo2 in range(0, len(g), 4096):
                        h = g[lo2:lo2 + 4096]
                        take = part.take(pa.array(h[:, 0]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(h), n)), *(pa.array(h[:, k]) for k in range(1, 6)),
                             take.column(0), take.column(2), take.column(1)],
                            names=["length", "cell", "a", "b", "side", "own", "vec_id", "copies", "v"])
    return run


def _forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component among the edges (u, v)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, u, label[v])
        np.minimum.at(new, v, label[u])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _join_cell(threshold: float):
    """(u, v, n) rows: n links of u (v null), or a forest edge (u, v) with n 0."""
    def run(table: pa.Table) -> pa.Table:
        side, own = table.column("side").to_numpy(), table.column("own").to_numpy()
        ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
        core, probe = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links = np.zeros(len(ids), np.int64)
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(core) and len(probe):
            x = unit(_matrix(table.column("v").combine_chunks()))
            for lo in range(0, len(probe), 1024):
                q = probe[lo:lo + 1024]
                a, b = np.nonzero(x[core] @ x[q].T >= threshold)
                a, b = core[a], q[b]
                # a pair of this cell's own vectors counts from its smaller id only
                once = (own[b] == 0) | (ids[a] < ids[b])
                a, b = a[once], b[once]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                first.append(a)
                second.append(b)
        a, b = np.concatenate(first), np.concatenate(second)
        seen, name = np.unique(ids[np.r_[a, b]], return_inverse=True)
        root = _forest(len(seen), name[:len(a)], name[len(a):])
        moved = root != np.arange(len(seen))
        some = np.flatnonzero(links)
        return pa.table({"u": pa.array(np.r_[ids[some], seen[moved]], pa.int64()),
                         "v": pa.concat_arrays([pa.nulls(len(some), pa.int64()),
                                                pa.array(seen[root[moved]], pa.int64())]),
                         "n": pa.array(np.r_[links[some], np.zeros(moved.sum(), np.int64)], pa.int64())})
    return run


def vector_join(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    ship_package(spark)
    r = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    v = c(vector_col).cast(f"array<{kind}>")
    rows = vectors.select(c(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null")
    usable = (c("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("v", F.when(F.coalesce(usable, F.lit(False)), c("v")))
    # equal vectors move once per task that holds them (partial aggregation)
    # ids may repeat with other vectors: inside, a vector goes by a number of its own
    known = written(rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"),
                                                                F.count(F.lit(1)).alias("copies"))
                    .select(F.monotonically_increasing_id().alias("vec_id"), "least", "v", "copies"), "vectors")
    reps = known.select("vec_id", "v", "copies")
    counts = {x["n"]: x["k"] for x in reps.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("k")).collect()}
    if not counts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), c("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    pivots = {}
    for n, k in counts.items():
        want = min(MAX_PIVOTS, max(1, -(-k // block)))
        some = (reps.where(F.size("v") == n).orderBy(F.xxhash64("vec_id"), "vec_id").limit(want).select("v").collect())
        pivots[n] = unit(np.array([x["v"] for x in some], dtype=np.float64))
    homes = written(reps.select("vec_id", "v").mapInArrow(
        _homes(spark.sparkContext.broadcast(pivots)), "vec_id long, length long, cell long, d double"), "homes")
    radius = {n: np.zeros(len(p)) for n, p in pivots.items()}
    size = {n: np.zeros(len(p), np.int64) for n, p in pivots.items()}
    for x in homes.groupBy("length", "cell").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("k")).collect():
        radius[x["length"]][x["cell"]], size[x["length"]][x["cell"]] = x["d"], x["k"]
    bounds = spark.sparkContext.broadcast((pivots, radius, size))
    probes = {n: np.zeros(len(p), np.int64) for n, p in pivots.items()}
    for x in (reps.select("vec_id", "v").mapInArrow(_probe_counts(bounds, r), "length long, cell long, k long")
              .groupBy("length", "cell").agg(F.sum("k").alias("k")).collect()):
        probes[x["length"]][x["cell"]] = x["k"]
    plan = spark.sparkContext.broadcast((pivots, radius, size, probes))
    dealt = reps.select("vec_id", "v", "copies").mapInArrow(
        _replicas(plan, r, block), "length long, cell long, a long, b long, side long, own long, vec_id long, "
                                   f"copies long, v array<{kind}>")
    found = written(dealt.groupBy("length", "cell", "a", "b")
                    .applyInArrow(_join_cell(threshold), "u long, v long, n long"), "links")
    links = found.where("v is null").groupBy(c("u").alias("_u")).agg(F.sum("n").alias("links"))
    part = components(found.where("v is not null"), "u", "v")
    joined = written(
        known.join(links, c("vec_id") == c("_u"), "left").join(part, c("vec_id") == c("node"), "left")
        .select(c("v").alias("_v"), "least", (F.coalesce("links", F.lit(0)) + c("copies") - 1).alias("links"),
                F.coalesce("component", "vec_id").alias("_part")), "joined")
    smallest = joined.groupBy(c("_part").alias("_p")).agg(F.min("least").alias("component"))
    per_rep = written(joined.join(smallest, c("_part") == c("_p")).select("_v", "links", "component"), "representatives")
    out = rows.join(per_rep, c("v") == c("_v"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (c("vec_id") == component).alias("kept"))
