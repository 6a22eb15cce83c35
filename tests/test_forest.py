"""The forest against plain versions: splits, one task against Spark jobs, scores, reload."""

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sensorlab.operators import forest as fo
from sensorlab.plans import boosters, forests, models

FEATURES, BINS = 3, 8


def data(seed=0, n=300, classes=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, BINS, (n, FEATURES)).astype(np.uint8)
    y = ((x[:, 0] > 3).astype(int) ^ (x[:, 1] > 5)) + (x[:, 2] > 6) * (classes > 2)
    return x, np.where(rng.random(n) < 0.2, rng.integers(0, classes, n), y % classes)


def plain(x, y, w, spec, tree, path=1, depth=0):
    """Class counts of each row's leaf by trying every split of every node on the rows themselves."""
    def purity(rows):
        counts = np.bincount(y[rows], w[rows], spec.classes)
        return (counts ** 2).sum() / max(counts.sum(), 1)

    def run(rows, path, depth):
        counts = np.bincount(y[rows], w[rows], spec.classes)
        best = (1e-9, None)
        if depth < spec.max_depth and (counts > 0).sum() > 1:
            for f in fo.node_features(np.array([path]), spec, tree, x.shape[1])[0]:
                for edge in range(spec.bins - 1):
                    left, right = rows[x[rows, f] <= edge], rows[x[rows, f] > edge]
                    if len(left) and len(right) and purity(left) + purity(right) - purity(rows) > best[0] + 1e-9:
                        best = (purity(left) + purity(right) - purity(rows), left, right)
        if best[1] is None:
            out[rows] = counts
            return
        run(best[1], 2 * path, depth + 1)
        run(best[2], 2 * path + 1, depth + 1)

    out = np.zeros((len(y), spec.classes))
    run(np.arange(len(y)), path, depth)
    return out


@pytest.mark.parametrize("subset, depth, cells", [(3, 30, 1 << 21), (2, 30, 100), (2, 4, 1 << 21)])
def test_grown_tree_is_the_plain_one(monkeypatch, subset, depth, cells):
    monkeypatch.setattr(fo, "CELLS", cells)                # also with a few nodes at a time
    x, y = data()
    spec = fo.Spec(max_depth=depth, subset=subset, classes=3, bins=BINS)
    w = fo.bootstrap(np.arange(len(y)), 42, 7)
    x, y, w = x[w > 0], y[w > 0], w[w > 0]
    tree = fo.grow(x, y, w, spec, 7)
    assert (tree.counts[tree.leaf_of(x)] == plain(x, y, w, spec, 7)).all()


def test_bootstrap_draws_as_many_rows_as_there_are():
    w = fo.bootstrap(np.arange(-50_000, 50_000), 42, 3)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert (w != fo.bootstrap(np.arange(-50_000, 50_000), 42, 4)).any()


def table(spark, classes=3, n=300):
    x, y = data(n=n, classes=classes)
    rows = [(int(i), [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "udi long, a array<double>, label int").select(
        "udi", "label", array_to_vector("a").alias("features")).repartition(3)


def test_scores_do_not_depend_on_where_nodes_are_split(spark):
    rows = table(spark)
    want = None
    for task_rows in (1_000, 60):
        model = forests.Forest(3, trees=4, bins=BINS, task_rows=task_rows).fit(rows)
        assert model.pieces.count() == 4 if task_rows == 1_000 else model.pieces.count() > 12
        got = ({r["udi"]: (r["p"], r["prediction"]) for r in model.transform(rows).select(
            "udi", vector_to_array("probability").alias("p"), "prediction").collect()}, model.featureImportances.toArray())
        want = want or got
        assert got[0] == want[0] and len(got[0]) == 300
        assert np.allclose(got[1], want[1]) and abs(got[1].sum() - 1) < 1e-9


def test_probability_is_the_mean_leaf_share(spark, tmp_path):
    rows = table(spark)
    model = forests.Forest(3, trees=4, bins=BINS).fit(rows)
    cuts = json.loads(model.getOrDefault(model.fitted))["cuts"]
    keyed = rows.withColumn("a", vector_to_array("features")).select("udi", "label", "a", F.xxhash64("udi", "a").alias("key")).collect()
    x = boosters.binned(np.array([r["a"] for r in keyed]), cuts)
    y, keys = np.array([r["label"] for r in keyed]), np.array([r["key"] for r in keyed])
    share = np.zeros((len(y), 3))
    for t in range(4):
        w = fo.bootstrap(keys, 42, t)
        tree = fo.grow(x[w > 0], y[w > 0], w[w > 0], fo.Spec(subset=2, classes=3, bins=BINS), t)
        leaf = tree.counts[tree.leaf_of(x)]
        share += leaf / leaf.sum(axis=1, keepdims=True) / 4
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        got = {r["udi"]: r for r in m.transform(rows).collect()}
        for i, r in enumerate(keyed):
            assert np.allclose(got[r["udi"]]["probability"].toArray(), share[i], atol=1e-8)
            assert got[r["udi"]]["prediction"] == got[r["udi"]]["probability"].toArray().argmax()


def test_a_forest_of_30_levels_needs_no_job_per_level(spark):
    """F14, F16, F17: one pass over all rows per level grew with the levels."""
    rows = table(spark, classes=2, n=2_000)
    rows = rows.withColumn("features", array_to_vector(F.array(*[F.rand(f) for f in range(10)]))).withColumn(
        "label", F.when(F.rand(20) < 0.5, 0).otherwise(1)).localCheckpoint()
    sc = spark.sparkContext
    sc.setJobGroup("forest_jobs", "fit")
    try:
        models.make_classifier("Random Forest", "binary", 2_000, "label").fit(rows)
        jobs = len(sc.statusTracker().getJobIdsForGroup("forest_jobs"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 12
