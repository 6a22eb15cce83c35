"""The boosters against plain versions: splits, growth order, gradients, cut points, one task against Spark jobs."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sensorlab.operators import boosting as bo
from sensorlab.plans import boosters

FEATURES, BINS = 3, 8


def data(seed=0, n=400, classes=2, missing=0.1):
    rng = np.random.default_rng(seed)
    x = rng.integers(1, BINS, (n, FEATURES)).astype(np.uint8)
    y = ((x[:, 0] > 3) ^ (x[:, 1] > 5)).astype(np.int64) + (x[:, 2] > 6) * (classes > 2)
    y = np.where(rng.random(n) < 0.1, rng.integers(0, classes, n), y % classes)
    x[rng.random((n, FEATURES)) < missing] = 0
    return x, y


def plain_tree(x, g, h, spec, allowed=None):
    """Best-first (or depth by depth) growth by trying every split of every leaf on the rows themselves."""
    def score(a, b):
        return max(abs(a) - spec.alpha, 0) ** 2 / (b + spec.lam + 1e-12)

    def best(rows):
        top = (0.0, None)
        for f in range(x.shape[1]):
            for edge in range(1, BINS - 1):
                for missing_left in ((False, True) if (x[rows, f] == 0).any() else (False,)):
                    v = x[rows, f]
                    left = rows[np.where(v == 0, missing_left, v <= edge)]
                    right = np.setdiff1d(rows, left)
                    if min(len(left), len(right)) < max(1, spec.min_rows) or min(h[left].sum(), h[right].sum()) < spec.min_hessian:
                        continue
                    gain = score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(g[rows].sum(), h[rows].sum())
                    if gain > top[0] + 1e-9:
                        top = (gain, (f, edge, missing_left, left, right))
        return top

    leaves = [(1, 0, np.arange(len(x)), *best(np.arange(len(x))))]
    while spec.leaves == 0 or len(leaves) < spec.leaves:
        open_ = [leaf for leaf in leaves if leaf[4] and (not spec.max_depth or leaf[1] < spec.max_depth)]
        if not open_:
            break
        leaf = max(open_, key=lambda z: (z[3], -z[0]))
        leaves = [z for z in leaves if z[0] != leaf[0]]
        for i, rows in enumerate(leaf[4][3:]):
            leaves.append((2 * leaf[0] + i, leaf[1] + 1, rows, *best(rows)))
    out = np.zeros(len(x))
    for _, _, rows, _, _ in leaves:
        a, b = g[rows].sum(), h[rows].sum()
        out[rows] = -np.sign(a) * max(abs(a) - spec.alpha, 0) / (b + spec.lam + 1e-12) * spec.rate
    return out, len(leaves)


def plain_boost(x, y, spec):
    margins = np.repeat(bo.start_margins(np.bincount(y, minlength=spec.classes).astype(float))[:, None], len(y), axis=1)
    for _ in range(spec.rounds):
        g, h = bo.gradients(margins, y)
        margins = margins + np.stack([plain_tree(x, g[k], h[k], spec)[0] for k in range(spec.trees)])
    return margins


LEAF_WISE = bo.Spec(rounds=3, leaves=6, min_rows=5, alpha=0.3, lam=0.5)
DEPTH_WISE = bo.Spec(rounds=3, leaves=0, max_depth=3, min_rows=1, lam=1.0, rate=0.3, min_hessian=1.0)


@pytest.mark.parametrize("spec", [LEAF_WISE, DEPTH_WISE, bo.Spec(rounds=2, leaves=9, max_depth=4, min_rows=3, classes=3)])
@pytest.mark.parametrize("missing", [0.0, 0.15])
def test_equals_the_plain_version(spec, missing):
    x, y = data(3, 300, spec.classes, missing)
    rows = bo.TaskRows(x, y, np.zeros(len(y)), np.arange(len(y)), [spec], BINS)
    model = bo.boost(rows, [spec], FEATURES)[0]
    want = plain_boost(x, y, spec)
    assert np.allclose(rows.margins[0], want) and np.allclose(model.margins(x), want)
    again = bo.Model.from_dict(model.to_dict())
    assert np.array_equal(again.margins(x), model.margins(x))
    assert model.importance(FEATURES).sum() == pytest.approx(1)


def test_large_histograms_equal_plain_counts():
    rng = np.random.default_rng(4)
    radix = [64, 3, 64, 2, 64, 40, 256, 1]
    x = np.stack([rng.integers(0, r, 3000) for r in radix], axis=1).astype(np.uint8)
    x[0] = np.array(radix) - 1
    groups = bo.feature_groups(radix)
    assert sorted(f for g in groups for f in g) == list(range(len(radix))) and len(groups) < len(radix)
    assert all(math.prod(radix[f] for f in g) <= bo.GROUP_CELLS for g in groups)
    g, h, rows = rng.normal(size=3000), rng.random(3000), np.flatnonzero(rng.random(3000) < 0.4)
    got = bo.LargeHistograms(np.ascontiguousarray(x.T), 256)(rows, g, h)
    for f in range(len(radix)):
        for j, w in enumerate((g, h, np.ones(3000))):
            assert np.array_equal(got[f, :, j], np.bincount(x[rows, f], w[rows], 256))


@pytest.mark.parametrize("large", [1, 40])
@pytest.mark.parametrize("classes", [2, 3])
@pytest.mark.parametrize("missing", [0.0, 0.15])
def test_large_nodes_grow_the_same_trees(monkeypatch, large, classes, missing):
    """Nodes parted and counted one by one against all nodes of a wave at once: equal to the last bit."""
    x, y = data(12, 600, classes, missing)
    share = np.where(np.arange(600) % 6 == 0, math.inf, 0.0)
    specs = [bo.Spec(rounds=4, leaves=9, min_rows=3, subsample=0.7, colsample=0.7, alpha=0.1, classes=classes),
             bo.Spec(rounds=2, leaves=0, max_depth=4, min_rows=2, lam=1.0, classes=classes)]
    got = []
    for limit in (10**9, large):
        monkeypatch.setattr(bo, "LARGE_NODE", limit)
        rows = bo.TaskRows(x, y, share, np.arange(600), specs, BINS)
        models = bo.boost(rows, specs, FEATURES)
        got.append(([m.to_dict() for m in models], [m.margins(x).tolist() for m in models],
                    [m.tolist() for m in rows.margins], [rows.confusions(m) for m in range(len(specs))]))
        assert (rows.large is None) == (limit == 10**9)
    assert got[0] == got[1]


def test_penalties_change_the_tree():
    x, y = data(5)
    fits = []
    for alpha, lam in ((0, 0), (5, 0), (0, 5)):
        spec = bo.Spec(rounds=2, leaves=8, alpha=alpha, lam=lam)
        rows = bo.TaskRows(x, y, np.zeros(len(y)), np.arange(len(y)), [spec], BINS)
        fits.append(bo.boost(rows, [spec], FEATURES)[0].margins(x))
    assert not np.allclose(fits[0], fits[1]) and not np.allclose(fits[0], fits[2])


@pytest.mark.parametrize("classes", [2, 3, 5])
def test_gradients_and_probabilities(classes):
    rng = np.random.default_rng(classes)
    margins, y = rng.normal(size=(1 if classes == 2 else classes, 20)), rng.integers(0, classes, 20)
    p = bo.probabilities(margins)
    assert np.allclose(p.sum(axis=0), 1) and p.shape == (classes, 20)
    g, h = bo.gradients(margins, y)

    def loss(m):
        return -np.log(bo.probabilities(m)[y, np.arange(20)])

    for k in range(len(margins)):
        step = np.zeros_like(margins)
        step[k] = 1e-4
        assert np.allclose(g[k], (loss(margins + step) - loss(margins - step)) / 2e-4, atol=1e-6)
        second = (loss(margins + step) - 2 * loss(margins) + loss(margins - step)) / 1e-8
        assert np.allclose(h[k], second * (1 if classes == 2 else classes / (classes - 1)), atol=1e-5)


def test_waves_keep_the_best_first_order():
    """A deep chain whose gains grow on the way down is followed before the wide part is split."""
    rng = np.random.default_rng(8)
    for seed in range(5):
        x = rng.integers(1, BINS, (200, FEATURES)).astype(np.uint8)
        g, h = rng.normal(size=200) * np.exp(x[:, 0]), np.ones(200)
        spec = bo.Spec(leaves=7, min_rows=1)
        rows = bo.TaskRows(x, np.zeros(200, np.int64), np.zeros(200), np.arange(200), [spec], BINS)
        rows.start([np.zeros(1)])
        rows.begin(0, [(0, 0)])
        rows.g, rows.h = g, h
        (tree, _), = bo.grow(rows, [spec], np.ones((1, FEATURES), bool))
        want, leaves = plain_tree(x, g, h, spec)
        assert np.allclose(tree.margin(x), want) and leaves == sum(f < 0 for f in tree.feature)


def table(spark, x, y, share=None):
    share = np.zeros(len(y)) if share is None else share
    rows = [([None if v == 0 else float(v) for v in r], int(k), i, float(s)) for i, (r, k, s) in enumerate(zip(x, y, share))]
    df = spark.createDataFrame(rows, "raw array<double>, code int, key long, share double")
    return df.withColumn("features", F.transform("raw", lambda v: F.coalesce(v, F.lit(float("nan")))))


EDGES = [[float(v) for v in range(1, BINS - 1)]] * FEATURES


def test_spark_jobs_and_one_task_grow_the_same_trees(spark):
    x, y = data(7, 500, 3)
    share = np.where(np.arange(500) % 5 == 0, math.inf, (np.arange(500) % 97) / 97)
    other = np.where(np.arange(500) % 5 == 1, math.inf, 0.0)
    df = table(spark, x, y, share).repartition(3)
    two = table(spark, x, y, other).repartition(2)
    blocks = boosters.pack(df, EDGES, 0, F.col("share")).union(boosters.pack(two, EDGES, 1, F.col("share"))).cache()
    specs = [bo.Spec(rounds=2, leaves=5, classes=3, subsample=0.7, colsample=0.7, share=0.5),
             bo.Spec(rounds=3, leaves=0, max_depth=2, classes=3, lam=1.0, fold=1), bo.Spec(rounds=1, leaves=4, classes=3, fold=1)]
    near = boosters.train(blocks, specs, FEATURES, BINS, models=True)
    far = boosters.train(blocks, specs, FEATURES, BINS, models=True, task_rows=0)
    for a, b in zip(near, far):
        assert a.confusion == b.confusion and sum(a.confusion.values()) == 500
        for p, q in zip(sum(a.model.rounds, []), sum(b.model.rounds, [])):
            assert (p.feature, p.bin, p.missing_left, p.left) == (q.feature, q.bin, q.missing_left, q.left)
            assert np.allclose(p.value, q.value)
    assert sum(v for k, v in near[0].confusion.items() if k[0]) == int((share < 0.5).sum())


def test_weighted_cut_points(spark):
    rng = np.random.default_rng(2)
    values, weights = np.round(rng.normal(size=3000), 2), rng.random(3000)
    df = spark.createDataFrame([([float(v), float("nan") if i % 3 else float(v)], float(w))
                                for i, (v, w) in enumerate(zip(values, weights))], "f array<double>, w double").repartition(7)
    cuts = boosters.weighted_cuts(df, "f", F.col("w"), 2, 17)
    for mine, known in ((0, np.ones(3000, bool)), (1, np.arange(3000) % 3 == 0)):
        v, w = values[known], weights[known]
        below = [w[v <= e].sum() / w.sum() for e in cuts[mine]]
        assert len(below) >= 14 and all(min(abs(b - i / 16) for i in range(1, 16)) < 0.02 for b in below)
    plain = boosters.quantile_cuts(df, "f", 2, 17)
    assert all(abs((values <= e).mean() - i / 16) < 0.01 for i, e in enumerate(plain[0], 1))


def test_cut_points_of_odd_columns(spark):
    df = spark.createDataFrame([([float("nan"), 1.0],), ([float("nan"), 1.0],)], "f array<double>")
    assert boosters.quantile_cuts(df, "f", 2, 8) == [[], [1.0]]
    assert boosters.weighted_cuts(df, "f", F.lit(1.0), 2, 8) == [[], [1.0]]
    assert boosters.binned(np.array([[np.nan, 0.5], [2.0, 3.0]]), [[], [1.0]]).tolist() == [[0, 1], [1, 2]]


@pytest.mark.parametrize("classes, weighted", [(2, True), (3, False)])
def test_stage_saves_and_scores(spark, tmp_path, classes, weighted):
    x, y = data(9, 300, classes)
    df = table(spark, x, y).select(array_to_vector("features").alias("features"), F.col("code").alias("label"),
                                   F.col("key").alias("udi"))
    spec = bo.Spec(rounds=4, leaves=6, min_rows=5, classes=classes)
    model = boosters.Booster(spec, weighted=weighted, bins=BINS).fit(df)
    path = str(tmp_path / "model")
    PipelineModel(stages=[model]).write().save(path)
    again = PipelineModel.load(path)
    got, back = (m.transform(df).orderBy("udi").collect() for m in (model, again))
    assert [r["probability"] for r in got] == [r["probability"] for r in back]
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and r["prediction"] == int(np.argmax(r["probability"])) for r in got)
    assert np.mean([r["prediction"] == r["label"] for r in got]) > 0.7
    assert len(model.featureImportances) == FEATURES


def test_parameters_of_the_search_space_all_reach_the_booster():
    from sensorlab.plans import models

    combo = {"n_estimators": 300, "max_depth": -1, "learning_rate": 0.05, "colsample_bytree": 0.6, "subsample": 0.7,
             "min_child_samples": 30, "reg_alpha": 0.5, "reg_lambda": 1.0}
    assert set(combo) == set(models.PARAM_GRID)
    spec = models.booster_spec(models.LEAFWISE, 5, combo)
    assert spec == bo.Spec(rounds=300, max_depth=0, rate=0.05, colsample=0.6, subsample=0.7, min_rows=30, alpha=0.5,
                           lam=1.0, leaves=31, classes=5, seed=models.SEED)


def test_rows_of_a_table_are_not_written_every_round(spark, monkeypatch):
    """More rounds than the cache holds unwritten: the models are those of one task, and the blocks are
    never written as a table again."""
    rng = np.random.default_rng(12)
    data = [([float(v) for v in rng.normal(size=3)], int(rng.integers(0, 3)), i) for i in range(900)]
    df = spark.createDataFrame(data, "features array<double>, code int, key long").repartition(3)
    blocks = boosters.pack(df, boosters.quantile_cuts(df, "features", 3)).cache()
    specs = [bo.Spec(rounds=boosters.WRITTEN_ROUNDS + 3, leaves=5, classes=3)]
    one = boosters.train(blocks, specs, 3, models=True)[0]
    writes = []
    monkeypatch.setattr(boosters, "cut_lineage", lambda df: (writes.append(1), df)[1])
    monkeypatch.setattr(boosters, "DIRECT_BYTES", 0)
    added = boosters.train(blocks, specs, 3, models=True, task_rows=0)[0]
    monkeypatch.setattr(boosters, "DIRECT_BYTES", 1 << 40)
    direct = boosters.train(blocks, specs, 3, models=True, task_rows=0)[0]
    shape = lambda f: [[(t.feature, t.bin) for t in trees] for trees in f.model.rounds]
    assert shape(one) == shape(added) == shape(direct)
    assert one.confusion == added.confusion == direct.confusion
    assert not writes


def test_a_fold_of_750_000_rows_needs_no_job_per_wave(spark, monkeypatch):
    """F16, F17: one short job per wave of nodes took longer than the trees."""
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 5)], i % 2) for i in range(100)],
                                 "key long, features array<double>, code int")
    blocks = boosters.pack(rows, boosters.quantile_cuts(rows, "features", 2))
    blocks = blocks.withColumn("rows", F.lit(750_000 // blocks.count()).cast("long"))      # as if they held as many
    monkeypatch.setattr(boosters, "SparkRows", None)
    fitted = boosters.train(blocks, [bo.Spec(rounds=2, min_rows=1)], 2)
    assert sum(fitted[0].confusion.values()) == 100


@pytest.mark.parametrize("classes, subsample", [(2, 1.0), (2, 0.6), (3, 1.0)])
def test_the_smaller_side_is_counted_and_scored_rows_stay_apart(spark, monkeypatch, classes, subsample):
    """F2, F3, F9 to F18: jobs read no rows that nothing is learned from, and count the side with fewer rows."""
    x, y = data(21, 700, classes)
    share = np.where(np.arange(700) >= 500, math.inf, 0.0)
    blocks = boosters.pack(table(spark, x[:500], y[:500]).repartition(2), EDGES).union(
        boosters.pack(table(spark, x[500:], y[500:], share[500:]), EDGES, 0, F.col("share"))).cache()
    specs = [bo.Spec(rounds=3, leaves=8, min_rows=5, classes=classes, subsample=subsample)]
    counted = []
    sums = boosters.SparkRows._sums

    def seen(self, requests):
        out = sums(self, requests)
        counted.append((requests, out[:, 0, :, 2].sum(axis=1)))
        return out

    monkeypatch.setattr(boosters.SparkRows, "_sums", seen)
    monkeypatch.setattr(boosters, "TREES_AT_ONCE", 2)
    near = boosters.train(blocks, specs, FEATURES, BINS, models=True)[0]
    far = boosters.train(blocks, specs, FEATURES, BINS, models=True, task_rows=0)[0]
    assert near.confusion == far.confusion and sum(far.confusion.values()) == 700
    assert [[(t.feature, t.bin) for t in r] for r in near.model.rounds] == [[(t.feature, t.bin) for t in r] for r in far.model.rounds]
    whole = 500 if subsample == 1 else None
    for requests, rows in counted:
        if requests[0][1] == 1:
            root = rows
            assert whole is None or (rows == whole).all()
        else:
            assert all(n <= root[t] / 2 for (t, _), n in zip(requests, rows))


@pytest.mark.parametrize("classes", [2, 3])
@pytest.mark.parametrize("missing", [0.0, 0.15])
def test_records_of_a_task_grow_the_trees_of_spark_jobs(spark, monkeypatch, classes, missing):
    """folds of more than ``TASK_ROWS`` rows went through a job per wave even with a model per core.
    Nodes of 30 rows have no empty bins, whose splits would tie."""
    x, y = data(23, 900, classes, missing)
    share = np.where(np.arange(900) >= 600, math.inf, (np.arange(900) % 89) / 89)
    blocks = boosters.pack(table(spark, x[:600], y[:600], share[:600]).repartition(3), EDGES, 0, F.col("share"))
    for fold in (0, 1):
        blocks = blocks.union(boosters.pack(table(spark, x[600:], y[600:], share[600:]), EDGES, fold, F.col("share")))
    blocks = blocks.union(boosters.pack(table(spark, x[:400], y[:400]), EDGES, 1)).cache()
    specs = [bo.Spec(rounds=3, leaves=6, min_rows=30, classes=classes, share=s, subsample=b) for s, b in ((1.0, 1.0), (0.4, 0.7))]
    specs += [bo.Spec(rounds=2, leaves=0, max_depth=3, min_rows=30, lam=1.0, classes=classes, fold=1)]
    want = boosters.train(blocks, specs, FEATURES, BINS, models=True, task_rows=0)
    with monkeypatch.context() as m:
        m.setattr(boosters, "SparkRows", None)
        m.setattr(boosters, "JOINED_ROWS", 250)
        got = boosters.train(blocks, specs, FEATURES, BINS, models=True, task_rows=1)
    for a, b in zip(want, got):
        assert a.confusion == b.confusion and sum(a.confusion.values()) == (900 if a.spec.fold == 0 else 700)
        for p, q in zip(sum(a.model.rounds, []), sum(b.model.rounds, [])):
            assert (p.feature, p.bin, p.missing_left, p.left) == (q.feature, q.bin, q.missing_left, q.left)
            assert np.allclose(p.value, q.value)


def test_large_folds_go_to_tasks_only_if_they_fit(spark, monkeypatch):
    x, y = data(24, 300)
    blocks = boosters.pack(table(spark, x, y), EDGES).cache()
    used = []
    for name in ("_one_by_one", "SparkRows"):
        real = getattr(boosters, name)
        monkeypatch.setattr(boosters, name, lambda *a, name=name, real=real: (used.append(name), real(*a))[1])
    specs = [bo.Spec(rounds=1, leaves=3)] * 2
    monkeypatch.setattr(boosters, "JOBS_COST", 4)                       # four cores
    boosters.train(blocks, specs, FEATURES, BINS, task_rows=1)
    boosters.train(blocks, specs[:1], FEATURES, BINS, task_rows=1)      # one model would leave three cores idle
    monkeypatch.setattr(boosters, "TASK_BYTES", 300)
    boosters.train(blocks, specs, FEATURES, BINS, task_rows=1)
    assert used == ["_one_by_one", "SparkRows", "SparkRows"]
