"""Model properties: better than the majority baseline, same predictions after reload."""

import pytest
from pyspark.sql import functions as F

from sensorlab.operators import evaluate
from sensorlab.plans import models, preprocess
from sensorlab.plans.catalog_sql import unique_featured
from tests.conftest import SF_MED


@pytest.fixture(scope="module")
def setup(spark):
    feats = unique_featured(spark, SF_MED).cache()
    prep = preprocess.preprocess_pipeline(feats, "binary")
    return feats, prep


def test_tree_beats_majority_and_reloads(spark, setup, tmp_path):
    feats, prep = setup
    b = models.fit_bundle(prep, "Decision Tree", "binary")
    test_rows = models.test_features(feats, prep)
    scored = models.score(b, test_rows).cache()
    acc = evaluate.metrics_binary(scored).first()["accuracy"]
    counts = [r["count"] for r in scored.groupBy("label").count().collect()]
    assert acc > max(counts) / sum(counts)
    path = str(tmp_path / "bundle")
    models.save_bundle(b, path)
    again = models.load_bundle([str(tmp_path / "missing"), path], "binary")
    s2 = models.score(again, test_rows)
    a = sorted((r["udi"], r["prediction"]) for r in scored.collect())
    c = sorted((r["udi"], r["prediction"]) for r in s2.collect())
    assert a == c


def test_param_sampling_is_without_replacement():
    combos = models.sample_params(50, 42)
    assert models.grid_size() == 562_500
    assert len({tuple(sorted(c.items())) for c in combos}) == 50


def test_feature_importance_flags(spark, setup):
    _, prep = setup
    b = models.fit_bundle(prep, "Decision Tree", "binary")
    imp = models.feature_importance(b).collect()
    assert len(imp) == len(preprocess.NUMERIC_FEATURES)
    assert sum(r["is_top3"] for r in imp) == 3
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0, abs=1e-6)


def test_importance_of_a_multinomial_model(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IndexToString, VectorAssembler

    from sensorlab.plans import models
    rows = [(float(i % 3), float(i % 3 == 0), float(i % 3 == 1), float(i % 7)) for i in range(60)]
    df = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(
        spark.createDataFrame(rows, "label double, x double, y double, z double"))
    clf = LogisticRegression(family="multinomial").fit(df)
    bundle = models.Bundle("lr", "multiclass", PipelineModel(stages=[
        IndexToString(inputCol="a", outputCol="b", labels=["x"]),
        IndexToString(inputCol="a", outputCol="b", labels=["x"]), clf]))
    got = models.feature_importance(bundle, ["x", "y", "z"]).collect()
    assert abs(sum(r.importance for r in got) - 1) < 1e-9 and {r.feature for r in got if r["rank"] < 3} == {"x", "y"}


def test_damaged_bundle_is_not_skipped(spark, tmp_path):
    import pytest

    from sensorlab.plans import models
    (tmp_path / "tuned").mkdir()
    with pytest.raises(Exception) as error:
        models.load_bundle([str(tmp_path / "tuned"), str(tmp_path / "none")])
    assert not isinstance(error.value, FileNotFoundError)
    with pytest.raises(FileNotFoundError):
        models.load_bundle([str(tmp_path / "none")])


def test_unscored_failure_is_a_miss(spark):
    from sensorlab.operators import evaluate
    df = spark.createDataFrame([(1, 1), (1, None), (0, None), (0, 1)], "label int, prediction int")
    r = evaluate.binary_counts(df).first()
    assert (r.tp, r.fn, r.tn, r.fp) == (1, 1, 1, 1)


@pytest.fixture(scope="module")
def setup_mc(spark):
    return preprocess.preprocess_pipeline(unique_featured(spark, SF_MED), "multiclass")


def test_comparison_is_ordered_by_f1_on_both_tasks(setup, setup_mc):
    names = ["Logistic Regression", "Decision Tree"]
    for prep, task in [(setup[1], "binary"), (setup_mc, "multiclass")]:
        table, bundles = models.compare_models(prep, task, names=names)
        rows = table.orderBy("rank").collect()
        assert {r["model"] for r in rows} == set(names) == set(bundles)
        assert rows[0]["f1"] >= rows[1]["f1"] > 0.3
        assert all((r["roc_auc"] is None) == (task == "multiclass") for r in rows)


def test_prepared_and_raw_scoring_agree(setup):
    feats, prep = setup
    b = models.fit_bundle(prep, "Decision Tree", "binary")
    raw = {r["udi"]: r["prediction"] for r in models.score(b, models.test_features(feats, prep)).collect()}
    scaled = {r["udi"]: r["prediction"] for r in models.score_prepared(b, prep.test).collect()}
    assert raw == scaled


@pytest.mark.parametrize("name", ["Gradient Boosting", models.DEPTHWISE, models.LEAFWISE])
def test_boosters_on_both_tasks(setup, setup_mc, name):
    for prep, task in [(setup[1], "binary"), (setup_mc, "multiclass")]:
        b = models.fit_bundle(prep, name, task, {"maxIter": 2})
        scored = models.score_prepared(b, prep.test)
        assert evaluate.metrics_weighted(scored).first()["f1"] > 0.4
        assert len(models.feature_importance(b).collect()) == len(preprocess.NUMERIC_FEATURES)


def test_forest_beats_majority(setup):
    _, prep = setup
    b = models.fit_bundle(prep, "Random Forest", "binary")
    acc = evaluate.metrics_binary(models.score_prepared(b, prep.test)).first()["accuracy"]
    majority = prep.test.groupBy("label").count().agg(F.max("count")).first()[0] / prep.test.count()
    assert acc > majority


def test_folds_keep_synthetic_rows_out_of_validation(setup):
    _, prep = setup
    for tr, va in models._fold_sets(prep, 2, False, 42):
        counts = [r["count"] for r in tr.groupBy("label").count().collect()]
        assert len(set(counts)) == 1                       # oversampled inside the fold
        assert va.where(F.col("udi") < 0).count() == 0     # synthetic keys are negative
        assert tr.join(va, "udi").count() == 0


def test_learning_curve_and_cv_score(setup):
    _, prep = setup
    params = {"maxIter": 2, "maxDepth": 3}
    curve = models.learning_curve(prep, "binary", params, sizes=(0.25, 1.0), folds=2).collect()
    assert [r["fraction"] for r in curve] == [0.25, 1.0]
    assert abs(curve[0]["train_rows"] * 4 - curve[1]["train_rows"]) <= 8  # exact per class
    cv = {r["item"]: r["f1_weighted"] for r in models.cross_val_score(prep, "binary", params, folds=2).collect()}
    assert set(cv) == {"fold_0", "fold_1", "mean", "std"}
    assert cv["mean"] == pytest.approx((cv["fold_0"] + cv["fold_1"]) / 2)


def test_search_tries_every_draw(setup, monkeypatch):
    _, prep = setup
    monkeypatch.setitem(models.PARAM_GRID, "n_estimators", [1, 2])
    monkeypatch.setitem(models.PARAM_GRID, "max_depth", [2, 3])
    result = models.random_search(prep, "binary", n_iter=3, folds=2)
    rows = result.cv_results.collect()
    assert len(rows) == 3
    top = models.cv_results(result).orderBy("rank").first()
    assert top["mean_test_score"] == max(r["mean_test_score"] for r in rows)
    assert models.to_gbt_params({**models.sample_params(1)[0], "max_depth": -1})["maxDepth"] == 30
