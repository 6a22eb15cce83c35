"""Registered model queries.  Model output cannot be reproduced by SQL, so
these have no oracle entry, but for the keys of scoring and reloading;
``tests/test_models.py`` holds property tests.

The search queries are in :mod:`sensorlab.plans.catalog_tuning`, imported last.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from sensorlab.plans import models, preprocess
from sensorlab.plans.catalog_sampling import _PREP_SQL as PREP_SQL
from sensorlab.plans.catalog_sql import unique_featured
from sensorlab.plans.registry import register
from sensorlab.session import app_id, cut_lineage

c = F.col


# Registered model queries share their expensive inputs within one Spark application:
# the prepared (checkpointed) training data, fitted bundles and search results are
# computed once per (application, sf folder) and reused by the queries that need them.
_MEMO: dict = {}


def _memo(s, sf, key, fn):
    k = (app_id(s), sf, key)
    if k not in _MEMO:
        _MEMO[k] = fn()
    return _MEMO[k]


def _prep(s, sf, task="binary"):
    def build():
        feats = unique_featured(s, sf)
        return feats, preprocess.preprocess_pipeline(feats, task, hash_kind="arith")
    return _memo(s, sf, ("prep", task), build)


def _bundle(s, sf, name, task="binary"):
    return _memo(s, sf, ("bundle", name, task),
                 lambda: models.fit_bundle(_prep(s, sf, task)[1], name, task))


def _scored(s, sf, name, task="binary"):
    feats, prep = _prep(s, sf, task)
    return models.score(_bundle(s, sf, name, task), models.test_features(feats, prep))


for _id, _name in [("clf_logistic", "Logistic Regression"), ("clf_tree", "Decision Tree"),
                   ("clf_forest", "Random Forest"), ("clf_gbt", "Gradient Boosting"),
                   ("clf_gbt_depthwise", models.DEPTHWISE), ("clf_gbt_leafwise", models.LEAFWISE)]:
    register(_id)(lambda s, sf, _n=_name: _scored(s, sf, _n))

for _id, _name in [("clf_multiclass_gbt", "Gradient Boosting"), ("clf_multiclass_depthwise", models.DEPTHWISE),
                   ("clf_multiclass_boosting", models.LEAFWISE)]:
    register(_id)(lambda s, sf, _n=_name: _scored(s, sf, _n, "multiclass"))


def _compare(s, sf):
    table, _ = models.compare_models(_prep(s, sf)[1], "binary",
                                     fit=lambda p, name, task: _bundle(s, sf, name, task))
    return table


register("compare_models")(_compare)


for _id, _task in [("feature_importance", "binary"), ("feature_importance_multiclass", "multiclass")]:
    register(_id)(lambda s, sf, _t=_task: models.feature_importance(_bundle(s, sf, models.LEAFWISE, _t)))


def both_tasks(part):
    """Union of ``part(task)`` over both tasks with a ``task`` column."""
    binary, multi = (part(t).withColumn("task", F.lit(t)) for t in ("binary", "multiclass"))
    return binary.unionByName(multi)


# Curve and CV score of the default booster, whole (8 sizes x 3 folds; 5 folds).  The tuned
# ones take ``params=models.to_gbt_params(result.best_params)``; see catalog_tuning.
register("learning_curve")(lambda s, sf: both_tasks(lambda t: models.learning_curve(_prep(s, sf, t)[1], t)))
register("cross_val_score")(lambda s, sf: both_tasks(lambda t: models.cross_val_score(_prep(s, sf, t)[1], t)))


def _bundle_path(s, sf, name):
    from sensorlab.session import checkpoint_dir
    tag = hashlib.sha1(f"{app_id(s)}:{sf}".encode()).hexdigest()[:10]
    return f"{checkpoint_dir(s).rstrip('/')}/bundles/{name}-{tag}"


def _batch(s, sf):
    feats, prep = _prep(s, sf)
    bundle = _bundle(s, sf, models.LEAFWISE, "binary")
    path = _bundle_path(s, sf, "binary")
    models.save_bundle(bundle, path)
    loaded = models.load_bundle([path + "-tuned", path], "binary")
    return models.score(loaded, feats)


register("batch_score")(_batch)
register("batch_score_unscored", """
SELECT udi, CAST(target AS INT) AS label, machine_type IS NULL AS unscored FROM ufeat""")(
    lambda s, sf: cut_lineage(_batch(s, sf)).select("udi", "label", c("prediction").isNull().alias("unscored")))


def _save_load(s, sf):
    """Predictions on the test split before and after a save / load round trip."""
    feats, prep = _prep(s, sf)
    bundle = _bundle(s, sf, "Decision Tree", "binary")
    path = _bundle_path(s, sf, "tree")
    models.save_bundle(bundle, path)
    loaded = models.load_bundle([path + "-tuned", path], "binary")
    test_rows = models.test_features(feats, prep)
    before = models.score(bundle, test_rows).select("udi", c("prediction").alias("prediction_before"))
    after = models.score(loaded, test_rows).select("udi", c("prediction").alias("prediction_after"))
    return before.join(after, "udi").select(
        "udi", c("prediction_before").eqNullSafe(c("prediction_after")).alias("same"))


register("save_load_model", f"WITH {PREP_SQL} SELECT udi, TRUE AS same FROM s WHERE is_test")(_save_load)


def _compare_mc(s, sf):
    table, _ = models.compare_models(_prep(s, sf, "multiclass")[1], "multiclass",
                                     fit=lambda p, name, task: _bundle(s, sf, name, task))
    return table


register("compare_models_multiclass")(_compare_mc)


def _importance_split(s, sf):
    imp = models.feature_importance(_bundle(s, sf, models.LEAFWISE, "binary"))
    return imp.groupBy("is_engineered").agg(F.sum("importance").alias("importance"),
                                            F.count(F.lit(1)).alias("features"))


register("dash_importance_split")(_importance_split)
