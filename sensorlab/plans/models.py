"""Training, comparison, tuning and scoring with Spark ML.

Estimators are MLlib's distributed ones (tree learners aggregate split statistics per
partition, logistic regression aggregates gradients with treeAggregate) and the boosters of
:mod:`sensorlab.plans.boosters` and the forest of :mod:`sensorlab.plans.forests`, so training scales with the cluster.  A fitted *bundle* is one ``PipelineModel``: a SQL stage that
encodes and scales raw feature-view columns, the vector assembler, the classifier and,
for failure types, the label decoder.  It is saved and loaded with Spark ML's writer.

Metric values come from the distributed aggregates of :mod:`sensorlab.operators.evaluate`;
only the per-model metric rows (a handful of numbers) are brought to the driver.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlab.operators import boosting, evaluate, sampling
from sensorlab.plans import boosters, forests
from sensorlab.plans.preprocess import NUMERIC_FEATURES, Prepared
from sensorlab.schema import ENGINEERED, MACHINE_TYPE_CODES
from sensorlab.session import cut_lineage

c = F.col
SEED = 42

# Names of the six compared models; the two boosters Spark does not have are our own.
DEPTHWISE, LEAFWISE = "Depth-wise Boosting", "Leaf-wise Boosting"
MODEL_NAMES = ["Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting",
               DEPTHWISE, LEAFWISE]
# Statistics of one tree level fit one pass up to this much memory (deep levels otherwise
# take several passes over the rows).
TREE_MEMORY_MB = 1024
# Training rows per task: a fit makes one job per tree level, so small inputs use few tasks.
ROWS_PER_FIT_TASK = 50_000


# Defaults of the boosted models: exact depth-3 trees; depth-wise second-order trees; leaf-wise trees.
BOOSTERS = {
    "Gradient Boosting": boosting.Spec(rounds=100, rate=0.1, max_depth=3, leaves=0, min_rows=1, min_hessian=0.0),
    DEPTHWISE: boosting.Spec(rounds=100, rate=0.3, max_depth=6, leaves=0, min_rows=1, min_hessian=1.0, lam=1.0),
    LEAFWISE: boosting.Spec(rounds=100, rate=0.1, max_depth=0, leaves=31, min_rows=20),
}
# Other names of a booster's parameters: those of the search space and those of Spark's GBT.
ALIASES = {"n_estimators": "rounds", "learning_rate": "rate", "min_child_samples": "min_rows", "reg_alpha": "alpha",
           "reg_lambda": "lam", "colsample_bytree": "colsample", "maxIter": "rounds", "stepSize": "rate",
           "maxDepth": "max_depth", "subsamplingRate": "subsample", "minInstancesPerNode": "min_rows",
           "featureSubsetStrategy": "colsample"}


def booster_spec(name: str, classes: int = 2, params: dict | None = None) -> boosting.Spec:
    """A booster's parameters; ``max_depth`` below 1 is no limit."""
    given = {ALIASES.get(k, k): v for k, v in (params or {}).items()}
    if "colsample" in given:
        given["colsample"] = 1.0 if given["colsample"] == "all" else float(given["colsample"])
    if "max_depth" in given:
        given["max_depth"] = max(0, given["max_depth"])
    return replace(BOOSTERS[name], classes=classes, seed=SEED, **given)


def make_classifier(name: str, task: str, n_train: int, label_col: str, params: dict | None = None, classes: int = 2):
    """Estimator for a model name, library defaults of the reference's models.

    Binary gradient boosting is Spark's; the depth-wise and leaf-wise boosters and all
    boosters of failure types (softmax, one tree per class and round) are our own."""
    p = dict(params or {})
    common = {"featuresCol": "features", "labelCol": label_col}
    if name == "Logistic Regression":
        # L2 with C = 1 on a summed loss == regParam 1/n on Spark's mean loss
        return LogisticRegression(maxIter=1000, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                  standardization=False, **common)
    if name == "Decision Tree":
        return DecisionTreeClassifier(maxDepth=30, maxMemoryInMB=TREE_MEMORY_MB, seed=SEED, **common)
    if name == "Random Forest":
        return forests.Forest(classes, label_col, trees=100, max_depth=30, seed=SEED)
    if name == "Gradient Boosting" and task == "binary":
        return GBTClassifier(seed=SEED, maxMemoryInMB=TREE_MEMORY_MB, **{**dict(maxIter=100, stepSize=0.1, maxDepth=3), **p},
                             **common)
    if name in BOOSTERS:
        return boosters.Booster(booster_spec(name, classes, p), label_col, weighted=name == DEPTHWISE)
    raise ValueError(f"unknown model {name!r}")


def _encode_scale_sql(prep: Prepared) -> str:
    """SQL stage: raw feature-view columns → encoded and scaled model inputs."""
    mt = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MACHINE_TYPE_CODES.items())
    wc = " ".join(f"WHEN '{k}' THEN {v}" for k, v in prep.wear_codes.items())
    raw = {"machine_type": f"CAST(CASE upper(machine_type) {mt} END AS DOUBLE)",
           "wear_category": f"CAST(CASE wear_category {wc} END AS DOUBLE)"}
    cols = []
    for f in NUMERIC_FEATURES:
        x = raw.get(f, f"CAST({f} AS DOUBLE)")
        m, s = prep.scaler.means[f], prep.scaler.stds[f]
        cols.append(f"({x} - {m!r}) / {s!r} AS f_{f}")
    return "SELECT *, " + ", ".join(cols) + " FROM __THIS__"


@dataclass
class Bundle:
    name: str
    task: str
    model: PipelineModel          # scores feature-view rows
    labels: list = field(default_factory=list)

    def transform(self, features_df: DataFrame) -> DataFrame:
        return self.model.transform(features_df)


def fit_bundle(prep: Prepared, name: str, task: str = "binary", params: dict | None = None,
               train: DataFrame | None = None) -> Bundle:
    """Fit one model on the (scaled, oversampled) training rows and wrap it for scoring."""
    train = prep.train if train is None else train
    n = train.count()
    assembler = VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="features")
    stages = [assembler]
    label_col = "label"
    indexer_model = None
    classes = 2
    if task == "multiclass":
        indexer = StringIndexer(inputCol="label", outputCol="label_idx", stringOrderType="alphabetAsc")
        stages.append(indexer)
        label_col = "label_idx"
        classes = train.select("label").distinct().count()
    stages.append(make_classifier(name, task, n, label_col, params, classes))
    fitted = Pipeline(stages=stages).fit(train)
    clf = fitted.stages[-1]
    if task == "multiclass":
        indexer_model = fitted.stages[1]
    # rows with a missing input are kept (NaN in the vector) and get a NULL prediction
    score_stages = [SQLTransformer(statement=_encode_scale_sql(prep)),
                    VectorAssembler(inputCols=[f"f_{f}" for f in NUMERIC_FEATURES], outputCol="features",
                                    handleInvalid="keep"),
                    clf]
    labels = []
    if indexer_model is not None:
        labels = list(indexer_model.labels)
        score_stages.append(IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels))
    return Bundle(name, task, PipelineModel(stages=score_stages), labels)


def score(bundle: Bundle, features_df: DataFrame, label: str | None = None) -> DataFrame:
    """Scored rows: udi, label, prediction (and score = P(failure) for the binary task)."""
    out = bundle.transform(features_df)
    ok = F.lit(True)
    for f in NUMERIC_FEATURES:
        ok = ok & c(f"f_{f}").isNotNull()

    def masked(x):
        return F.when(ok, x)
    if bundle.task == "binary":
        lab = c("target") if label is None else c(label)
        cols = [c("udi"), lab.cast("int").alias("label"),
                masked(c("prediction").cast("int")).alias("prediction")]
        if "probability" in out.columns:
            cols.append(masked(vector_to_array("probability")[1]).alias("score"))
        else:
            cols.append(masked(c("prediction").cast("double")).alias("score"))
        return out.select(*cols)
    lab = c("failure_type") if label is None else c(label)
    return out.select("udi", lab.alias("label"), masked(c("predicted_label")).alias("prediction"))


def test_features(features_df: DataFrame, prep: Prepared) -> DataFrame:
    """Feature-view rows of the test split (semi join on the split's keys)."""
    keys = prep.test.select("udi")
    return features_df.join(keys, "udi", "left_semi")


def score_prepared(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """Scored rows (udi, label, prediction, score) of already encoded and scaled rows."""
    assembled = VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="features").transform(rows)
    out = PipelineModel(stages=bundle.model.stages[2:]).transform(assembled)
    if bundle.task == "multiclass":
        return out.select("udi", "label", c("predicted_label").alias("prediction"))
    score_col = vector_to_array("probability")[1] if "probability" in out.columns else c("prediction")
    return out.select("udi", c("label").cast("int").alias("label"),
                      c("prediction").cast("int").alias("prediction"), score_col.cast("double").alias("score"))


def _metric_row(scored: DataFrame, task: str) -> dict:
    if task == "binary":
        m = evaluate.metrics_binary(scored).first().asDict()
        m["roc_auc"] = evaluate.roc_auc(scored).first()[0]
    else:
        m = evaluate.metrics_weighted(scored).first().asDict()
        m["roc_auc"] = None
    return m


def compare_models(prep: Prepared, task: str = "binary", names: Sequence[str] = MODEL_NAMES,
                   fit=None, parallelism: int = 3) -> tuple[DataFrame, dict[str, Bundle]]:
    """Fit each model, score the untouched test split, table sorted by F1 (desc).

    The test rows are read scaled, as prepared, and each model scores them once; every
    metric reads those scored rows.  The fits are independent Spark jobs and run
    concurrently from a driver thread pool; ``fit(prep, name, task)`` may return an
    already fitted bundle."""
    spark = prep.train.sparkSession
    fit = fit or fit_bundle
    test_rows = prep.test.persist(StorageLevel.MEMORY_AND_DISK)

    def one(name):
        b = fit(prep, name, task)
        scored = score_prepared(b, test_rows).persist(StorageLevel.MEMORY_AND_DISK)
        m = _metric_row(scored, task)
        scored.unpersist()
        return name, b, (name, m["accuracy"], m["precision"], m["recall"], m["f1"], m["roc_auc"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(one, names))
    test_rows.unpersist()
    bundles = {n: b for n, b, _ in done}
    rows = [r for _, _, r in done]
    table = spark.createDataFrame(rows, "model string, accuracy double, precision double, recall double, "
                                        "f1 double, roc_auc double")
    # the table has one row per model; the ranking window runs over those rows only
    w = F.row_number().over(Window.orderBy(c("f1").desc(), c("model")))
    return table.withColumn("rank", w), bundles


def feature_importance(bundle: Bundle, features: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """importance per feature, rank, top-3 flag,
    and whether the feature is engineered in SQL (dashboard split engineered / raw)."""
    clf = bundle.model.stages[2]
    if hasattr(clf, "featureImportances"):
        imp = clf.featureImportances.toArray().tolist()
    elif hasattr(clf, "coefficientMatrix"):
        # one row for a binary model, one per class for a multinomial one
        coef = abs(clf.coefficientMatrix.toArray()).mean(axis=0).tolist()
        total = sum(coef) or 1.0
        imp = [x / total for x in coef]
    else:
        imp = [0.0] * len(features)
    spark = SparkSession.getActiveSession()
    rows = [(f, float(v), f in ENGINEERED) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double, is_engineered boolean")
    ranked = df.withColumn("rank", F.row_number().over(Window.orderBy(c("importance").desc(), "feature")))
    return ranked.withColumn("is_top3", c("rank") <= 3)


# ---------------------------------------------------------------- randomized search
# The search space of the tuned booster (the reference's lists).
PARAM_GRID = {
    "n_estimators": [100, 200, 300, 500, 700, 1000],
    "max_depth": [3, 5, 7, 10, 15, -1],
    "learning_rate": [0.01, 0.05, 0.1, 0.2, 0.3],
    "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0],
    "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
    "min_child_samples": [5, 10, 20, 30, 50],
    "reg_alpha": [0, 0.01, 0.1, 0.5, 1.0],
    "reg_lambda": [0, 0.01, 0.1, 0.5, 1.0],
}
UNLIMITED_DEPTH = 30  # -1 (no limit): the deepest tree that Spark's learners grow


def grid_size() -> int:
    return math.prod(len(v) for v in PARAM_GRID.values())


def sample_params(n_iter: int, seed: int = SEED) -> list[dict]:
    """n_iter distinct combinations drawn without replacement (mixed-radix decode)."""
    rng = random.Random(seed)
    picks = rng.sample(range(grid_size()), n_iter)
    out = []
    for idx in picks:
        combo = {}
        for k, values in PARAM_GRID.items():
            idx, r = divmod(idx, len(values))
            combo[k] = values[r]
        out.append(combo)
    return out


def to_gbt_params(combo: dict) -> dict:
    """Map a booster combination to params of Spark's GBT, which has no counterpart of
    reg_alpha / reg_lambda and a limit of depth; the search itself applies them all."""
    depth = combo["max_depth"] if combo["max_depth"] > 0 else UNLIMITED_DEPTH
    col = combo["colsample_bytree"]
    return {"maxIter": combo["n_estimators"], "maxDepth": depth, "stepSize": combo["learning_rate"],
            "featureSubsetStrategy": "all" if col >= 1.0 else str(col),
            "subsamplingRate": combo["subsample"], "minInstancesPerNode": combo["min_child_samples"]}


@dataclass
class SearchResult:
    cv_results: DataFrame
    best_params: dict
    best: Bundle
    folds: int


def _fit_input(df: DataFrame) -> DataFrame:
    """Rows written once and read in as many tasks as they fill (``ROWS_PER_FIT_TASK``)."""
    stored = cut_lineage(df)
    return stored.coalesce(max(1, math.ceil(stored.count() / ROWS_PER_FIT_TASK)))


def _fold_sets(prep: Prepared, k: int, smote_before_cv: bool, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) per fold, each written once.  Default: oversample inside each
    fold's training part only, so no synthetic neighbour of a validation row is trained on;
    a fold's class with fewer than 6 rows uses the neighbours it has."""
    source = prep.train.drop("is_synthetic") if smote_before_cv else prep.train_unbalanced
    base = cut_lineage(sampling.stratified_folds(source, k, seed=seed))

    def one(f):
        tr = base.where(c("fold") != f).drop("fold")
        if not smote_before_cv:
            tr = sampling.smote(tr, NUMERIC_FEATURES, seed=seed, k_cap=True, materialized=True)
        return _fit_input(tr), _fit_input(base.where(c("fold") == f).drop("fold"))

    with ThreadPoolExecutor(max_workers=k) as pool:       # the folds are independent Spark jobs
        return list(pool.map(one, range(k)))


def _coded(rows: DataFrame, labels: list) -> DataFrame:
    """(features array, class code, key) of scaled rows and the other columns."""
    code = c("label").cast("int")
    if labels:
        code = F.lit(None).cast("int")
        for i, label in enumerate(labels):
            code = F.when(c("label") == label, i).otherwise(code)
    return rows.select("*", F.array(*[c(f).cast("double") for f in NUMERIC_FEATURES]).alias("features"),
                       code.alias("code"), c("udi").alias("key"))


def _class_labels(prep: Prepared, task: str) -> list:
    """Labels of the failure types in code order (one row per class); empty for the binary task."""
    if task == "binary":
        return []
    return sorted(r[0] for r in prep.train_unbalanced.select("label").distinct().collect())


def _fold_blocks(sets, labels: list, share=None) -> DataFrame:
    """Binned blocks of all folds, written once: training rows at their ``share`` of the fold's
    order, validation rows that are only scored; cut points from the training rows."""
    features = len(NUMERIC_FEATURES)
    rows = [_coded(tr, labels) for tr, _ in sets]
    with ThreadPoolExecutor(max_workers=len(sets)) as pool:
        cuts = list(pool.map(lambda tr: boosters.quantile_cuts(tr, "features", features), rows))
    parts = []
    for f, (_, va) in enumerate(sets):
        parts += [boosters.pack(rows[f], cuts[f], f, share),
                  boosters.pack(_coded(va, labels), cuts[f], f, F.lit(boosters.NEVER))]
    blocks = parts[0]
    for part in parts[1:]:
        blocks = blocks.union(part)
    return cut_lineage(blocks)


def _weighted_f1(confusion: dict, learned: int = 0) -> float:
    """Support-weighted F1 of the rows learned from (1) or the others (0)."""
    cells = {(y, p): n for (kind, y, p), n in confusion.items() if kind == learned}
    total = sum(cells.values())
    out = 0.0
    for k in {y for y, _ in cells}:
        support = sum(n for (y, _), n in cells.items() if y == k)
        predicted = sum(n for (_, p), n in cells.items() if p == k)
        out += 2 * cells.get((k, k), 0) / (support + predicted) * support
    return round(out / total, evaluate.DIGITS) if total else 0.0


def random_search(prep: Prepared, task: str = "binary", n_iter: int = 50, folds: int = 5,
                  seed: int = SEED, smote_before_cv: bool = False) -> SearchResult:
    """Randomized search over PARAM_GRID with stratified k-fold CV, weighted F1.

    All (combination, fold) models are trained together over one written table of binned
    rows; the best combination is refitted on the whole (oversampled) training set."""
    spark = prep.train.sparkSession
    combos = sample_params(n_iter, seed)
    labels = _class_labels(prep, task)
    blocks = _fold_blocks(_fold_sets(prep, folds, smote_before_cv, seed), labels)
    base = [booster_spec(LEAFWISE, len(labels) or 2, combo) for combo in combos]
    fitted = boosters.train(blocks, [replace(s, fold=f) for s in base for f in range(folds)], len(NUMERIC_FEATURES))
    rows, best = [], None
    for i, combo in enumerate(combos):
        scores = [_weighted_f1(x.confusion) for x in fitted[i * folds:(i + 1) * folds]]
        mean = sum(scores) / folds
        std = math.sqrt(sum((x - mean) ** 2 for x in scores) / folds)
        rows.append((i, *[float(combo[k]) for k in PARAM_GRID], mean, std))
        if best is None or mean > best[0]:
            best = (mean, combo)
    schema = ("combo int, " + ", ".join(f"{k} double" for k in PARAM_GRID)
              + ", mean_test_score double, std_test_score double")
    table = spark.createDataFrame(rows, schema)
    return SearchResult(table, best[1], fit_bundle(prep, LEAFWISE, task, best[1]), folds)


def cv_results(result: SearchResult, top: int = 20) -> DataFrame:
    """The ``top`` combinations by mean CV score (a top-k report)."""
    w = Window.orderBy(c("mean_test_score").desc(), c("combo"))
    return result.cv_results.withColumn("rank", F.row_number().over(w)).where(c("rank") <= top)


def default_vs_tuned(prep: Prepared, task: str, tuned: Bundle,
                     default: Bundle | None = None) -> tuple[float, float]:
    """Weighted F1 on the test split of the default booster and of the tuned one."""
    default = default or fit_bundle(prep, LEAFWISE, task)
    d = float(evaluate.metrics_weighted(score_prepared(default, prep.test)).first()["f1"])
    t = float(evaluate.metrics_weighted(score_prepared(tuned, prep.test)).first()["f1"])
    return d, t


def learning_curve(prep: Prepared, task: str = "binary", params: dict | None = None,
                   sizes: Sequence[float] = tuple(0.1 + i * 0.9 / 7 for i in range(8)),
                   folds: int = 3, seed: int = SEED, smote_before_cv: bool = False) -> DataFrame:
    """Train / validation weighted F1 (mean, population std over folds) per training size.

    Each fold's training part is ranked per class by key hash; a subset holds the first
    ceil(fraction * n) rows of every class, so subsets are exact, nested and stratified.
    Oversampling happens inside the training part (see ``_fold_sets``).  All (size, fold) models
    are trained together: a row's place in its class tells which of them learn from it."""
    spark = prep.train.sparkSession
    labels = _class_labels(prep, task)

    def ranked(part):
        tr, va = part
        tr = tr.select("udi", "label", *NUMERIC_FEATURES)
        size = {r[0]: int(r[1]) for r in tr.groupBy("label").count().collect()}  # one row per class
        n_c = F.lit(None).cast("long")
        for label, n in size.items():
            n_c = F.when(c("label") == label, F.lit(n)).otherwise(n_c)
        return _fit_input(sampling.dense_index(tr, "label", "udi", seed).withColumn("_n", n_c)), va

    with ThreadPoolExecutor(max_workers=folds) as pool:
        parts = list(pool.map(ranked, _fold_sets(prep, folds, smote_before_cv, seed)))
    blocks = _fold_blocks(parts, labels, c("_idx") / c("_n"))
    base = booster_spec(LEAFWISE, len(labels) or 2, params)
    jobs = [(float(x), f) for x in sizes for f in range(folds)]
    fitted = boosters.train(blocks, [replace(base, fold=f, share=x) for x, f in jobs], len(NUMERIC_FEATURES))
    rows = [(x, f, sum(n for k, n in m.confusion.items() if k[0]), _weighted_f1(m.confusion, 1), _weighted_f1(m.confusion))
            for (x, f), m in zip(jobs, fitted)]
    df = spark.createDataFrame(rows, "fraction double, fold int, train_rows long, train_score double, "
                                     "validation_score double")
    return df.groupBy("fraction").agg(
        F.avg("train_rows").alias("train_rows"),
        F.avg("train_score").alias("train_mean"), F.stddev_pop("train_score").alias("train_std"),
        F.avg("validation_score").alias("validation_mean"),
        F.stddev_pop("validation_score").alias("validation_std")).orderBy("fraction")


def cross_val_score(prep: Prepared, task: str = "binary", params: dict | None = None,
                    folds: int = 5, seed: int = SEED, smote_before_cv: bool = False) -> DataFrame:
    """Per-fold weighted F1 of one configuration, plus mean and population std rows."""
    spark = prep.train.sparkSession
    labels = _class_labels(prep, task)
    blocks = _fold_blocks(_fold_sets(prep, folds, smote_before_cv, seed), labels)
    base = booster_spec(LEAFWISE, len(labels) or 2, params)
    fitted = boosters.train(blocks, [replace(base, fold=f) for f in range(folds)], len(NUMERIC_FEATURES))
    vals = [_weighted_f1(m.confusion) for m in fitted]
    mean = sum(vals) / len(vals)
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / len(vals))
    rows = [(f"fold_{f}", v) for f, v in enumerate(vals)] + [("mean", mean), ("std", std)]
    return spark.createDataFrame(rows, "item string, f1_weighted double")


# ---------------------------------------------------------------- persistence
def save_bundle(bundle: Bundle, path: str) -> None:
    """One directory: the whole scoring pipeline (encoding, scaling, model, label map)."""
    bundle.model.write().overwrite().save(path)


def load_bundle(paths: Sequence[str], task: str = "binary", name: str = "loaded") -> Bundle:
    """Load the first path that exists (tuned set first, default set as fallback)."""
    sc = SparkSession.getActiveSession().sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path
    for p in paths:
        at = hadoop_path(p)
        if not at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at):
            continue
        model = PipelineModel.load(p)  # a damaged bundle is an error, not a reason to fall back
        labels = []
        if isinstance(model.stages[-1], IndexToString):
            labels = list(model.stages[-1].getLabels())
        return Bundle(name, task, model, labels)
    raise FileNotFoundError(f"no model bundle under {list(paths)}")
