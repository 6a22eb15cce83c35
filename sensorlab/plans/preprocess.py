"""Model preparation: encode → stratified split → scale (fit on train) → SMOTE on train.

The composition of SURVEY §2.4 / §2.7 that every modelling job starts from.  The test
part is only transformed, never oversampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.operators import features as feat_ops
from sensorlab.operators import sampling
from sensorlab.session import cut_lineage

c = F.col

# Model inputs in the reference's column order, all numeric after encoding.
NUMERIC_FEATURES = ["machine_type", "air_temperature_k", "process_temperature_k",
                    "rotational_speed_rpm", "torque_nm", "tool_wear_min", "temperature_diff",
                    "mechanical_stress", "wear_category", "high_stress_flag"]


def fit_label_codes(df: DataFrame, column: str) -> dict[str, int]:
    """Alphabetical codes of a category column (collects one row per category)."""
    rows = feat_ops.label_codes(df, column, "_code").select(column, "_code").collect()
    return {r[0]: int(r[1]) for r in rows}


def apply_codes(df: DataFrame, column: str, codes: dict[str, int]) -> DataFrame:
    expr = F.lit(None).cast("int")
    for k, v in codes.items():
        expr = F.when(c(column) == k, F.lit(v)).otherwise(expr)
    return df.withColumn(column, expr)


def prepared(features_df: DataFrame, task: str = "binary",
             wear_codes: dict[str, int] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Numeric model frame (udi, 10 features, label) and the wear-category codes used."""
    base = feat_ops.prepare(features_df, task)
    codes = wear_codes or fit_label_codes(base, "wear_category")
    out = apply_codes(base, "wear_category", codes)
    return out.select("udi", *[c(f).cast("double").alias(f) for f in NUMERIC_FEATURES], "label"), codes


def prepared_frame(features_df: DataFrame, task: str = "binary",
                   keep_wear_label: bool = False) -> DataFrame:
    """The frame of ``prepared`` in one plan: the wear-category codes come from a
    broadcast join with the vocabulary instead of a driver round trip.

    The vocabulary is at most the three labels of ``wear_category`` (a fixed CASE), so
    the broadcast has a proven bound; its aggregate reads the same deduplicated rows as
    the main branch, and Spark reuses that shuffle (``ReusedExchange``) instead of
    running it twice.  ``keep_wear_label`` also keeps the label as ``_wear_label`` (for
    reading the code mapping back later)."""
    base = feat_ops.prepare(features_df, task)
    vocab = feat_ops.label_codes(base, "wear_category", "_code").select(
        c("wear_category").alias("_wear"), "_code")
    coded = (base.join(F.broadcast(vocab), c("wear_category") == c("_wear"), "left")
             .withColumn("wear_category", c("_code")))
    label = [c("_wear").alias("_wear_label")] if keep_wear_label else []
    return coded.select("udi", *[c(f).cast("double").alias(f) for f in NUMERIC_FEATURES], "label", *label)


def split(prep: DataFrame, seed: int = 42, hash_kind: str = "xxhash64",
          test_fraction: float = 0.2, materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test).  ``materialize`` writes the prepared rows (numeric columns only) once
    to the shared checkpoint folder, so the cut-offs, the scaler fit, the transforms and SMOTE
    read them instead of re-running the deduplicating shuffle each; the split is a filter on them."""
    if materialize:
        prep = cut_lineage(prep)
    marked = sampling.stratified_split(prep, "label", "udi", test_fraction, seed, hash_kind)
    return (marked.where(~c("is_test")).drop("is_test"), marked.where(c("is_test")).drop("is_test"))


@dataclass
class Prepared:
    train: DataFrame          # scaled, oversampled (is_synthetic marks new rows)
    test: DataFrame           # scaled only
    scaler: sampling.ScalerModel
    wear_codes: dict[str, int]
    train_unbalanced: DataFrame


def preprocess_pipeline(features_df: DataFrame, task: str = "binary", seed: int = 42,
                        hash_kind: str = "xxhash64", k: int = 5, oversample: bool = True,
                        k_cap: bool = False, digits: int | None = None) -> Prepared:
    """``digits`` rounds the scaled inputs, which makes distances and synthetic rows equal in every engine."""
    # one pass over the deduplicated rows: the split is materialised with the wear label,
    # and the code mapping (at most three rows) is read back from that narrow checkpoint
    prep = prepared_frame(features_df, task, keep_wear_label=True)
    train, test = split(prep, seed, hash_kind, materialize=True)
    pairs = (train.unionByName(test).where(c("_wear_label").isNotNull())
             .select("_wear_label", "wear_category").distinct().collect())
    codes = {r[0]: int(r[1]) for r in sorted(pairs, key=lambda r: r[1])}
    train, test = train.drop("_wear_label"), test.drop("_wear_label")
    scaler = sampling.fit_standard_scaler(train, NUMERIC_FEATURES)
    train_s, test_s = scaler.transform(train, digits), scaler.transform(test, digits)
    if oversample:
        balanced = sampling.smote(train_s, NUMERIC_FEATURES, "label", "udi", k=k, seed=seed, k_cap=k_cap,
                                  materialized=True, hash_kind=hash_kind)
    else:
        balanced = train_s.withColumn("is_synthetic", F.lit(False))
    # every estimator makes many passes over the training rows: materialise them once in
    # the shared checkpoint folder (cuts the SMOTE lineage; survives executor loss)
    balanced = cut_lineage(balanced)
    return Prepared(balanced, test_s, scaler, codes, train_s)


@dataclass
class TypedPrepared:
    train: DataFrame          # scaled and one-hot, oversampled (is_synthetic marks new rows)
    test: DataFrame           # scaled and one-hot only
    scaler: sampling.ScalerModel
    categories: dict[str, list[str]]
    features: list[str]


def typed_pipeline(features_df: DataFrame, task: str = "binary", seed: int = 42,
                   hash_kind: str = "xxhash64", k: int = 5, oversample: bool = True,
                   k_cap: bool = False, digits: int | None = None) -> TypedPrepared:
    """Columns found by type: numeric ones scaled, strings one-hot with the first category
    dropped (categories and scaler fitted on the training rows; an unknown category is all
    zero), then SMOTE on the training rows.  Rows with a NULL input are dropped."""
    label = {"binary": c("target").cast("double"), "multiclass": c("failure_type")}[task]
    kinds = feat_ops.select_types(features_df, drop=("udi", "product_id", "target", "failure_type"))
    numeric, strings = kinds["numeric"], kinds["categorical"]
    rows = features_df.select("udi", *[c(f).cast("double").alias(f) for f in numeric], *strings,
                              label.alias("label")).dropna()
    train, test = split(rows, seed, hash_kind, materialize=True)
    categories = {f: feat_ops.one_hot_categories(train, f) for f in strings}
    scaler = sampling.fit_standard_scaler(train, numeric)
    dummies = [f"{f}_{v}" for f in strings for v in categories[f][1:]]

    def transform(df):
        out = scaler.transform(df, digits)
        for f in strings:
            out = feat_ops.one_hot_drop_first(out, f, categories[f])
        return out.select("udi", "label", *numeric, *[c(d).cast("double").alias(d) for d in dummies])

    inputs = numeric + dummies
    if oversample:
        balanced = sampling.smote(transform(train), inputs, k=k, seed=seed, k_cap=k_cap, materialized=True,
                                  hash_kind=hash_kind)
    else:
        balanced = transform(train).withColumn("is_synthetic", F.lit(False))
    return TypedPrepared(cut_lineage(balanced), transform(test), scaler, categories, inputs)
