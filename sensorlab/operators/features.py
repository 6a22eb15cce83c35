"""Engineered features, encodings and model preparation.

All features are scalar Catalyst expressions over one row.  Encoders that need a fitted
vocabulary (label codes, one-hot categories) learn it with a grouped aggregate whose
output is the set of categories, never the rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.functions.exprs import band, safe_ratio
from sensorlab.schema import ENGINEERED, MACHINE_TYPE_CODES, SENSOR_COLUMNS

c = F.col

# Tool-wear bins of the feature view (minutes) and their labels.
WEAR_LOW, WEAR_HIGH = 50, 150
WEAR_LABELS = ["Low", "Medium", "High"]
# High-stress rule (rpm above 1800 and torque above 60 Nm).
STRESS_RPM, STRESS_TORQUE = 1800, 60


def temperature_diff() -> Column:
    return c("process_temperature_k") - c("air_temperature_k")


def mechanical_stress() -> Column:
    return c("rotational_speed_rpm") * c("torque_nm")


def wear_category() -> Column:
    return band("tool_wear_min", WEAR_LOW, WEAR_HIGH, WEAR_LABELS)


def high_stress_flag() -> Column:
    return F.when((c("rotational_speed_rpm") > STRESS_RPM) & (c("torque_nm") > STRESS_TORQUE), 1).otherwise(0)


def rpm_torque_ratio() -> Column:
    """torque / rpm; NULL for rpm 0 (ANSI mode would raise)."""
    return safe_ratio(c("torque_nm"), c("rotational_speed_rpm"))


FEATURE_EXPRS = {
    "temperature_diff": temperature_diff,
    "mechanical_stress": mechanical_stress,
    "wear_category": wear_category,
    "high_stress_flag": high_stress_flag,
    "rpm_torque_ratio": rpm_torque_ratio,
}


def add_feature(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, FEATURE_EXPRS[name]())


def feature_view(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Raw columns + the four engineered features + failure_type (kept, SURVEY D1)."""
    base = [x for x in SENSOR_COLUMNS if x != "failure_type"]
    feats = [FEATURE_EXPRS[n]().alias(n) for n in [*ENGINEERED, *extra]]
    return df.select(*base, *feats, "failure_type")


def encode_machine_type(column: str | Column = "machine_type") -> Column:
    """upper(type): L 0, M 1, H 2, anything else NULL."""
    x = F.upper(c(column) if isinstance(column, str) else column)
    expr = F.lit(None).cast("int")
    for code, value in MACHINE_TYPE_CODES.items():
        expr = F.when(x == code, F.lit(value)).otherwise(expr)
    return expr


def label_codes(df: DataFrame, column: str, code_col: str = "code") -> DataFrame:
    """Alphabetical label codes (0..k-1) of the distinct non-NULL values of ``column``.

    Aggregates to the distinct values first (partial aggregation); the ranking window
    then sees only the few category rows.
    """
    distinct = df.where(c(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("samples"))
    w = Window.orderBy(column)
    return distinct.withColumn(code_col, (F.row_number().over(w) - 1).cast("int"))


def encode_labels(df: DataFrame, column: str, code_col: str | None = None) -> DataFrame:
    """Adds ``<column>_code``: the alphabetical code of each row's label (NULL stays NULL).

    The vocabulary is tiny (one row per class); AQE broadcasts it at run time when its
    measured size is under the broadcast threshold, otherwise it is a shuffle join.
    """
    code_col = code_col or f"{column}_code"
    codes = label_codes(df, column, code_col).select(column, code_col)
    return df.join(codes, on=column, how="left")


def one_hot_categories(df: DataFrame, column: str) -> list[str]:
    """Fitted category list (sorted, NULL excluded); the collect is the set of categories."""
    rows = df.where(c(column).isNotNull()).select(column).distinct().collect()
    return sorted(r[0] for r in rows)


def one_hot_drop_first(df: DataFrame, column: str, categories: Sequence[str] | None = None,
                       keep: Sequence[str] = ()) -> DataFrame:
    """One 0/1 column per category except the first (sorted); unknown or NULL → all 0."""
    cats = sorted(categories) if categories is not None else one_hot_categories(df, column)
    dummies = [F.when(c(column) == v, 1).otherwise(0).alias(f"{column}_{v}") for v in cats[1:]]
    others = [x for x in df.columns if x != column] if not keep else list(keep)
    return df.select(*others, *dummies)


def select_types(df: DataFrame, drop: Sequence[str] = ("udi", "product_id")) -> dict[str, list[str]]:
    """Numeric vs string columns of a frame, ids dropped (schema inspection only)."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        tname = f.dataType.typeName()
        if tname in ("integer", "long", "double", "float", "short", "decimal"):
            numeric.append(f.name)
        elif tname == "string":
            categorical.append(f.name)
    return {"numeric": numeric, "categorical": categorical}


def column_kinds(df: DataFrame, drop: Sequence[str] = ("udi", "product_id")) -> DataFrame:
    """``select_types`` as rows: column, kind, and its count of non-NULL values (one pass)."""
    kinds = [(f, kind) for kind, names in select_types(df, drop).items() for f in names]
    counts = df.agg(*[F.count(c(f)).alias(f) for f, _ in kinds])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("column"), F.lit(kind).alias("kind"), c(f).alias("non_null"))
        for f, kind in kinds])))


_NAME_SEP = re.compile(r"[\s\[\]\(\)/]+")


def normalize_name(name: str) -> str:
    out = _NAME_SEP.sub("_", name.strip().lower())
    out = re.sub(r"_+", "_", out)
    return out.strip("_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename columns: trim, lower, brackets/spaces/slashes → '_', collapse, strip '_'."""
    return df.toDF(*[normalize_name(n) for n in df.columns])


def prepare(df: DataFrame, task: str = "binary", keep_healthy: bool = False,
            keep_key: bool = True) -> DataFrame:
    """Model input: features encoded, label named ``label``, ids and the other target dropped.

    binary: label = target.  multiclass: label = failure_type (healthy rows have a NULL
    label after repair and are dropped, SURVEY D5; ``keep_healthy`` maps them to
    'No Failure').  Rows with a NULL feature (e.g. NULL machine_type) are dropped too
    (SURVEY D22), since no estimator here accepts NULL inputs.  ``wear_category`` keeps
    its string form; the model pipeline indexes it alphabetically.
    """
    feats = [
        encode_machine_type().alias("machine_type"),
        "air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm",
        "tool_wear_min", "temperature_diff", "mechanical_stress", "wear_category", "high_stress_flag",
    ]
    if task == "binary":
        label = c("target").cast("double").alias("label")
    elif task == "multiclass":
        lab = c("failure_type")
        if keep_healthy:
            lab = F.coalesce(lab, F.lit("No Failure"))
        label = lab.alias("label")
    else:
        raise ValueError("task must be 'binary' or 'multiclass'")
    key = ["udi"] if keep_key else []
    out = df.select(*key, *feats, label).where(c("label").isNotNull())
    return out.dropna()


def class_mapping(prepared: DataFrame) -> DataFrame:
    """code, class name and sample count of each class of a multiclass frame."""
    return (label_codes(prepared, "label", "code")
            .select("code", c("label").alias("class_name"), "samples"))
