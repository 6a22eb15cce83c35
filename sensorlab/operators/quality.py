"""Data-quality checks, label repair, clean view and key dedupe.

Every check is a filter or an aggregate over the raw table; none collects rows.  The
report form (:func:`dq_summary`) answers all row-level checks in one scan with
conditional aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.functions.exprs import any_null
from sensorlab.schema import (NO_FAILURE, NULL_CHECKED, TEMP_MAX_K, TEMP_MIN_K,
                              UNSPECIFIED_FAILURE)

c = F.col


# ---------------------------------------------------------------- row predicates
def _bad_rpm():
    return c("rotational_speed_rpm") <= 0


def _bad_torque():
    return c("torque_nm") <= 0


def _bad_temperature():
    return ((c("air_temperature_k") < TEMP_MIN_K) | (c("air_temperature_k") > TEMP_MAX_K)
            | (c("process_temperature_k") < TEMP_MIN_K) | (c("process_temperature_k") > TEMP_MAX_K))


def _label_case_a():
    return (c("target") == 0) & c("failure_type").isNotNull()


def _label_case_b():
    return (c("target") == 1) & (c("failure_type") == NO_FAILURE)


# ---------------------------------------------------------------- 2.2 checks
def dq_total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def dq_null_rows(df: DataFrame) -> DataFrame:
    return df.where(any_null(NULL_CHECKED))


def dq_duplicate_keys(df: DataFrame, key: str = "udi") -> DataFrame:
    """Keys that occur more than once (HAVING COUNT(*) > 1); partial aggregation first,
    so a hot key is combined map-side before the shuffle."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .where(c("duplicate_count") > 1))


def dq_invalid_rpm(df: DataFrame) -> DataFrame:
    return df.where(_bad_rpm())


def dq_invalid_torque(df: DataFrame) -> DataFrame:
    return df.where(_bad_torque())


def dq_temperature_range(df: DataFrame) -> DataFrame:
    return df.where(_bad_temperature())


def dq_label_case_a(df: DataFrame) -> DataFrame:
    return df.where(_label_case_a())


def dq_label_case_b(df: DataFrame) -> DataFrame:
    return df.where(_label_case_b())


def _unpivot(one_row: DataFrame, names: list[str], name_col: str, value_col: str) -> DataFrame:
    return one_row.unpivot([], names, name_col, value_col)


def dq_missing_by_column(df: DataFrame) -> DataFrame:
    """NULL cells per column plus a ``__total__`` row, from one aggregate pass."""
    cols = df.columns
    aggs = [F.count_if(c(x).isNull()).alias(x) for x in cols]
    one = df.agg(*aggs)
    one = one.withColumn("__total__", sum((c(x) for x in cols), F.lit(0).cast("bigint")))
    return _unpivot(one, cols + ["__total__"], "column_name", "missing_count")


def dq_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (pandas ``duplicated().sum()``).

    Group on every column (NULLs group together, as in pandas) and add up count - 1.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(c("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def dq_summary(df: DataFrame, key: str = "udi") -> DataFrame:
    """All checks as (check_name, bad_rows): row checks in one scan, plus the key check."""
    row_checks = {
        "null_rows": any_null(NULL_CHECKED),
        "invalid_rpm": _bad_rpm(),
        "invalid_torque": _bad_torque(),
        "temperature_out_of_range": _bad_temperature(),
        "label_case_a": _label_case_a(),
        "label_case_b": _label_case_b(),
    }
    one = df.agg(F.count(F.lit(1)).alias("total_records"),
                 *[F.count_if(cond).alias(name) for name, cond in row_checks.items()])
    checks = _unpivot(one, ["total_records", *row_checks], "check_name", "bad_rows")
    dup = (dq_duplicate_keys(df, key)
           .agg(F.count(F.lit(1)).alias("bad_rows"))
           .select(F.lit("duplicate_keys").alias("check_name"), "bad_rows"))
    return checks.unionByName(dup)


# ---------------------------------------------------------------- 2.3 repair / views
def fix_labels(df: DataFrame) -> DataFrame:
    """Label repair: healthy rows lose their label; a failure labelled 'No Failure'
    becomes 'Unspecified Failure'.  A projection, so the raw input is never mutated."""
    fixed = (F.when(c("target") == 0, F.lit(None).cast("string"))
             .when((c("target") == 1) & (c("failure_type") == NO_FAILURE), F.lit(UNSPECIFIED_FAILURE))
             .otherwise(c("failure_type")))
    return df.withColumn("failure_type", fixed)


def repair_problem(old: DataFrame, new: DataFrame) -> str | None:
    """What a label repair left wrong: rows lost or gained, or a label of either bad case (two aggregations)."""
    before = old.count()
    found = new.agg(F.count(F.lit(1)).alias("n"), F.count_if(_label_case_a()).alias("a"),
                    F.count_if(_label_case_b()).alias("b")).first()
    if found["n"] != before:
        return f"{found['n']} rows instead of {before}"
    if found["a"] or found["b"]:
        return f"{found['a']} labels of healthy rows, {found['b']} failures labelled {NO_FAILURE!r}"
    return None


def repair_labels(table) -> int:
    """The label repair as one transaction on a ``VersionedTable``; returns the new version."""
    return table.transaction(fix_labels, repair_problem)


def verify_labels(df: DataFrame) -> DataFrame:
    return (df.groupBy("target", "failure_type")
            .agg(F.count(F.lit(1)).alias("total_count"))
            .orderBy("target", "failure_type"))


def clean_view(df: DataFrame) -> DataFrame:
    """rpm > 0, torque > 0, both temperatures BETWEEN 200 AND 400 (NULLs drop out).

    Plain comparisons, so Catalyst pushes them into the parquet scan when ``df`` is a
    scan of a stored sensor table.
    """
    return df.where((c("rotational_speed_rpm") > 0) & (c("torque_nm") > 0)
                    & c("air_temperature_k").between(TEMP_MIN_K, TEMP_MAX_K)
                    & c("process_temperature_k").between(TEMP_MIN_K, TEMP_MAX_K))


# Tie-break order for the key dedupe: sensor readings first, then every other column.
DEDUPE_ORDER = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm",
                "torque_nm", "tool_wear_min", "product_id", "machine_type", "target",
                "failure_type"]


def dedupe_by_key(df: DataFrame, key: str = "udi") -> DataFrame:
    """One row per key: the smallest row by ``DEDUPE_ORDER`` (NULLs first).

    ``min(struct(...))`` is an aggregate with a map-side partial step (sort-based: a
    struct with strings has no fixed-width buffer), so a key that holds a third of all
    rows is reduced to one row per task before the shuffle, unlike a window that would
    pull the whole key into one task.
    """
    order = [x for x in DEDUPE_ORDER if x in df.columns and x != key]
    rest = [x for x in df.columns if x != key and x not in order]
    packed = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return packed.select(key, *[c("_r")[x].alias(x) for x in order + rest]).select(*df.columns)


def clean(raw: DataFrame) -> DataFrame:
    """The reference's clean view: repaired labels, then the validity filter."""
    return clean_view(fix_labels(raw))


def clean_unique(raw: DataFrame, key: str = "udi") -> DataFrame:
    """Clean view with one row per key (needed by splits, folds and SMOTE)."""
    return dedupe_by_key(clean(raw), key)
