"""Failure-rate and sensor-profile queries.

Every query is a hash aggregate with a map-side partial step: at any scale each task
emits at most one row per group before the shuffle, so the exchanged data is
(#tasks x #groups) rows, independent of the table size and of hot groups.  Rates use
double arithmetic and ``try_divide`` (see :func:`sensorlab.functions.exprs.pct`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.functions.exprs import dround, avg_r, band, failure_sum, pct
from sensorlab.schema import SENSORS

c = F.col


def n_rows():
    return F.count(F.lit(1))


def eda_total_records(df: DataFrame) -> DataFrame:
    return df.agg(n_rows().alias("total_records"))


def eda_target_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("target").agg(n_rows().alias("total_count"))


def eda_failure_rate(df: DataFrame) -> DataFrame:
    return df.agg(pct(failure_sum(), n_rows()).alias("failure_rate_percentage"))


def eda_failure_type_counts(df: DataFrame) -> DataFrame:
    return (df.where(c("target") == 1).groupBy("failure_type")
            .agg(n_rows().alias("failure_count"))
            .orderBy(c("failure_count").desc(), "failure_type"))


def eda_failure_type_pct(df: DataFrame) -> DataFrame:
    """Share of all failures per type: ``SUM(COUNT(*)) OVER ()`` over the aggregate.

    The un-partitioned window runs on the aggregated rows (one per failure type), so
    its single task holds a handful of rows whatever the table size.
    """
    counts = df.where(c("target") == 1).groupBy("failure_type").agg(n_rows().alias("failure_count"))
    total = F.sum("failure_count").over(Window.partitionBy())
    return (counts.withColumn("percentage", pct(c("failure_count"), total))
            .orderBy(c("percentage").desc(), "failure_type"))


def eda_machines_per_type(df: DataFrame) -> DataFrame:
    return df.groupBy("machine_type").agg(n_rows().alias("total_machines"))


def eda_failures_per_type(df: DataFrame) -> DataFrame:
    return df.where(c("target") == 1).groupBy("machine_type").agg(n_rows().alias("failure_count"))


def eda_rate_per_type(df: DataFrame) -> DataFrame:
    return df.groupBy("machine_type").agg(
        n_rows().alias("total_records"),
        failure_sum().alias("total_failures"),
        pct(failure_sum(), n_rows()).alias("failure_rate_percentage"))


def eda_sensor_means_by_target(df: DataFrame, int_avg: bool = False) -> DataFrame:
    """Five sensor averages per target.  ``int_avg`` truncates the two INT columns as
    T-SQL AVG(INT) does (SURVEY D7); the default is the double average."""
    def a(x, is_int=False):
        if int_avg and is_int:
            return F.avg(x).cast("int")
        return avg_r(x)
    return df.groupBy("target").agg(
        a("air_temperature_k").alias("avg_air_temp"),
        a("process_temperature_k").alias("avg_process_temp"),
        a("rotational_speed_rpm", True).alias("avg_rpm"),
        a("torque_nm").alias("avg_torque"),
        a("tool_wear_min", True).alias("avg_tool_wear"))


def _temp_diff():
    return c("process_temperature_k") - c("air_temperature_k")


def eda_temp_diff_mean(df: DataFrame) -> DataFrame:
    return df.agg(avg_r(_temp_diff()).alias("avg_temp_difference"))


def eda_temp_diff_by_target(df: DataFrame) -> DataFrame:
    return df.groupBy("target").agg(avg_r(_temp_diff()).alias("avg_temp_difference"))


def eda_temp_extrema(df: DataFrame) -> DataFrame:
    return df.agg(F.min("air_temperature_k").alias("min_air_temp"),
                  F.max("air_temperature_k").alias("max_air_temp"),
                  F.min("process_temperature_k").alias("min_process_temp"),
                  F.max("process_temperature_k").alias("max_process_temp"))


def _mean_by_target(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.groupBy("target").agg(avg_r(column).alias(alias))


def eda_wear_mean_by_target(df: DataFrame) -> DataFrame:
    return _mean_by_target(df, "tool_wear_min", "avg_tool_wear")


def eda_rpm_mean_by_target(df: DataFrame) -> DataFrame:
    return _mean_by_target(df, "rotational_speed_rpm", "avg_rpm")


def eda_torque_mean_by_target(df: DataFrame) -> DataFrame:
    return _mean_by_target(df, "torque_nm", "avg_torque")


def rate_by_bin(df: DataFrame, column: str, lo: float, hi: float, labels: Sequence[str],
                bin_name: str) -> DataFrame:
    """Total, failures and failure rate per three-way bin, highest rate first.

    The bin is computed once as a projection and grouped by alias (the reference
    repeats the CASE in GROUP BY)."""
    binned = df.select(band(column, lo, hi, labels).alias(bin_name), "target")
    return (binned.groupBy(bin_name)
            .agg(n_rows().alias("total_records"), failure_sum().alias("failures"),
                 pct(failure_sum(), n_rows()).alias("failure_rate_percentage"))
            .orderBy(c("failure_rate_percentage").desc(), bin_name))


# EDA bin edges and labels.
WEAR_BINS = (50, 150, ["Low Wear", "Medium Wear", "High Wear"])
RPM_BINS = (1200, 1800, ["Low RPM", "Medium RPM", "High RPM"])
TORQUE_BINS = (40, 60, ["Low Torque", "Medium Torque", "High Torque"])


def eda_rate_by_wear_bin(df: DataFrame) -> DataFrame:
    return rate_by_bin(df, "tool_wear_min", *WEAR_BINS, "wear_category")


def eda_rate_by_rpm_bin(df: DataFrame) -> DataFrame:
    return rate_by_bin(df, "rotational_speed_rpm", *RPM_BINS, "rpm_category")


def eda_rate_by_torque_bin(df: DataFrame) -> DataFrame:
    return rate_by_bin(df, "torque_nm", *TORQUE_BINS, "torque_category")


def eda_high_stress(df: DataFrame) -> DataFrame:
    hs = df.where((c("rotational_speed_rpm") > 1800) & (c("torque_nm") > 60))
    return hs.agg(n_rows().alias("high_stress_cases"), failure_sum().alias("failures"),
                  pct(failure_sum(), n_rows()).alias("failure_rate_percentage"))


def eda_top_risk_products(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k products by failures; ties broken by product_id.

    Aggregate then ``orderBy().limit()`` → TakeOrderedAndProject: each task keeps its
    own top k, only k rows per task reach the final merge."""
    return (df.groupBy("product_id")
            .agg(n_rows().alias("total_records"), failure_sum().alias("failure_count"))
            .orderBy(c("failure_count").desc(), "product_id")
            .limit(k))


def eda_outlier_extrema(df: DataFrame) -> DataFrame:
    return df.agg(F.min("rotational_speed_rpm").alias("min_rpm"),
                  F.max("rotational_speed_rpm").alias("max_rpm"),
                  F.min("torque_nm").alias("min_torque"),
                  F.max("torque_nm").alias("max_torque"),
                  F.min("tool_wear_min").alias("min_tool_wear"),
                  F.max("tool_wear_min").alias("max_tool_wear"))


# Display names of the sensors in the differentiator report.
SENSOR_LABELS = {"air_temperature_k": "Air Temp", "process_temperature_k": "Process Temp",
                 "rotational_speed_rpm": "RPM", "torque_nm": "Torque", "tool_wear_min": "Tool Wear"}


def eda_sensor_differentiator(df: DataFrame, agg: str = "max",
                              sensors: Sequence[str] = SENSORS) -> DataFrame:
    """|agg(sensor | target=1) - agg(sensor | target=0)| per sensor, one scan.

    ``agg='max'`` is what the reference computes (for air temperature only);
    ``agg='avg'`` is what its comment describes (SURVEY D15)."""
    fn = {"max": F.max, "avg": F.avg}[agg]
    parts = []
    for s in sensors:
        one = fn(F.when(c("target") == 1, c(s)))
        zero = fn(F.when(c("target") == 0, c(s)))
        parts.append(dround(F.abs(one - zero), 4).cast("double").alias(SENSOR_LABELS.get(s, s)))
    wide = df.agg(*parts)
    return wide.unpivot([], [SENSOR_LABELS.get(s, s) for s in sensors], "sensor", "difference")
