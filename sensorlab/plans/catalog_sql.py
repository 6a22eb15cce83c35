"""Registered queries for data quality, cleaning, features and SQL EDA."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlab.operators import eda, features, quality
from sensorlab.plans.registry import register
from sensorlab.session import checkpoint_dir
from sensorlab.sources.fixture import sensor_table
from sensorlab.sources.versioned import VersionedTable

c = F.col


# ---------------------------------------------------------------- shared inputs
def raw(spark: SparkSession, sf: str) -> DataFrame:
    return sensor_table(spark, sf)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean(raw(spark, sf))


def featured(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_view(cleaned(spark, sf))


def unique_featured(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_view(quality.clean_unique(raw(spark, sf)))


RATE = "ROUND(CAST(100 AS DOUBLE) * SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) / COUNT(*), 2)"
FAILS = "CAST(SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT)"

# ---------------------------------------------------------------- 2.2 checks
register("dq_total_records", "SELECT COUNT(*) AS total_records FROM raw")(
    lambda s, sf: quality.dq_total_records(raw(s, sf)))

register("dq_null_rows", """
SELECT * FROM raw
WHERE product_id IS NULL OR machine_type IS NULL OR air_temperature_k IS NULL
   OR process_temperature_k IS NULL OR rotational_speed_rpm IS NULL OR torque_nm IS NULL
   OR tool_wear_min IS NULL OR target IS NULL""")(lambda s, sf: quality.dq_null_rows(raw(s, sf)))

register("dq_duplicate_keys",
         "SELECT udi, COUNT(*) AS duplicate_count FROM raw GROUP BY udi HAVING COUNT(*) > 1")(
    lambda s, sf: quality.dq_duplicate_keys(raw(s, sf)))

register("dq_invalid_rpm", "SELECT * FROM raw WHERE rotational_speed_rpm <= 0")(
    lambda s, sf: quality.dq_invalid_rpm(raw(s, sf)))

register("dq_invalid_torque", "SELECT * FROM raw WHERE torque_nm <= 0")(
    lambda s, sf: quality.dq_invalid_torque(raw(s, sf)))

register("dq_temperature_range", """
SELECT * FROM raw
WHERE air_temperature_k < 200 OR air_temperature_k > 400
   OR process_temperature_k < 200 OR process_temperature_k > 400""")(
    lambda s, sf: quality.dq_temperature_range(raw(s, sf)))

register("dq_label_case_a", "SELECT * FROM raw WHERE target = 0 AND failure_type IS NOT NULL")(
    lambda s, sf: quality.dq_label_case_a(raw(s, sf)))

register("dq_label_case_b", "SELECT * FROM raw WHERE target = 1 AND failure_type = 'No Failure'")(
    lambda s, sf: quality.dq_label_case_b(raw(s, sf)))

_MISSING_COLS = ["udi", "product_id", "machine_type", "air_temperature_k", "process_temperature_k",
                 "rotational_speed_rpm", "torque_nm", "tool_wear_min", "target", "failure_type"]
register("dq_missing_by_column", "SELECT * FROM (" + " UNION ALL ".join(
    [f"SELECT '{x}' AS column_name, COUNT(*) - COUNT({x}) AS missing_count FROM raw" for x in _MISSING_COLS]
    + ["SELECT '__total__' AS column_name, "
       + " + ".join(f"(COUNT(*) - COUNT({x}))" for x in _MISSING_COLS) + " AS missing_count FROM raw"]) + ") t")(
    lambda s, sf: quality.dq_missing_by_column(raw(s, sf)))

register("dq_duplicate_rows", """
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM feat
      GROUP BY udi, product_id, machine_type, air_temperature_k, process_temperature_k,
               rotational_speed_rpm, torque_nm, tool_wear_min, target, temperature_diff,
               mechanical_stress, wear_category, high_stress_flag, failure_type) g""")(
    lambda s, sf: quality.dq_duplicate_rows(featured(s, sf)))

register("dq_summary", """
SELECT 'total_records' AS check_name, COUNT(*) AS bad_rows FROM raw
UNION ALL SELECT 'null_rows', COUNT(*) FILTER (WHERE product_id IS NULL OR machine_type IS NULL
   OR air_temperature_k IS NULL OR process_temperature_k IS NULL OR rotational_speed_rpm IS NULL
   OR torque_nm IS NULL OR tool_wear_min IS NULL OR target IS NULL) FROM raw
UNION ALL SELECT 'invalid_rpm', COUNT(*) FILTER (WHERE rotational_speed_rpm <= 0) FROM raw
UNION ALL SELECT 'invalid_torque', COUNT(*) FILTER (WHERE torque_nm <= 0) FROM raw
UNION ALL SELECT 'temperature_out_of_range', COUNT(*) FILTER (WHERE air_temperature_k < 200
   OR air_temperature_k > 400 OR process_temperature_k < 200 OR process_temperature_k > 400) FROM raw
UNION ALL SELECT 'label_case_a', COUNT(*) FILTER (WHERE target = 0 AND failure_type IS NOT NULL) FROM raw
UNION ALL SELECT 'label_case_b', COUNT(*) FILTER (WHERE target = 1 AND failure_type = 'No Failure') FROM raw
UNION ALL SELECT 'duplicate_keys', COUNT(*) FROM (SELECT udi FROM raw GROUP BY udi HAVING COUNT(*) > 1) d
""")(lambda s, sf: quality.dq_summary(raw(s, sf)))

# ---------------------------------------------------------------- 2.3 repair and views
register("fix_labels", "SELECT * FROM fixed")(lambda s, sf: quality.fix_labels(raw(s, sf)))



def _repaired(s, sf):
    table = VersionedTable(s, f"{checkpoint_dir(s).rstrip('/')}/tables/sensors-{uuid.uuid4().hex}")
    table.create(raw(s, sf))
    quality.repair_labels(table)
    return table.read()


register("fix_labels_transaction", "SELECT * FROM fixed")(_repaired)

register("verify_labels", """
SELECT target, failure_type, COUNT(*) AS total_count FROM fixed
GROUP BY target, failure_type ORDER BY target""")(
    lambda s, sf: quality.verify_labels(quality.fix_labels(raw(s, sf))))

register("clean_view", "SELECT * FROM clean")(lambda s, sf: cleaned(s, sf))

register("dedupe_by_key", "SELECT * FROM uniq")(lambda s, sf: quality.clean_unique(raw(s, sf)))

# ---------------------------------------------------------------- 2.4 features
register("feat_temperature_diff",
         "SELECT udi, process_temperature_k - air_temperature_k AS temperature_diff FROM clean")(
    lambda s, sf: features.add_feature(cleaned(s, sf), "temperature_diff").select("udi", "temperature_diff"))

register("feat_mechanical_stress",
         "SELECT udi, rotational_speed_rpm * torque_nm AS mechanical_stress FROM clean")(
    lambda s, sf: features.add_feature(cleaned(s, sf), "mechanical_stress").select("udi", "mechanical_stress"))

register("feat_wear_category", """
SELECT udi, tool_wear_min, CASE WHEN tool_wear_min < 50 THEN 'Low'
       WHEN tool_wear_min BETWEEN 50 AND 150 THEN 'Medium' ELSE 'High' END AS wear_category
FROM clean""")(
    lambda s, sf: features.add_feature(cleaned(s, sf), "wear_category").select("udi", "tool_wear_min", "wear_category"))

register("feat_high_stress_flag", """
SELECT udi, CASE WHEN rotational_speed_rpm > 1800 AND torque_nm > 60 THEN 1 ELSE 0 END AS high_stress_flag
FROM clean""")(
    lambda s, sf: features.add_feature(cleaned(s, sf), "high_stress_flag").select("udi", "high_stress_flag"))

register("feat_rpm_torque_ratio", """
SELECT udi, CASE WHEN rotational_speed_rpm = 0 THEN NULL
                 ELSE torque_nm / rotational_speed_rpm END AS rpm_torque_ratio
FROM raw""")(
    lambda s, sf: features.add_feature(raw(s, sf), "rpm_torque_ratio").select("udi", "rpm_torque_ratio"))

register("feature_view", "SELECT * FROM feat")(lambda s, sf: featured(s, sf))

register("encode_machine_type", """
SELECT udi, machine_type, CASE upper(machine_type) WHEN 'L' THEN 0 WHEN 'M' THEN 1
       WHEN 'H' THEN 2 ELSE NULL END AS machine_type_code
FROM raw""")(lambda s, sf: raw(s, sf).select(
    "udi", "machine_type", features.encode_machine_type().alias("machine_type_code")))

register("encode_labels", """
SELECT f.udi, f.wear_category, CAST(k.wear_category_code AS INT) AS wear_category_code
FROM feat f LEFT JOIN (
  SELECT wear_category, dense_rank() OVER (ORDER BY wear_category) - 1 AS wear_category_code
  FROM (SELECT DISTINCT wear_category FROM feat WHERE wear_category IS NOT NULL) d) k
ON f.wear_category = k.wear_category""")(
    lambda s, sf: features.encode_labels(featured(s, sf).select("udi", "wear_category"), "wear_category"))

register("one_hot_drop_first", """
SELECT udi,
       CASE WHEN machine_type = 'L' THEN 1 ELSE 0 END AS machine_type_L,
       CASE WHEN machine_type = 'M' THEN 1 ELSE 0 END AS machine_type_M,
       CASE WHEN wear_category = 'Low' THEN 1 ELSE 0 END AS wear_category_Low,
       CASE WHEN wear_category = 'Medium' THEN 1 ELSE 0 END AS wear_category_Medium
FROM feat""")(lambda s, sf: _one_hot(featured(s, sf)))


def _one_hot(df: DataFrame) -> DataFrame:
    base = df.select("udi", "machine_type", "wear_category")
    step = features.one_hot_drop_first(base, "machine_type")
    return features.one_hot_drop_first(step, "wear_category")


register("drop_null_label", """
SELECT udi, CASE upper(machine_type) WHEN 'L' THEN 0 WHEN 'M' THEN 1 WHEN 'H' THEN 2 END AS machine_type,
       air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min,
       temperature_diff, mechanical_stress, wear_category, high_stress_flag, failure_type AS label
FROM feat
WHERE failure_type IS NOT NULL AND upper(machine_type) IN ('L', 'M', 'H')""")(
    lambda s, sf: features.prepare(featured(s, sf), "multiclass"))

register("class_mapping", """
SELECT CAST(row_number() OVER (ORDER BY failure_type) - 1 AS INT) AS code,
       failure_type AS class_name, COUNT(*) AS samples
FROM ufeat WHERE failure_type IS NOT NULL AND upper(machine_type) IN ('L', 'M', 'H')
GROUP BY failure_type""")(
    lambda s, sf: features.class_mapping(features.prepare(unique_featured(s, sf), "multiclass")))

# ---------------------------------------------------------------- 2.5 SQL EDA (raw table)
register("eda_total_records", "SELECT COUNT(*) AS total_records FROM raw")(
    lambda s, sf: eda.eda_total_records(raw(s, sf)))

register("eda_target_counts", "SELECT target, COUNT(*) AS total_count FROM raw GROUP BY target")(
    lambda s, sf: eda.eda_target_counts(raw(s, sf)))

register("eda_failure_rate", f"SELECT {RATE} AS failure_rate_percentage FROM raw")(
    lambda s, sf: eda.eda_failure_rate(raw(s, sf)))

register("eda_failure_type_counts", """
SELECT failure_type, COUNT(*) AS failure_count FROM raw WHERE target = 1
GROUP BY failure_type ORDER BY failure_count DESC""")(
    lambda s, sf: eda.eda_failure_type_counts(raw(s, sf)))

register("eda_failure_type_pct", """
SELECT failure_type, COUNT(*) AS failure_count,
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
FROM raw WHERE target = 1 GROUP BY failure_type ORDER BY percentage DESC""")(
    lambda s, sf: eda.eda_failure_type_pct(raw(s, sf)))

register("eda_machines_per_type",
         "SELECT machine_type, COUNT(*) AS total_machines FROM raw GROUP BY machine_type")(
    lambda s, sf: eda.eda_machines_per_type(raw(s, sf)))

register("eda_failures_per_type",
         "SELECT machine_type, COUNT(*) AS failure_count FROM raw WHERE target = 1 GROUP BY machine_type")(
    lambda s, sf: eda.eda_failures_per_type(raw(s, sf)))

register("eda_rate_per_type", f"""
SELECT machine_type, COUNT(*) AS total_records, {FAILS} AS total_failures,
       {RATE} AS failure_rate_percentage
FROM raw GROUP BY machine_type""")(lambda s, sf: eda.eda_rate_per_type(raw(s, sf)))

register("eda_sensor_means_by_target", """
SELECT target, ROUND(AVG(air_temperature_k), 4) AS avg_air_temp,
       ROUND(AVG(process_temperature_k), 4) AS avg_process_temp,
       ROUND(AVG(rotational_speed_rpm), 4) AS avg_rpm, ROUND(AVG(torque_nm), 4) AS avg_torque,
       ROUND(AVG(tool_wear_min), 4) AS avg_tool_wear
FROM raw GROUP BY target""")(lambda s, sf: eda.eda_sensor_means_by_target(raw(s, sf)))

register("eda_temp_diff_mean",
         "SELECT ROUND(AVG(process_temperature_k - air_temperature_k), 4) AS avg_temp_difference FROM raw")(
    lambda s, sf: eda.eda_temp_diff_mean(raw(s, sf)))

register("eda_temp_diff_by_target", """
SELECT target, ROUND(AVG(process_temperature_k - air_temperature_k), 4) AS avg_temp_difference
FROM raw GROUP BY target""")(lambda s, sf: eda.eda_temp_diff_by_target(raw(s, sf)))

register("eda_temp_extrema", """
SELECT MIN(air_temperature_k) AS min_air_temp, MAX(air_temperature_k) AS max_air_temp,
       MIN(process_temperature_k) AS min_process_temp, MAX(process_temperature_k) AS max_process_temp
FROM raw""")(lambda s, sf: eda.eda_temp_extrema(raw(s, sf)))

register("eda_wear_mean_by_target",
         "SELECT target, ROUND(AVG(tool_wear_min), 4) AS avg_tool_wear FROM raw GROUP BY target")(
    lambda s, sf: eda.eda_wear_mean_by_target(raw(s, sf)))

register("eda_rpm_mean_by_target",
         "SELECT target, ROUND(AVG(rotational_speed_rpm), 4) AS avg_rpm FROM raw GROUP BY target")(
    lambda s, sf: eda.eda_rpm_mean_by_target(raw(s, sf)))

register("eda_torque_mean_by_target",
         "SELECT target, ROUND(AVG(torque_nm), 4) AS avg_torque FROM raw GROUP BY target")(
    lambda s, sf: eda.eda_torque_mean_by_target(raw(s, sf)))


def _bin_sql(column: str, lo, hi, labels, name: str) -> str:
    case = (f"CASE WHEN {column} < {lo} THEN '{labels[0]}' WHEN {column} BETWEEN {lo} AND {hi} "
            f"THEN '{labels[1]}' ELSE '{labels[2]}' END")
    return f"""
SELECT {case} AS {name}, COUNT(*) AS total_records, {FAILS} AS failures,
       {RATE} AS failure_rate_percentage
FROM raw GROUP BY {case} ORDER BY failure_rate_percentage DESC"""


register("eda_rate_by_wear_bin", _bin_sql("tool_wear_min", *eda.WEAR_BINS, "wear_category"))(
    lambda s, sf: eda.eda_rate_by_wear_bin(raw(s, sf)))
register("eda_rate_by_rpm_bin", _bin_sql("rotational_speed_rpm", *eda.RPM_BINS, "rpm_category"))(
    lambda s, sf: eda.eda_rate_by_rpm_bin(raw(s, sf)))
register("eda_rate_by_torque_bin", _bin_sql("torque_nm", *eda.TORQUE_BINS, "torque_category"))(
    lambda s, sf: eda.eda_rate_by_torque_bin(raw(s, sf)))

register("eda_high_stress", f"""
SELECT COUNT(*) AS high_stress_cases, {FAILS} AS failures,
       CASE WHEN COUNT(*) = 0 THEN NULL ELSE {RATE} END AS failure_rate_percentage
FROM raw WHERE rotational_speed_rpm > 1800 AND torque_nm > 60""")(
    lambda s, sf: eda.eda_high_stress(raw(s, sf)))

register("eda_top_risk_products", f"""
SELECT product_id, COUNT(*) AS total_records, {FAILS} AS failure_count
FROM raw GROUP BY product_id ORDER BY failure_count DESC, product_id LIMIT 10""")(
    lambda s, sf: eda.eda_top_risk_products(raw(s, sf)))

register("eda_outlier_extrema", """
SELECT MIN(rotational_speed_rpm) AS min_rpm, MAX(rotational_speed_rpm) AS max_rpm,
       MIN(torque_nm) AS min_torque, MAX(torque_nm) AS max_torque,
       MIN(tool_wear_min) AS min_tool_wear, MAX(tool_wear_min) AS max_tool_wear
FROM raw""")(lambda s, sf: eda.eda_outlier_extrema(raw(s, sf)))


def _diff_sql(agg: str) -> str:
    parts = []
    for col_name, label in eda.SENSOR_LABELS.items():
        parts.append(
            f"SELECT '{label}' AS sensor, CAST(ROUND(ABS({agg}(CASE WHEN target = 1 THEN {col_name} END) - "
            f"{agg}(CASE WHEN target = 0 THEN {col_name} END)), 4) AS DOUBLE) AS difference FROM raw")
    return " UNION ALL ".join(parts)


register("eda_sensor_differentiator", _diff_sql("MAX"))(
    lambda s, sf: eda.eda_sensor_differentiator(raw(s, sf), "max"))
register("eda_sensor_differentiator_avg", _diff_sql("AVG"))(
    lambda s, sf: eda.eda_sensor_differentiator(raw(s, sf), "avg"))

_KINDS = [("numeric", ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm",
                       "tool_wear_min", "target", "temperature_diff", "mechanical_stress", "high_stress_flag"]),
          ("categorical", ["machine_type", "wear_category", "failure_type"])]
register("select_types", " UNION ALL ".join(
    f"SELECT '{f}' AS column, '{kind}' AS kind, COUNT({f}) AS non_null FROM feat"
    for kind, names in _KINDS for f in names))(lambda s, sf: features.column_kinds(featured(s, sf)))
