"""Registered source / sink queries.

Queries that exercise a file format write data Spark derived from the driver tables into
the session's checkpoint folder (the shared folder on a cluster) and read it back.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from sensorlab.operators import features
from sensorlab.plans import dashboard
from sensorlab.plans.catalog_sql import cleaned, featured, raw
from sensorlab.plans.registry import register
from sensorlab.session import app_id, checkpoint_dir
from sensorlab.sources import io
from sensorlab.sources.fixture import add_f2_scores, scored_binary, scored_multiclass

c = F.col


def _scratch(spark, sf: str, name: str) -> str:
    tag = hashlib.sha1(f"{app_id(spark)}:{sf}".encode()).hexdigest()[:10]
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{tag}/{name}"


def _csv_roundtrip(s, sf):
    path = _scratch(s, sf, "machine_sensor_data_csv")
    raw(s, sf).write.mode("overwrite").option("header", True).csv(path)
    return io.load_csv(s, path)


register("load_csv", "SELECT * FROM raw")(lambda s, sf: _csv_roundtrip(s, sf).drop(io.CORRUPT))

_REASONS_SQL = """concat_ws(',',
  CASE WHEN udi IS NULL THEN 'udi_not_null' END,
  CASE WHEN product_id IS NULL THEN 'product_id_not_null' END,
  CASE WHEN NOT COALESCE(machine_type IN ('L', 'M', 'H'), TRUE) THEN 'machine_type_check' END,
  CASE WHEN air_temperature_k IS NULL THEN 'air_temperature_k_not_null' END,
  CASE WHEN process_temperature_k IS NULL THEN 'process_temperature_k_not_null' END,
  CASE WHEN rotational_speed_rpm IS NULL THEN 'rotational_speed_rpm_not_null' END,
  CASE WHEN NOT COALESCE(rotational_speed_rpm > 0, TRUE) THEN 'rotational_speed_rpm_check' END,
  CASE WHEN torque_nm IS NULL THEN 'torque_nm_not_null' END,
  CASE WHEN NOT COALESCE(torque_nm > 0, TRUE) THEN 'torque_nm_check' END,
  CASE WHEN tool_wear_min IS NULL THEN 'tool_wear_min_not_null' END,
  CASE WHEN NOT COALESCE(tool_wear_min >= 0, TRUE) THEN 'tool_wear_min_check' END,
  CASE WHEN target IS NULL THEN 'target_not_null' END,
  CASE WHEN NOT COALESCE(target IN (0, 1), TRUE) THEN 'target_check' END,
  CASE WHEN dup THEN 'udi_primary_key' END)"""
_SPLIT_SQL = f"""
WITH d AS (SELECT udi, TRUE AS dup FROM raw GROUP BY udi HAVING COUNT(*) > 1),
j AS (SELECT r.*, {_REASONS_SQL} AS reject_reasons FROM raw r LEFT JOIN d USING (udi))"""

register("constraint_split", _SPLIT_SQL + " SELECT * FROM j WHERE reject_reasons <> ''")(
    lambda s, sf: io.split_valid(raw(s, sf))[1])
register("constraint_split_valid", _SPLIT_SQL + " SELECT * EXCLUDE (reject_reasons) FROM j WHERE reject_reasons = ''")(
    lambda s, sf: io.split_valid(raw(s, sf))[0])


def _load_features(s, sf):
    path = _scratch(s, sf, "feature_view_parquet")
    featured(s, sf).write.mode("overwrite").parquet(path)
    return io.load_features(s, path)


register("load_features", "SELECT * FROM feat")(_load_features)

register("preview_shape", "SELECT COUNT(*) AS rows, 10 AS columns FROM raw")(
    lambda s, sf: io.preview_shape(raw(s, sf)))
register("preview_head", "SELECT * FROM raw ORDER BY udi LIMIT 5")(
    lambda s, sf: io.preview_head(raw(s, sf)))

register("normalize_names", """
SELECT udi, product_id, machine_type AS type, air_temperature_k, process_temperature_k,
       rotational_speed_rpm, torque_nm, tool_wear_min, target, failure_type FROM raw""")(
    lambda s, sf: features.normalize_names(io.with_headers(raw(s, sf))))


def _export(s, sf):
    """Write the risk-band extract as CSV and read it back with its own schema."""
    preds = dashboard.predictions_table(add_f2_scores(featured(s, sf)))
    ds = dashboard.dash_risk_bands(preds)
    path = _scratch(s, sf, "DS_risk_bands_csv")
    io.export_dataset(ds, path, partitions=1)
    return s.read.schema(ds.schema).option("header", True).csv(path)


register("export_dashboard_csv", """
SELECT risk_band, COUNT(*) AS machines, ROUND(AVG(risk_score), 4) AS avg_probability,
       MAX(risk_score) AS max_probability, COUNT(*) FILTER (WHERE target = 1) AS failures
FROM preds GROUP BY risk_band""")(_export)


def _export_all(s, sf):
    """Write every dashboard extract as CSV, read each back typed, count its rows."""
    clean = cleaned(s, sf)
    out = None
    for name, ds in dashboard.extracts(dashboard.predictions_table(add_f2_scores(featured(s, sf))),
                                       scored_binary(clean), scored_multiclass(clean)).items():
        path = _scratch(s, sf, name)
        io.export_dataset(ds, path)
        back = s.read.schema(ds.schema).option("header", True).csv(path)
        rows = back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("extract"), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


register("export_dashboard_extracts", """
SELECT 'DS1_predictions' AS extract, COUNT(*) AS rows FROM preds
UNION ALL SELECT 'DS3_risk_bands', COUNT(DISTINCT risk_band) FROM preds
UNION ALL SELECT 'DS4_predicted_types', COUNT(DISTINCT prediction) FROM mscore
UNION ALL SELECT 'DS5_f1_by_type', COUNT(DISTINCT k) FROM
  (SELECT label AS k FROM mscore UNION ALL SELECT prediction FROM mscore)
UNION ALL SELECT 'DS6_confusion_matrix', COUNT(DISTINCT k) * COUNT(DISTINCT k) FROM
  (SELECT label AS k FROM bscore UNION ALL SELECT prediction FROM bscore)""")(_export_all)
