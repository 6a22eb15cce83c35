"""Registered distribution / correlation summaries on the feature view."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlab.operators import features, profile, quality
from sensorlab.plans.catalog_sql import featured, raw
from sensorlab.plans.registry import register
from sensorlab.schema import FAILURE_CLASSES, SENSORS

c = F.col


def _long_sql(columns, source="feat", keep=""):
    keep_sel = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {keep_sel}'{x}' AS column_name, CAST({x} AS DOUBLE) AS value FROM {source}"
        f" WHERE {x} IS NOT NULL" + (f" AND {keep} IS NOT NULL" if keep else "")
        for x in columns)


register("value_counts", """
SELECT failure_type, COUNT(*) AS "count",
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
FROM feat WHERE failure_type IS NOT NULL GROUP BY failure_type""")(
    lambda s, sf: profile.value_counts(featured(s, sf), "failure_type"))

register("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{x}' AS column_name, COUNT({x}) AS "count", ROUND(AVG(CAST({x} AS DOUBLE)), 2) AS mean,
       ROUND(STDDEV_SAMP(CAST({x} AS DOUBLE)), 2) AS std, ROUND(MIN(CAST({x} AS DOUBLE)), 2) AS "min",
       ROUND(quantile_cont(CAST({x} AS DOUBLE), 0.25), 2) AS q25,
       ROUND(quantile_cont(CAST({x} AS DOUBLE), 0.5), 2) AS q50,
       ROUND(quantile_cont(CAST({x} AS DOUBLE), 0.75), 2) AS q75, ROUND(MAX(CAST({x} AS DOUBLE)), 2) AS "max"
FROM feat""" for x in profile.DESCRIBE_COLUMNS))(
    lambda s, sf: profile.describe_numeric(featured(s, sf)))


def _hist_sql(columns, bins, by_class=False, source="feat"):
    keep = "failure_type" if by_class else ""
    g = "failure_type, column_name" if by_class else "column_name"
    dens = (f", ROUND(COALESCE(cnt.n, 0) / (e.total * ((e.hi - e.lo) / {bins})), 6) AS density"
            if by_class else "")
    return f"""
WITH lf AS ({_long_sql(columns, source, keep)}),
e AS (SELECT {g}, COUNT(*) AS total,
             CASE WHEN MIN(value) = MAX(value) THEN MIN(value) - 0.5 ELSE MIN(value) END AS lo,
             CASE WHEN MIN(value) = MAX(value) THEN MAX(value) + 0.5 ELSE MAX(value) END AS hi
      FROM lf GROUP BY {g}),
cnt AS (SELECT {g}, LEAST(CAST(FLOOR((value - lo) * {bins} / (hi - lo)) AS INT), {bins - 1}) AS bin,
               COUNT(*) AS n
        FROM lf JOIN e USING ({g}) GROUP BY ALL),
grid AS (SELECT {g}, total, lo, hi, CAST(UNNEST(range(0, {bins})) AS INT) AS bin FROM e)
SELECT {", ".join("e." + x for x in g.split(", "))}, e.bin,
       ROUND(e.lo + e.bin * ((e.hi - e.lo) / {bins}), 6) AS bin_lo,
       ROUND(e.lo + (e.bin + 1) * ((e.hi - e.lo) / {bins}), 6) AS bin_hi,
       COALESCE(cnt.n, 0) AS "count"{dens}
FROM grid e LEFT JOIN cnt USING ({g}, bin)"""


register("histogram", _hist_sql(SENSORS, 40))(
    lambda s, sf: profile.histogram(featured(s, sf), SENSORS, 40))

_CLASS_HIST_COLS = ["temperature_diff", "rpm_torque_ratio"]
register("histogram_by_class", _hist_sql(
    _CLASS_HIST_COLS, 30, by_class=True,
    source="(SELECT *, torque_nm / rotational_speed_rpm AS rpm_torque_ratio FROM feat) fr"))(
    lambda s, sf: profile.histogram_by_class(
        features.feature_view(quality.clean(raw(s, sf)), extra=["rpm_torque_ratio"]), _CLASS_HIST_COLS))


def _box_sql(by_class=False):
    keep = "failure_type" if by_class else ""
    g = "failure_type, column_name" if by_class else "column_name"
    inside = "value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)"
    body = f"""
WITH lf AS ({_long_sql(SENSORS, "feat", keep)}),
q AS (SELECT {g}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
             quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY {g}),
b AS (SELECT {g}, ROUND(q1, 4) AS q1, ROUND(med, 4) AS median, ROUND(q3, 4) AS q3, ROUND(q3 - q1, 4) AS iqr,
       ROUND(MIN(value) FILTER (WHERE {inside}), 4) AS whisker_low,
       ROUND(MAX(value) FILTER (WHERE {inside}), 4) AS whisker_high,
       COUNT(*) FILTER (WHERE NOT ({inside})) AS n_outliers
      FROM lf JOIN q USING ({g}) GROUP BY {g}, q.q1, q.med, q.q3)"""
    if not by_class:
        return body + "\nSELECT * FROM b"
    return body + """,
f AS (SELECT failure_type, COUNT(*) AS class_rows FROM feat WHERE failure_type IS NOT NULL GROUP BY failure_type),
r AS (SELECT failure_type, class_rows,
             CAST(row_number() OVER (ORDER BY class_rows DESC, failure_type) AS INT) AS class_rank FROM f)
SELECT * FROM b JOIN r USING (failure_type)"""


register("box_stats", _box_sql())(lambda s, sf: profile.box_stats(featured(s, sf)))
register("box_stats_by_class", _box_sql(by_class=True))(
    lambda s, sf: profile.box_stats_by_class(featured(s, sf)))

_CORR_COLS = SENSORS + ["target", "machine_type_code"]


def _corr_sql():
    src = ("(SELECT *, CASE upper(machine_type) WHEN 'L' THEN 0 WHEN 'M' THEN 1 WHEN 'H' THEN 2 END "
           "AS machine_type_code FROM feat) fc")
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[:i]:
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, "
                         f"ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) AS correlation FROM {src}")
    return " UNION ALL ".join(parts)


register("correlation_matrix", _corr_sql())(
    lambda s, sf: profile.correlation_matrix(
        featured(s, sf).withColumn("machine_type_code", features.encode_machine_type()), _CORR_COLS))

register("pivot_type_failure", "SELECT machine_type, " + ", ".join(
    f"COUNT(*) FILTER (WHERE failure_type = '{k}') AS \"{k}\"" for k in FAILURE_CLASSES)
    + " FROM feat WHERE machine_type IS NOT NULL AND failure_type IS NOT NULL GROUP BY machine_type")(
    lambda s, sf: profile.pivot_type_failure(featured(s, sf)))

register("eda_summary", """
WITH vc AS (SELECT failure_type, COUNT(*) AS n FROM feat
            WHERE target = 1 AND failure_type IS NOT NULL GROUP BY failure_type)
SELECT COUNT(*) AS records, 14 AS "columns",
       CAST(SUM((udi IS NULL)::INT + (product_id IS NULL)::INT + (machine_type IS NULL)::INT
           + (air_temperature_k IS NULL)::INT + (process_temperature_k IS NULL)::INT
           + (rotational_speed_rpm IS NULL)::INT + (torque_nm IS NULL)::INT + (tool_wear_min IS NULL)::INT
           + (target IS NULL)::INT + (temperature_diff IS NULL)::INT + (mechanical_stress IS NULL)::INT
           + (wear_category IS NULL)::INT + (high_stress_flag IS NULL)::INT
           + (failure_type IS NULL)::INT) AS BIGINT) AS missing_values,
       ROUND(CAST(100 AS DOUBLE) * SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) / COUNT(*), 2)
           AS failure_rate_percentage,
       (SELECT failure_type FROM vc ORDER BY n DESC, failure_type LIMIT 1) AS most_common_failure,
       (SELECT failure_type FROM vc ORDER BY n ASC, failure_type LIMIT 1) AS least_common_failure
FROM feat""")(lambda s, sf: profile.eda_summary(featured(s, sf)))
