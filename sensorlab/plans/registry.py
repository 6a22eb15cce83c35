"""Registry of named queries: a Spark plan and, where SQL can express it, a DuckDB oracle.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver's
tables (the sensor table is derived from ``events``).  The oracle text runs in DuckDB
with the driver tables registered as views; the shared view definitions below mirror
the Spark-side ``fix_labels → clean_view → feature_view`` chain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorlab.sources.fixture import sensor_sql

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = with_views(oracle)
        return fn
    return deco


# Shared oracle views, in dependency order.  DuckDB only evaluates the ones a query uses.
BASE_VIEWS = [
    ("raw", sensor_sql("events")),
    ("fixed", """
SELECT udi, product_id, machine_type, air_temperature_k, process_temperature_k,
       rotational_speed_rpm, torque_nm, tool_wear_min, target,
       CASE WHEN target = 0 THEN NULL
            WHEN target = 1 AND failure_type = 'No Failure' THEN 'Unspecified Failure'
            ELSE failure_type END AS failure_type
FROM raw"""),
    ("clean", """
SELECT * FROM fixed
WHERE rotational_speed_rpm > 0 AND torque_nm > 0
  AND air_temperature_k BETWEEN 200 AND 400
  AND process_temperature_k BETWEEN 200 AND 400"""),
    ("feat", """
SELECT udi, product_id, machine_type, air_temperature_k, process_temperature_k,
       rotational_speed_rpm, torque_nm, tool_wear_min, target,
       process_temperature_k - air_temperature_k AS temperature_diff,
       rotational_speed_rpm * torque_nm AS mechanical_stress,
       CASE WHEN tool_wear_min < 50 THEN 'Low'
            WHEN tool_wear_min BETWEEN 50 AND 150 THEN 'Medium' ELSE 'High' END AS wear_category,
       CASE WHEN rotational_speed_rpm > 1800 AND torque_nm > 60 THEN 1 ELSE 0 END AS high_stress_flag,
       failure_type
FROM clean"""),
    ("uniq", """
SELECT udi, product_id, machine_type, air_temperature_k, process_temperature_k,
       rotational_speed_rpm, torque_nm, tool_wear_min, target, failure_type
FROM (SELECT *, row_number() OVER (
        PARTITION BY udi
        ORDER BY air_temperature_k NULLS FIRST, process_temperature_k NULLS FIRST,
                 rotational_speed_rpm NULLS FIRST, torque_nm NULLS FIRST,
                 tool_wear_min NULLS FIRST, product_id NULLS FIRST, machine_type NULLS FIRST,
                 target NULLS FIRST, failure_type NULLS FIRST) AS rn
      FROM clean) t
WHERE rn = 1"""),
    ("ufeat", """
SELECT udi, product_id, machine_type, air_temperature_k, process_temperature_k,
       rotational_speed_rpm, torque_nm, tool_wear_min, target,
       process_temperature_k - air_temperature_k AS temperature_diff,
       rotational_speed_rpm * torque_nm AS mechanical_stress,
       CASE WHEN tool_wear_min < 50 THEN 'Low'
            WHEN tool_wear_min BETWEEN 50 AND 150 THEN 'Medium' ELSE 'High' END AS wear_category,
       CASE WHEN rotational_speed_rpm > 1800 AND torque_nm > 60 THEN 1 ELSE 0 END AS high_stress_flag,
       failure_type
FROM uniq"""),
    ("bscore", """
SELECT udi, machine_type, target AS label,
       LEAST(CAST(1 AS DOUBLE), tool_wear_min * torque_nm / 16000) AS score,
       CASE WHEN tool_wear_min * torque_nm / 16000 >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM clean"""),
    ("mscore", """
SELECT udi, machine_type, failure_type AS label,
       CASE WHEN rotational_speed_rpm > 1800 THEN 'Power Failure'
            WHEN tool_wear_min > 150 THEN 'Overstrain Failure'
            ELSE 'Heat Dissipation Failure' END AS prediction
FROM clean WHERE target = 1"""),
    ("preds", """
SELECT *, CASE WHEN risk_score < 0.3 THEN 'Low' WHEN risk_score < 0.7 THEN 'Medium' ELSE 'High' END AS risk_band
FROM (SELECT f.*, LEAST(CAST(1 AS DOUBLE), tool_wear_min * torque_nm / 16000) AS risk_score,
             CASE WHEN tool_wear_min * torque_nm / 16000 >= 0.5 THEN 1 ELSE 0 END AS prediction
      FROM feat f) p"""),
]


def with_views(body: str) -> str:
    """Prefix ``body`` (which may start with its own ``WITH``) with the shared views."""
    ctes = [f"{name} AS ({sql.strip()})" for name, sql in BASE_VIEWS]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
