"""Fixed schema of the sensor table, its constraints, and the names used throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENSOR_SCHEMA = T.StructType([
    T.StructField("udi", T.LongType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("machine_type", T.StringType(), True),
    T.StructField("air_temperature_k", T.DoubleType(), False),
    T.StructField("process_temperature_k", T.DoubleType(), False),
    T.StructField("rotational_speed_rpm", T.IntegerType(), False),
    T.StructField("torque_nm", T.DoubleType(), False),
    T.StructField("tool_wear_min", T.IntegerType(), False),
    T.StructField("target", T.IntegerType(), False),
    T.StructField("failure_type", T.StringType(), True),
])

SENSOR_COLUMNS = [f.name for f in SENSOR_SCHEMA.fields]

# The five sensor readings, in table order.
SENSORS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm",
           "torque_nm", "tool_wear_min"]

# Columns the NULL check covers (every column except the key and the nullable label).
NULL_CHECKED = ["product_id", "machine_type", "air_temperature_k", "process_temperature_k",
                "rotational_speed_rpm", "torque_nm", "tool_wear_min", "target"]

# Label strings of the data set and the repair step.
NO_FAILURE = "No Failure"
UNSPECIFIED_FAILURE = "Unspecified Failure"
# The failure classes of the AI4I 2020 data after the label repair.
FAILURE_CLASSES = ["Heat Dissipation Failure", "Overstrain Failure", "Power Failure",
                   "Random Failures", "Tool Wear Failure", "Unspecified Failure"]
# Machine quality codes and their numeric encoding.
MACHINE_TYPE_CODES = {"L": 0, "M": 1, "H": 2}
# Validity range of both temperatures (kelvin) used by the clean view.
TEMP_MIN_K, TEMP_MAX_K = 200, 400

# Feature view columns (raw columns + engineered ones, failure_type carried through).
ENGINEERED = ["temperature_diff", "mechanical_stress", "wear_category", "high_stress_flag"]
FEATURE_VIEW_COLUMNS = SENSOR_COLUMNS[:9] + ENGINEERED + ["failure_type"]

# Model inputs after dropping ids and the other target (udi and product_id are ids).
MODEL_FEATURES = ["machine_type", "air_temperature_k", "process_temperature_k",
                  "rotational_speed_rpm", "torque_nm", "tool_wear_min",
                  "temperature_diff", "mechanical_stress", "wear_category", "high_stress_flag"]


def constraints() -> dict[str, Column]:
    """Row-level table constraints as predicates that must be TRUE for a valid row.

    CHECK constraints follow SQL semantics: a NULL operand passes the CHECK, so only
    the NOT NULL constraints reject NULLs.  The primary key (unique udi) is a set
    constraint and is handled by :func:`sensorlab.sources.io.split_valid`.
    """
    c = F.col
    return {
        "udi_not_null": c("udi").isNotNull(),
        "product_id_not_null": c("product_id").isNotNull(),
        "machine_type_check": F.coalesce(c("machine_type").isin("L", "M", "H"), F.lit(True)),
        "air_temperature_k_not_null": c("air_temperature_k").isNotNull(),
        "process_temperature_k_not_null": c("process_temperature_k").isNotNull(),
        "rotational_speed_rpm_not_null": c("rotational_speed_rpm").isNotNull(),
        "rotational_speed_rpm_check": F.coalesce(c("rotational_speed_rpm") > 0, F.lit(True)),
        "torque_nm_not_null": c("torque_nm").isNotNull(),
        "torque_nm_check": F.coalesce(c("torque_nm") > 0, F.lit(True)),
        "tool_wear_min_not_null": c("tool_wear_min").isNotNull(),
        "tool_wear_min_check": F.coalesce(c("tool_wear_min") >= 0, F.lit(True)),
        "target_not_null": c("target").isNotNull(),
        "target_check": F.coalesce(c("target").isin(0, 1), F.lit(True)),
    }
