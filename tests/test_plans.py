"""Plan checks: no Python UDF in SQL-side queries, pushdown and pruning
reach the parquet scan, aggregates are partial before their exchange."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(oracle_sql()) if n not in ("knn_within_class", "class_balance")])
def test_no_python_in_sql_queries(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert not any(node in plan for node in PY_NODES), name


def test_scan_pruned_to_used_columns(spark):
    plan = _plan(queries()["eda_rate_by_wear_bin"](spark, SF_SMALL))
    assert "ReadSchema: struct<tool_wear_min:int,target:int>" in plan


def test_derivation_prunes_events(spark):
    from sensorlab.sources.fixture import sensor_table
    plan = _plan(sensor_table(spark, SF_SMALL, materialize=False))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
    assert "props" not in plan and "ts:" not in plan


def test_high_stress_filter_reaches_scan(spark):
    df = queries()["eda_high_stress"](spark, SF_SMALL)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThan(rotational_speed_rpm,1800)" in plan and "GreaterThan(torque_nm,60.0)" in plan


def test_partial_aggregation_before_exchange(spark):
    df = queries()["dedupe_by_key"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_clean_filter_pushed_to_scan(spark, tmp_path):
    from sensorlab.operators import quality
    from sensorlab.sources.fixture import sensor_table
    path = str(tmp_path / "sensor")
    sensor_table(spark, SF_SMALL).write.parquet(path)
    df = quality.clean_view(spark.read.parquet(path))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(rotational_speed_rpm), IsNotNull(torque_nm)" in plan
    assert "GreaterThan(rotational_speed_rpm,0)" in plan
    assert "GreaterThanOrEqual(air_temperature_k,200.0)" in plan
