"""Hand-sized fixtures (FIXTURES.md F4): edges, ties, empty input, NULLs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlab.functions.ordered import exact_quantiles, running_totals
from sensorlab.operators import eda, evaluate, features, profile, sampling
from sensorlab.schema import SENSOR_SCHEMA


def _sensor_rows(spark, rows):
    return spark.createDataFrame(rows, SENSOR_SCHEMA)


def test_quartiles_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 10]], "v double")
    q = {r["p"]: r["quantile"] for r in exact_quantiles(df, "v", [0.25, 0.5, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 4.75}


def test_describe_std_is_sample_std(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 10]], "v double")
    r = profile.describe_numeric(df, ["v"], digits=4).first()
    assert r["std"] == pytest.approx(4.0825, abs=1e-4)
    assert (r["q25"], r["q50"], r["q75"]) == (1.75, 2.5, 4.75)


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 10]], "v double")
    m = sampling.fit_standard_scaler(df, ["v"])
    assert m.stds["v"] == pytest.approx(3.5355, abs=1e-4)


def test_quantiles_many_ranges_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 500, 3000).astype(float)
    groups = rng.integers(0, 3, 3000)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, v double")
    import sensorlab.functions.ordered as od
    old = od.ROWS_PER_RANGE
    od.ROWS_PER_RANGE = 50  # force many ranges
    try:
        got = exact_quantiles(df, "v", [0.1, 0.25, 0.5, 0.9], groups=["g"]).collect()
    finally:
        od.ROWS_PER_RANGE = old
    for r in got:
        want = np.percentile(vals[groups == r["g"]], r["p"] * 100)
        assert r["quantile"] == pytest.approx(want, abs=1e-9)


def test_running_totals_ranges_equal_cumsum(spark):
    vals = list(range(1, 401))
    df = spark.createDataFrame([(float(v), 1) for v in vals], "x double, n int")
    out = running_totals(df, "x", ["n"], n_ranges=7).orderBy("x").collect()
    assert [r["n_cum"] for r in out] == list(range(1, 401))


def test_running_totals_split_a_tied_value_by_key(spark):
    import sensorlab.functions.ordered as od
    rows = [(5.0, k, 1) for k in range(200)] + [(float(v), 1000 + v, 1) for v in range(10)]
    df = spark.createDataFrame(rows, "x double, k int, n int")
    bounds = od.range_bounds(df, "x", 8)
    parts = df.where("x = 5").select(od._tie_part(bounds, "x", ["k"])).distinct().count()
    assert bounds.count(5.0) > 1 and parts == bounds.count(5.0)
    out = running_totals(df, "x", ["n"], n_ranges=8, tiebreak=["k"]).orderBy("n_cum").collect()
    assert [r["n_cum"] for r in out] == list(range(1, 211))
    assert [r["x"] for r in out] == sorted(r["x"] for r in out)


def test_running_totals_keep_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 1), ("a", 1.0, 1)], "g string, x double, n int")
    out = running_totals(df, "x", ["n"], groups=["g"]).collect()
    assert sorted((r["g"] or "", r["x"], r["n_cum"]) for r in out) == [("", 1.0, 1), ("", 2.0, 2), ("a", 1.0, 1)]


def test_running_totals_of_no_rows(spark):
    df = spark.createDataFrame([], "x double, n int")
    assert running_totals(df, "x", ["n"]).collect() == []


def test_pivot_keeps_unknown_classes(spark):
    rows = [("M", "Power Failure"), ("M", "Rust"), ("L", "Rust"), (None, "Rust"), ("L", None)]
    df = spark.createDataFrame(rows, "machine_type string, failure_type string")
    got = {r["machine_type"]: r.asDict() for r in profile.pivot_type_failure(df).collect()}
    assert (got["M"]["Power Failure"], got["M"]["Rust"]) == (1, 1)
    assert (got["L"]["Power Failure"], got["L"]["Rust"]) == (0, 1)
    assert set(got) == {"M", "L"}


def test_unscored_rows_count_in_support_only(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, 0), (0, 1)], "label int, prediction int")
    pc = {r["class"]: r for r in evaluate.per_class(df).collect()}
    assert (pc[1]["support"], pc[1]["tp"], pc[1]["predicted"]) == (2, 1, 2)
    assert (pc[0]["support"], pc[0]["tp"], pc[0]["predicted"]) == (2, 1, 1)
    assert set(pc) == {0, 1}


def test_bin_edges_inclusive(spark):
    from sensorlab.functions.exprs import band
    df = spark.createDataFrame([(49,), (50,), (150,), (151,)], "w int")
    got = [r[0] for r in df.select(band("w", 50, 150, ["L", "M", "H"])).collect()]
    assert got == ["L", "M", "M", "H"]
    t = spark.createDataFrame([(39.9,), (40.0,), (60.0,), (60.1,)], "t double")
    assert [r[0] for r in t.select(band("t", 40, 60, ["a", "b", "c"])).collect()] == ["a", "b", "b", "c"]


def test_auc_all_tied_is_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert evaluate.roc_auc(df).first()[0] == 0.5


def test_auc_matches_pairwise_definition(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500)
    s = np.round(rng.random(500), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(want, abs=1e-6)


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a")], "label string, prediction string")
    pc = {r["class"]: r for r in evaluate.per_class(df).collect()}
    assert pc["b"]["precision"] == 0.0 and pc["b"]["f1"] == 0.0
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(1 / 3, abs=1e-6)


def test_smote_raises_on_tiny_class(spark):
    rows = [(i, 0 if i < 20 else 1, float(i), float(i % 7)) for i in range(23)]
    df = spark.createDataFrame(rows, "udi long, label int, a double, b double")
    with pytest.raises(ValueError):
        sampling.smote(df, ["a", "b"], k=5)


def test_name_normaliser():
    assert features.normalize_name("Air temperature [K]") == "air_temperature_k"
    assert features.normalize_name(" Type ") == "type"
    assert features.normalize_name("Rotational speed [rpm]") == "rotational_speed_rpm"


def test_empty_table_rates_are_null(spark):
    empty = _sensor_rows(spark, [])
    assert eda.eda_failure_rate(empty).first()[0] is None
    r = eda.eda_high_stress(empty).first()
    assert r["high_stress_cases"] == 0 and r["failure_rate_percentage"] is None


def test_dround_matches_duckdb():
    import duckdb
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    from sensorlab.functions.exprs import dround
    vals = [75962.525, 2.675, 1.005, -2.5, 0.125, 123456.785]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(dround("v", 2)).collect()]
    want = [duckdb.sql(f"SELECT ROUND({v!r}::DOUBLE, 2)").fetchall()[0][0] for v in vals]
    assert got == want
