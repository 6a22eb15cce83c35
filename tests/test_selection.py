"""Exact cut-offs of the split, neighbours across ranges, the thinned curve, and the counter-based generator."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlab.functions import exprs, ordered
from sensorlab.operators import evaluate, sampling
from sensorlab.session import cut_lineage


def rows(spark, n, seed=0, null=False):
    rng = random.Random(seed)
    data = [(i * 7 + 1, rng.choice(["a", "a", "a", "b", None if null else "b"])) for i in range(n)]
    return data, spark.createDataFrame(data, "udi long, label string")


@pytest.mark.parametrize("kind", ["arith", "xxhash64"])
@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_split_takes_the_first_rows_of_each_class(spark, kind, buckets):
    data, df = rows(spark, 400, 3, null=True)
    marked = sampling.stratified_split(df, hash_kind=kind, buckets=buckets)
    order = {r["udi"]: (r["b"], r["h"], r["udi"]) for r in df.select(
        "udi", exprs.key_hash("udi", 42, kind).alias("h")).withColumn("b", F.pmod("h", F.lit(buckets))).collect()}
    got = {r["udi"]: r["is_test"] for r in marked.collect()}
    for label in {x for _, x in data}:
        mine = sorted((u for u, x in data if x == label), key=order.get)
        quota = math.floor(0.2 * len(mine) + 0.5)
        assert [u for u in mine if got[u]] == mine[:quota]
    assert len(got) == len(data)


@pytest.mark.parametrize("fraction, share", [(0.0, 0), (1.0, 1), (0.001, 0)])
def test_split_of_all_or_nothing(spark, fraction, share):
    data, df = rows(spark, 60)
    got = sampling.stratified_split(df, test_fraction=fraction).where("is_test").count()
    assert got == share * len(data)
    assert sampling.stratified_split(df.limit(0)).collect() == []


def test_split_moves_no_row(spark):
    _, df = rows(spark, 200)
    plan = sampling.stratified_split(cut_lineage(df), hash_kind="arith")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("n_ranges", [1, 3, 40])
def test_previous_values_cross_range_borders(spark, n_ranges):
    rng = random.Random(n_ranges)
    values = sorted({round(rng.choice([rng.random(), 100 + rng.random()]), 3) for _ in range(120)})
    df = spark.createDataFrame([(v, i % 4) for i, v in enumerate(values)], "x double, n int").repartition(5)
    got = {r["x"]: (r["prev_x"], r["prev_n"]) for r in ordered.previous_values(df, "x", ["n"], n_ranges=n_ranges).collect()}
    assert got == {v: (values[i - 1], (i - 1) % 4) if i else (None, None) for i, v in enumerate(values)}


def thinned(pairs):
    scores = sorted({s for s, _ in pairs}, reverse=True)
    tps = np.cumsum([sum(y for s, y in pairs if s == t) for t in scores])
    fps = np.cumsum([sum(1 - y for s, y in pairs if s == t) for t in scores])
    keep = np.ones(len(scores), bool)
    if len(scores) > 2:
        keep = np.r_[True, (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), True]
    return {(float("inf"), 0.0, 0.0)} | {(scores[i], round(fps[i] / max(fps[-1], 1), 6), round(tps[i] / max(tps[-1], 1), 6))
                                         for i in np.flatnonzero(keep)}


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_thinned_curve(spark, n):
    rng = random.Random(n)
    pairs = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(n)]
    df = spark.createDataFrame(pairs, "score double, label int")
    got = {tuple(r) for r in evaluate.roc_curve(df, drop_collinear=True).collect()}
    assert got == thinned(pairs)
    assert got <= {tuple(r) for r in evaluate.roc_curve(df).collect()}


def test_counter_based_numbers(spark, duck):
    n = 20_000
    columns = ", ".join(f"{exprs.counter_random_sql('id', s)} AS r{s}" for s in (42, 43))
    got = spark.range(n).selectExpr("id", *columns.split(", ")).orderBy("id").toPandas()
    want = duck.sql(f"SELECT id, {columns} FROM (SELECT CAST(i AS BIGINT) AS id FROM range({n}) t(i)) ORDER BY id").df()
    assert (got.to_numpy() == want.to_numpy()).all()
    big = duck.sql(f"SELECT {exprs.counter_random_sql('CAST(9000000000000000000 AS BIGINT)', 44)}").fetchall()[0][0]
    assert 0 <= big < exprs.PRIME
    u = got[["r42", "r43"]].to_numpy() / exprs.PRIME
    assert abs(u.mean() - 0.5) < 0.01 and abs(np.corrcoef(u.T)[0, 1]) < 0.03
    assert abs(np.corrcoef(u[1:, 0], u[:-1, 0])[0, 1]) < 0.03
    cells = np.histogram2d(u[:, 0], u[:, 1], bins=10, range=[[0, 1], [0, 1]])[0]
    assert ((cells - 200) ** 2 / 200).sum() < 160          # chi-square of 99 degrees of freedom
