"""Registered split, folds, scaler, k-NN and SMOTE queries.

The split and folds are registered in their oracle mode (``hash_kind='arith'``, a hash
DuckDB can compute); the library default is ``xxhash64``.  The k-NN query runs on the
five raw sensor readings of the training split, whose distances both engines compute
bit-identically.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlab.functions.exprs import counter_random_sql
from sensorlab.operators import sampling
from sensorlab.plans import preprocess
from sensorlab.plans.catalog_sql import unique_featured
from sensorlab.plans.registry import register
from sensorlab.schema import SENSORS
from sensorlab.session import cut_lineage

c = F.col
SEED = 42


def prep_binary(s, sf):
    return preprocess.prepared_frame(unique_featured(s, sf), "binary")


def train_part(s, sf, materialize=False):
    return preprocess.split(prep_binary(s, sf), SEED, "arith", materialize=materialize)[0]


_PREP_SQL = """p AS (
  SELECT udi, CAST(CASE upper(machine_type) WHEN 'L' THEN 0 WHEN 'M' THEN 1 WHEN 'H' THEN 2 END AS DOUBLE)
           AS machine_type,
         CAST(air_temperature_k AS DOUBLE) AS air_temperature_k,
         CAST(process_temperature_k AS DOUBLE) AS process_temperature_k,
         CAST(rotational_speed_rpm AS DOUBLE) AS rotational_speed_rpm, CAST(torque_nm AS DOUBLE) AS torque_nm,
         CAST(tool_wear_min AS DOUBLE) AS tool_wear_min, CAST(temperature_diff AS DOUBLE) AS temperature_diff,
         CAST(mechanical_stress AS DOUBLE) AS mechanical_stress,
         CAST(CASE wear_category WHEN 'High' THEN 0 WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 END AS DOUBLE)
           AS wear_category,
         CAST(high_stress_flag AS DOUBLE) AS high_stress_flag, CAST(target AS DOUBLE) AS label
  FROM ufeat WHERE upper(machine_type) IN ('L', 'M', 'H')),
h AS (SELECT *, ((udi % 1000003) * 7919 + 42 * 104729) % 1000003 AS h FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h % 1024, h, udi) AS rn,
             COUNT(*) OVER (PARTITION BY label) AS n_c FROM h),
s AS (SELECT *, rn <= FLOOR(CAST(0.2 AS DOUBLE) * n_c + 0.5) AS is_test,
             rn - FLOOR(CAST(0.2 AS DOUBLE) * n_c + 0.5) AS train_rank FROM r),
train AS (SELECT * FROM s WHERE NOT is_test)"""

register("stratified_split", f"WITH {_PREP_SQL} SELECT udi, label, is_test FROM s")(
    lambda s, sf: sampling.stratified_split(cut_lineage(prep_binary(s, sf)), hash_kind="arith").select("udi", "label", "is_test"))

register("stratified_folds", f"""WITH {_PREP_SQL}
SELECT udi, label, CAST((train_rank - 1) % 5 AS INT) AS fold FROM train""")(
    lambda s, sf: sampling.stratified_folds(train_part(s, sf, materialize=True), k=5, hash_kind="arith")
    .select("udi", "label", "fold"))

_F = preprocess.NUMERIC_FEATURES
register("standard_scale", f"""WITH {_PREP_SQL},
st AS (SELECT {", ".join(f"AVG({f}) AS m_{f}, STDDEV_POP({f}) AS s_{f}" for f in _F)} FROM train)
SELECT udi, label, {", ".join(
    f"ROUND(({f} - m_{f}) / CASE WHEN s_{f} = 0 OR s_{f} IS NULL THEN 1 ELSE s_{f} END, 6) AS {f}" for f in _F)}
FROM train, st""")(
    lambda s, sf: _scaled(s, sf))


def _scaled(s, sf):
    tr = train_part(s, sf, materialize=True)  # read by the fit and by the transform
    return sampling.fit_standard_scaler(tr, _F).transform(tr, digits=6).select("udi", "label", *_F)

_DIST = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in SENSORS)
register("knn_within_class", f"""WITH {_PREP_SQL},
pairs AS (SELECT a.udi, b.udi AS neighbor_udi, SQRT({_DIST}) AS distance
          FROM train a JOIN train b ON a.label = b.label AND a.udi <> b.udi),
rk AS (SELECT *, row_number() OVER (PARTITION BY udi ORDER BY distance, neighbor_udi) AS rank FROM pairs)
SELECT udi, neighbor_udi, CAST(rank AS INT) AS rank, ROUND(distance, 6) AS distance FROM rk WHERE rank <= 5""")(
    lambda s, sf: _knn(s, sf))


def _knn(s, sf):
    from sensorlab.functions.exprs import dround
    nn = sampling.knn_within_class(train_part(s, sf, materialize=True), SENSORS, k=5, materialized=True)
    return nn.withColumn("distance", dround("distance", 6))


register("class_balance", f"""WITH {_PREP_SQL},
b AS (SELECT label, COUNT(*) AS before FROM train GROUP BY label)
SELECT label, before, (SELECT MAX(before) FROM b) AS after FROM b""")(
    lambda s, sf: _class_balance(s, sf))


def _class_balance(s, sf):
    tr = train_part(s, sf, materialize=True)
    scaler = sampling.fit_standard_scaler(tr, _F)
    bal = sampling.smote(scaler.transform(tr), _F, seed=SEED, materialized=True)
    return sampling.class_balance(tr, bal)


_PREP_MC_SQL = (_PREP_SQL.replace("CAST(target AS DOUBLE) AS label", "failure_type AS label")
                .replace("IN ('L', 'M', 'H'))", "IN ('L', 'M', 'H') AND failure_type IS NOT NULL)"))


def _z(features):
    return ", ".join(f"ROUND(({f} - m_{f}) / CASE WHEN s_{f} = 0 OR s_{f} IS NULL THEN 1 ELSE s_{f} END, 6) AS {f}"
                     for f in features)


def _stats(features):
    return f"st AS (SELECT {', '.join(f'AVG({f}) AS m_{f}, STDDEV_POP({f}) AS s_{f}' for f in features)} FROM train)"


def _smote_sql(prep_sql, scaled, stats, features):
    """The training rows and the synthetic ones: base row, neighbour and share from the same
    counter-based generator, ranks from the same integer hash.  A class of at most 5 rows has as many
    neighbours as it can."""
    gap = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in features)
    return f"""WITH {prep_sql},
{stats},
z AS (SELECT udi, label, {scaled} FROM train, st),
n AS (SELECT label, COUNT(*) AS n_c, MAX(COUNT(*)) OVER () - COUNT(*) AS need FROM z GROUP BY label),
need AS (SELECT *, COALESCE(SUM(need) OVER (ORDER BY CAST(label AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS start FROM n),
idx AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY ((udi % 1000003) * 7919 + {SEED} * 104729) % 1000003, udi) - 1
        AS idx FROM z),
pairs AS (SELECT a.udi, b.udi AS nb, SQRT({gap}) AS distance FROM z a JOIN z b ON a.label = b.label AND a.udi <> b.udi
          WHERE a.label IN (SELECT label FROM need WHERE need > 0)),
nn AS (SELECT udi, nb, row_number() OVER (PARTITION BY udi ORDER BY distance, nb) AS rank FROM pairs),
ids AS (SELECT label, n_c, CAST(start + i AS BIGINT) AS sid
        FROM (SELECT *, unnest(range(CAST(need AS BIGINT))) AS i FROM need)),
syn AS (SELECT label, sid, {counter_random_sql("sid", SEED)} % n_c AS idx, {counter_random_sql("sid", SEED + 1)} % LEAST(5, n_c - 1) + 1 AS rank,
               CAST({counter_random_sql("sid", SEED + 2)} % 1048576 AS DOUBLE) / 1048576 AS u FROM ids)
SELECT udi, label, {", ".join(features)}, FALSE AS is_synthetic FROM z
UNION ALL
SELECT -(sid + 1), s.label, {", ".join(f"x.{f} + u * (y.{f} - x.{f})" for f in features)}, TRUE
FROM syn s JOIN idx x ON s.label = x.label AND s.idx = x.idx JOIN nn ON nn.udi = x.udi AND nn.rank = s.rank
JOIN z y ON y.udi = nn.nb"""


register("smote", _smote_sql(_PREP_SQL, _z(_F), _stats(_F), _F))(lambda s, sf: _smote(s, sf))


def _smote(s, sf):
    tr = train_part(s, sf, materialize=True)
    scaler = sampling.fit_standard_scaler(tr, _F)
    return sampling.smote(scaler.transform(tr, 6), _F, seed=SEED, materialized=True, hash_kind="arith")


for _task, _sql in [("binary", _PREP_SQL), ("multiclass", _PREP_MC_SQL)]:
    register(f"preprocess_train_{_task}", _smote_sql(_sql, _z(_F), _stats(_F), _F))(
        lambda s, sf, _t=_task: preprocess.preprocess_pipeline(
            unique_featured(s, sf), _t, SEED, "arith", digits=6, k_cap=True).train)


# ---------------------------------------------------------------- typed one-hot pipeline
_TYPED_NUMERIC = [f for f in _F if f not in ("machine_type", "wear_category")]
# the one-hot columns: feature, category, its code in the prepared table
_DUMMIES = [("machine_type", "L", 0), ("machine_type", "M", 1), ("wear_category", "Low", 1), ("wear_category", "Medium", 2)]


def _typed_sql(prep_sql):
    dummies = _DUMMIES
    return f"""WITH {prep_sql},
st AS (SELECT {", ".join(f"AVG({f}) AS m_{f}, STDDEV_POP({f}) AS s_{f}" for f in _TYPED_NUMERIC)} FROM train)
SELECT udi, label, {", ".join(
        f"ROUND(({f} - m_{f}) / CASE WHEN s_{f} = 0 OR s_{f} IS NULL THEN 1 ELSE s_{f} END, 6) AS {f}"
        for f in _TYPED_NUMERIC)},
       {", ".join(f"CAST({f} = {code} AS INT) AS {f}_{v}" for f, v, code in dummies)}
FROM s, st WHERE is_test"""


def _typed_test(s, sf, task):
    from sensorlab.functions.exprs import dround
    prep = preprocess.typed_pipeline(unique_featured(s, sf), task, SEED, "arith", oversample=False)
    dummies = [f for f in prep.features if f not in _TYPED_NUMERIC]
    return prep.test.select("udi", "label", *[dround(f, 6).alias(f) for f in _TYPED_NUMERIC],
                            *[c(f).cast("int").alias(f) for f in dummies])


for _task, _sql in [("binary", _PREP_SQL), ("multiclass", _PREP_MC_SQL)]:
    register(f"preprocess_typed_test_{_task}", _typed_sql(_sql))(
        lambda s, sf, _t=_task: _typed_test(s, sf, _t))
    register(f"preprocess_typed_train_{_task}", _smote_sql(
        _sql, ", ".join([_z(_TYPED_NUMERIC), *[f"CAST({f} = {code} AS DOUBLE) AS {f}_{v}" for f, v, code in _DUMMIES]]),
        _stats(_TYPED_NUMERIC), _TYPED_NUMERIC + [f"{f}_{v}" for f, v, _ in _DUMMIES]))(
        lambda s, sf, _t=_task: preprocess.typed_pipeline(unique_featured(s, sf), _t, SEED, "arith", digits=6, k_cap=True).train)
