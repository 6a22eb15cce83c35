"""Registered evaluation reports and dashboard datasets (§2.10).

Metric operators are checked on the F2 fixture: a fixed row-wise score over the clean
view (binary) and a rule-based failure-type prediction (multiclass), which DuckDB can
reproduce exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlab.operators import evaluate
from sensorlab.plans import dashboard
from sensorlab.plans.catalog_sql import cleaned, featured
from sensorlab.plans.registry import register
from sensorlab.sources.fixture import add_f2_scores, scored_binary, scored_multiclass

c = F.col

BINARY_NAMES = {0: "No Failure", 1: "Failure"}


def bscore(s, sf):
    return scored_binary(cleaned(s, sf))


def mscore(s, sf):
    return scored_multiclass(cleaned(s, sf))


def preds(s, sf):
    return dashboard.predictions_table(add_f2_scores(featured(s, sf)))


def _r(x, d=6):
    return f"ROUND({x}, {d})"


def _z(num, den):
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0)"


def _cm_sql(src):
    return f"""
WITH k AS (SELECT label AS k FROM {src} UNION SELECT prediction FROM {src}),
grid AS (SELECT a.k AS actual, b.k AS predicted FROM k a CROSS JOIN k b
         WHERE a.k IS NOT NULL AND b.k IS NOT NULL),
cnt AS (SELECT label AS actual, prediction AS predicted, COUNT(*) AS n FROM {src} GROUP BY 1, 2)
SELECT actual, predicted, COALESCE(n, 0) AS "count" FROM grid LEFT JOIN cnt USING (actual, predicted)"""


register("confusion_matrix", _cm_sql("bscore"))(lambda s, sf: evaluate.confusion_matrix(bscore(s, sf)))
register("confusion_matrix_multiclass", _cm_sql("mscore"))(
    lambda s, sf: evaluate.confusion_matrix(mscore(s, sf)))

_COUNTS = """(SELECT COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
        COUNT(*) FILTER (WHERE NOT (label = 1) AND prediction = 1) AS fp,
        COUNT(*) FILTER (WHERE label = 1 AND NOT (prediction = 1)) AS fn,
        COUNT(*) FILTER (WHERE NOT (label = 1) AND NOT (prediction = 1)) AS tn FROM {src}) k"""
_BIN_METRICS = (f"{_r(_z('tp + tn', 'tp + fp + fn + tn'))} AS accuracy, {_r(_z('tp', 'tp + fp'))} AS precision, "
                f"{_r(_z('tp', 'tp + fn'))} AS recall, {_r(_z('2 * tp', '2 * tp + fp + fn'))} AS f1")

register("metrics_binary", f"SELECT {_BIN_METRICS} FROM {_COUNTS.format(src='bscore')}")(
    lambda s, sf: evaluate.metrics_binary(bscore(s, sf)))

_PER_CLASS = """
bl AS (SELECT label AS class, COUNT(*) AS support, COUNT(*) FILTER (WHERE label = prediction) AS tp
       FROM {src} GROUP BY label),
bp AS (SELECT prediction AS class, COUNT(*) AS predicted FROM {src} GROUP BY prediction),
pc0 AS (SELECT class, COALESCE(tp, 0) AS tp, COALESCE(support, 0) AS support,
               COALESCE(predicted, 0) AS predicted
        FROM bl FULL OUTER JOIN bp USING (class) WHERE class IS NOT NULL),
pc AS (SELECT *, """ + _z("tp", "predicted") + " AS precision, " + _z("tp", "support") + " AS recall, " \
    + _z("2 * tp", "predicted + support") + " AS f1 FROM pc0)"

register("metrics_weighted", "WITH " + _PER_CLASS.format(src="mscore") + f"""
SELECT {_r(_z('SUM(tp)', 'SUM(support)'))} AS accuracy,
       {_r(_z('SUM(precision * support)', 'SUM(support)'))} AS precision,
       {_r(_z('SUM(recall * support)', 'SUM(support)'))} AS recall,
       {_r(_z('SUM(f1 * support)', 'SUM(support)'))} AS f1 FROM pc""")(
    lambda s, sf: evaluate.metrics_weighted(mscore(s, sf)))


def _report_sql(src, names=None):
    cls = "CAST(class AS VARCHAR)"
    if names:
        cls = "CASE " + " ".join(f"WHEN class = {k} THEN '{v}'" for k, v in names.items()) + f" ELSE {cls} END"
    return "WITH " + _PER_CLASS.format(src=src) + f""",
rep AS (
  SELECT {cls} AS class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pc
  UNION ALL SELECT 'accuracy', NULL, NULL, {_z('SUM(tp)', 'SUM(support)')}, CAST(SUM(support) AS BIGINT) FROM pc
  UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), CAST(SUM(support) AS BIGINT) FROM pc
  UNION ALL SELECT 'weighted avg', {_z('SUM(precision * support)', 'SUM(support)')},
         {_z('SUM(recall * support)', 'SUM(support)')}, {_z('SUM(f1 * support)', 'SUM(support)')},
         CAST(SUM(support) AS BIGINT) FROM pc)"""


register("classification_report", _report_sql("mscore") + f"""
SELECT class, {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1')} AS f1, support FROM rep""")(
    lambda s, sf: evaluate.classification_report(mscore(s, sf)))

register("classification_report_binary", _report_sql("bscore", BINARY_NAMES) + f"""
SELECT class, {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1')} AS f1, support FROM rep""")(
    lambda s, sf: evaluate.classification_report(bscore(s, sf), names=BINARY_NAMES))

register("low_f1_classes", _report_sql("mscore") + f"""
SELECT class, {_r('f1')} AS f1, {_r('f1')} < 0.9 AS below_threshold FROM rep
WHERE class NOT IN ('accuracy', 'macro avg', 'weighted avg')""")(
    lambda s, sf: evaluate.low_f1_classes(evaluate.classification_report(mscore(s, sf))))

_SCORES = """s AS (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos,
       COUNT(*) FILTER (WHERE NOT (label = 1)) AS neg FROM bscore WHERE score IS NOT NULL GROUP BY score)"""

_AUC_SQL = f"""WITH {_SCORES},
cs AS (SELECT *, SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM s)
SELECT ROUND(SUM(pos * ((neg_cum - neg) + neg / 2.0)) / NULLIF(SUM(pos) * SUM(neg), 0), 6) AS roc_auc FROM cs"""
register("roc_auc", _AUC_SQL)(lambda s, sf: evaluate.roc_auc(bscore(s, sf)))

register("roc_curve", f"""WITH {_SCORES},
cs AS (SELECT *, SUM(pos) OVER w AS pos_cum, SUM(neg) OVER w AS neg_cum FROM s
       WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT SUM(pos) AS p_all, SUM(neg) AS n_all FROM s)
SELECT score AS threshold, {_r(_z('n_all - (neg_cum - neg)', 'n_all'))} AS fpr,
       {_r(_z('p_all - (pos_cum - pos)', 'p_all'))} AS tpr
FROM cs, t
UNION ALL SELECT CAST('Infinity' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""")(lambda s, sf: evaluate.roc_curve(bscore(s, sf)))

register("roc_curve_thinned", f"""WITH {_SCORES},
cs AS (SELECT *, SUM(pos) OVER w AS pos_cum, SUM(neg) OVER w AS neg_cum, LAG(pos) OVER v AS pos_below, LAG(neg) OVER v AS neg_below,
              LEAD(score) OVER v AS above
       FROM s WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), v AS (ORDER BY score)),
t AS (SELECT SUM(pos) AS p_all, SUM(neg) AS n_all FROM s)
SELECT score AS threshold, {_r(_z('n_all - (neg_cum - neg)', 'n_all'))} AS fpr,
       {_r(_z('p_all - (pos_cum - pos)', 'p_all'))} AS tpr
FROM cs, t WHERE pos_below IS NULL OR above IS NULL OR pos <> pos_below OR neg <> neg_below
UNION ALL SELECT CAST('Infinity' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""")(
    lambda s, sf: evaluate.roc_curve(bscore(s, sf), drop_collinear=True))

register("metrics_side_by_side", "WITH " + _PER_CLASS.format(src="mscore") + f""",
b AS (SELECT {_BIN_METRICS} FROM {_COUNTS.format(src='bscore')}),
m AS (SELECT {_r(_z('SUM(tp)', 'SUM(support)'))} AS accuracy,
             {_r(_z('SUM(precision * support)', 'SUM(support)'))} AS precision,
             {_r(_z('SUM(recall * support)', 'SUM(support)'))} AS recall,
             {_r(_z('SUM(f1 * support)', 'SUM(support)'))} AS f1 FROM pc),
{_SCORES},
cs AS (SELECT *, SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM s),
auc AS (SELECT ROUND(SUM(pos * ((neg_cum - neg) + neg / 2.0)) / NULLIF(SUM(pos) * SUM(neg), 0), 6) AS roc_auc FROM cs)
SELECT 'accuracy' AS metric, b.accuracy AS binary, m.accuracy AS multiclass FROM b, m
UNION ALL SELECT 'precision', b.precision, m.precision FROM b, m
UNION ALL SELECT 'recall', b.recall, m.recall FROM b, m
UNION ALL SELECT 'f1', b.f1, m.f1 FROM b, m
UNION ALL SELECT 'roc_auc', roc_auc, NULL FROM auc""")(
    lambda s, sf: evaluate.metrics_side_by_side(bscore(s, sf), mscore(s, sf)))

register("business_impact", f"""
SELECT tp + fn AS total_failures, tp AS caught,
       ROUND(CAST(100 AS DOUBLE) * tp / NULLIF(tp + fn, 0), 2) AS caught_pct, fn AS missed,
       ROUND(CAST(100 AS DOUBLE) * fn / NULLIF(tp + fn, 0), 2) AS missed_pct, fp AS false_alarms
FROM {_COUNTS.format(src='bscore')}""")(lambda s, sf: evaluate.business_impact(bscore(s, sf)))

# ---------------------------------------------------------------- 2.10 dashboards
register("dash_health_kpis", """
SELECT COUNT(*) AS total_machines, ROUND(AVG(tool_wear_min), 4) AS avg_tool_wear,
       ROUND(AVG(risk_score), 4) AS avg_risk_score,
       COUNT(*) FILTER (WHERE risk_band = 'High') AS high_risk_count FROM preds""")(
    lambda s, sf: dashboard.dash_health_kpis(preds(s, sf)))

register("dash_health_kpis_type_l", """
SELECT COUNT(*) AS total_machines, ROUND(AVG(tool_wear_min), 4) AS avg_tool_wear,
       ROUND(AVG(risk_score), 4) AS avg_risk_score,
       COUNT(*) FILTER (WHERE risk_band = 'High') AS high_risk_count FROM preds WHERE machine_type = 'L'""")(
    lambda s, sf: dashboard.dash_health_kpis(preds(s, sf), where=c("machine_type") == "L"))

register("dash_wear_stress_by_type", """
SELECT machine_type, ROUND(AVG(tool_wear_min), 4) AS avg_tool_wear,
       ROUND(AVG(mechanical_stress), 4) AS avg_mechanical_stress FROM feat GROUP BY machine_type""")(
    lambda s, sf: dashboard.dash_wear_stress_by_type(featured(s, sf)))

register("dash_torque_wear_grid", """
SELECT CAST(FLOOR(torque_nm / 5) * 5 AS DOUBLE) AS torque_bin,
       CAST(FLOOR(tool_wear_min / 20) * 20 AS INT) AS wear_bin,
       COUNT(*) AS machines, COUNT(*) FILTER (WHERE target = 1) AS failures
FROM feat GROUP BY 1, 2""")(lambda s, sf: dashboard.dash_torque_wear_grid(featured(s, sf)))

register("dash_risk_bands", """
SELECT risk_band, COUNT(*) AS machines, ROUND(AVG(risk_score), 4) AS avg_probability,
       MAX(risk_score) AS max_probability, COUNT(*) FILTER (WHERE target = 1) AS failures
FROM preds GROUP BY risk_band""")(lambda s, sf: dashboard.dash_risk_bands(preds(s, sf)))

register("dash_prediction_kpis", """
SELECT COUNT(*) FILTER (WHERE target = 1) AS total_failures,
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE target = 1) / COUNT(*), 2) AS failure_rate_pct,
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE target = prediction) / COUNT(*), 2) AS accuracy_pct,
       COUNT(*) FILTER (WHERE target = 1 AND prediction = 1) AS failures_caught FROM preds""")(
    lambda s, sf: dashboard.dash_prediction_kpis(preds(s, sf)))

register("dash_actual_vs_predicted", """
SELECT machine_type, COUNT(*) FILTER (WHERE target = 1) AS actual_failures,
       COUNT(*) FILTER (WHERE prediction = 1) AS predicted_failures FROM preds GROUP BY machine_type""")(
    lambda s, sf: dashboard.dash_actual_vs_predicted(preds(s, sf)))

register("dash_predicted_types",
         "SELECT prediction AS predicted_type, COUNT(*) AS machines FROM mscore GROUP BY prediction")(
    lambda s, sf: dashboard.dash_predicted_types(mscore(s, sf)))

register("dash_high_risk_detail", """
SELECT udi, product_id, machine_type, tool_wear_min, torque_nm, ROUND(risk_score, 6) AS risk_score,
       target, prediction FROM preds WHERE risk_band = 'High' ORDER BY risk_score DESC, udi""")(
    lambda s, sf: dashboard.dash_high_risk_detail(preds(s, sf)))

register("dash_model_kpis", f"""
SELECT {_r(_z('2 * tp', '2 * tp + fp + fn'))} AS f1, {_r(_z('tp + tn', 'tp + fp + fn + tn'))} AS accuracy,
       tp AS true_positives, fn AS false_negatives FROM {_COUNTS.format(src='bscore')}""")(
    lambda s, sf: dashboard.dash_model_kpis(bscore(s, sf)))

register("dash_f1_by_type", "WITH " + _PER_CLASS.format(src="mscore") + f"""
SELECT class AS failure_type, {_r('f1')} AS f1, support FROM pc""")(
    lambda s, sf: dashboard.dash_f1_by_type(mscore(s, sf)))

# ---------------------------------------------------------------- slicers
register("dash_prediction_kpis_high_band", """
SELECT COUNT(*) FILTER (WHERE target = 1) AS total_failures,
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE target = 1) / COUNT(*), 2) AS failure_rate_pct,
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE target = prediction) / COUNT(*), 2) AS accuracy_pct,
       COUNT(*) FILTER (WHERE target = 1 AND prediction = 1) AS failures_caught
FROM preds WHERE risk_band = 'High'""")(
    lambda s, sf: dashboard.dash_prediction_kpis(preds(s, sf), where=c("risk_band") == "High"))

STRICT_CUT = 0.7


def two_models(s, sf):
    """Rows scored by two rules, told apart by ``model`` (the fixed score cut at 0.5 and 0.7)."""
    base = bscore(s, sf)
    strict = base.withColumn("prediction", (c("score") >= STRICT_CUT).cast("int"))
    return (base.withColumn("model", F.lit("rule"))
            .unionByName(strict.withColumn("model", F.lit("strict rule"))))


register("dash_model_kpis_one_model", f"""
WITH strict AS (SELECT label, CASE WHEN score >= {STRICT_CUT} THEN 1 ELSE 0 END AS prediction FROM bscore)
SELECT {_r(_z('2 * tp', '2 * tp + fp + fn'))} AS f1, {_r(_z('tp + tn', 'tp + fp + fn + tn'))} AS accuracy,
       tp AS true_positives, fn AS false_negatives FROM {_COUNTS.format(src='strict')}""")(
    lambda s, sf: dashboard.dash_model_kpis(two_models(s, sf), where=c("model") == "strict rule"))
