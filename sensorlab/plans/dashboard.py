"""Datasets behind the three dashboards.

Each dataset is an aggregate over the predictions table (feature view + score +
prediction + risk band), so its size is set by the number of groups, not of machines;
the one row-level extract (high-risk detail) is a filter.  Every function takes an
optional ``where`` predicate: the dashboards' slicers (machine type, band, model).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlab.functions.exprs import avg_r, dround, pct
from sensorlab.operators import evaluate

c = F.col

# Fixed values (decision, SURVEY §2.10): risk bands on P(failure).
RISK_LOW, RISK_HIGH = 0.3, 0.7
# Cell size of the torque x wear grid (Nm, minutes).
TORQUE_CELL, WEAR_CELL = 5, 20


def risk_band(score: str | Column = "score", low: float = RISK_LOW, high: float = RISK_HIGH) -> Column:
    s = c(score) if isinstance(score, str) else score
    return F.when(s < low, "Low").when(s < high, "Medium").otherwise("High")


def _slice(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def predictions_table(scored_features: DataFrame) -> DataFrame:
    """Dataset DS1: feature rows that a model (or the F2 rule) has scored row by row
    (columns ``score`` and ``prediction``), with the risk band.  A projection: no join
    back to the features, so duplicate keys cannot fan out."""
    return (scored_features.withColumnRenamed("score", "risk_score")
            .withColumn("risk_band", risk_band("risk_score")))


def extracts(pred: DataFrame, scored: DataFrame, scored_mc: DataFrame) -> dict[str, DataFrame]:
    """The five exported datasets by file name: predictions, risk bands, predicted types,
    per-type F1 and the binary confusion matrix."""
    return {"DS1_predictions": pred, "DS3_risk_bands": dash_risk_bands(pred),
            "DS4_predicted_types": dash_predicted_types(scored_mc),
            "DS5_f1_by_type": dash_f1_by_type(scored_mc),
            "DS6_confusion_matrix": evaluate.confusion_matrix(scored)}


def dash_health_kpis(pred: DataFrame, where: Column | None = None) -> DataFrame:
    d = _slice(pred, where)
    return d.agg(F.count(F.lit(1)).alias("total_machines"),
                 avg_r("tool_wear_min").alias("avg_tool_wear"),
                 avg_r("risk_score").alias("avg_risk_score"),
                 F.count_if(c("risk_band") == "High").alias("high_risk_count"))


def dash_wear_stress_by_type(features_df: DataFrame, where: Column | None = None) -> DataFrame:
    d = _slice(features_df, where)
    return d.groupBy("machine_type").agg(avg_r("tool_wear_min").alias("avg_tool_wear"),
                                         avg_r("mechanical_stress").alias("avg_mechanical_stress"))


def dash_torque_wear_grid(features_df: DataFrame, where: Column | None = None,
                          torque_cell: float = TORQUE_CELL, wear_cell: int = WEAR_CELL) -> DataFrame:
    """The torque-vs-wear scatter as 2-D binned counts and failures."""
    d = _slice(features_df, where)
    tb = (F.floor(c("torque_nm") / torque_cell) * torque_cell).cast("double")
    wb = (F.floor(c("tool_wear_min") / wear_cell) * wear_cell).cast("int")
    return d.groupBy(tb.alias("torque_bin"), wb.alias("wear_bin")).agg(
        F.count(F.lit(1)).alias("machines"), F.count_if(c("target") == 1).alias("failures"))


def dash_risk_bands(pred: DataFrame, where: Column | None = None) -> DataFrame:
    d = _slice(pred, where)
    return d.groupBy("risk_band").agg(F.count(F.lit(1)).alias("machines"),
                                      avg_r("risk_score").alias("avg_probability"),
                                      F.max("risk_score").alias("max_probability"),
                                      F.count_if(c("target") == 1).alias("failures"))


def dash_prediction_kpis(pred: DataFrame, where: Column | None = None) -> DataFrame:
    d = _slice(pred, where)
    n = F.count(F.lit(1))
    return d.agg(F.count_if(c("target") == 1).alias("total_failures"),
                 pct(F.count_if(c("target") == 1), n).alias("failure_rate_pct"),
                 pct(F.count_if(c("target") == c("prediction")), n).alias("accuracy_pct"),
                 F.count_if((c("target") == 1) & (c("prediction") == 1)).alias("failures_caught"))


def dash_actual_vs_predicted(pred: DataFrame, where: Column | None = None) -> DataFrame:
    d = _slice(pred, where)
    return d.groupBy("machine_type").agg(F.count_if(c("target") == 1).alias("actual_failures"),
                                         F.count_if(c("prediction") == 1).alias("predicted_failures"))


def dash_predicted_types(scored_mc: DataFrame, where: Column | None = None) -> DataFrame:
    d = _slice(scored_mc, where)
    return d.groupBy(c("prediction").alias("predicted_type")).agg(F.count(F.lit(1)).alias("machines"))


def dash_high_risk_detail(pred: DataFrame, where: Column | None = None) -> DataFrame:
    """Every machine in the High band, highest risk first (a filter, not a top-k)."""
    d = _slice(pred, where).where(c("risk_band") == "High")
    return (d.select("udi", "product_id", "machine_type", "tool_wear_min", "torque_nm",
                     dround("risk_score", 6).alias("risk_score"), "target", "prediction")
            .orderBy(c("risk_score").desc(), "udi"))


def dash_model_kpis(scored: DataFrame, where: Column | None = None) -> DataFrame:
    """F1, accuracy, true positives and false negatives of the binary model."""
    k = evaluate.binary_counts(_slice(scored, where))
    return k.select(*evaluate.metrics_from_counts(), "tp", "fn").select(
        "f1", "accuracy", c("tp").alias("true_positives"), c("fn").alias("false_negatives"))


def dash_f1_by_type(scored_mc: DataFrame, where: Column | None = None) -> DataFrame:
    pc = evaluate.per_class(_slice(scored_mc, where))
    return pc.select(c("class").alias("failure_type"), dround("f1", 6).alias("f1"), "support")
