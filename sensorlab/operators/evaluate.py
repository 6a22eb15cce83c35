"""Evaluation reports over scored rows (label, prediction, score).

Everything is an aggregate: per-class counts come from one grouped count (by label and
prediction), the ROC curve and AUC from per-score counts and the range-bucketed
running totals of :mod:`sensorlab.functions.ordered`, so no step sorts all rows in one
task and MLlib's 1000-bin down-sampling is not involved (the area is exact, ties
counted half).  Ratios follow scikit-learn's ``zero_division=0``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlab.functions.exprs import dround
from sensorlab.functions.ordered import previous_values, running_totals
from sensorlab.session import cut_lineage

c = F.col
DIGITS = 6


def _ratio0(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (scikit-learn zero_division=0)."""
    return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))


def _count() -> Column:
    return F.count(F.lit(1))


def class_list(df: DataFrame, label: str = "label", pred: str = "prediction") -> list:
    """Sorted distinct classes of labels and predictions (collects one row per class)."""
    classes = (df.select(c(label).alias("k")).union(df.select(c(pred).alias("k")))
               .where(c("k").isNotNull()).distinct().collect())
    return sorted(r[0] for r in classes)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     classes: list | None = None) -> DataFrame:
    """(actual, predicted, count) for every class pair, zeros included."""
    classes = class_list(df, label, pred) if classes is None else classes
    ktype = df.schema[label].dataType
    schema = T.StructType([T.StructField("actual", ktype), T.StructField("predicted", ktype)])
    grid = df.sparkSession.createDataFrame([(a, b) for a in classes for b in classes], schema)
    counts = df.groupBy(c(label).alias("actual"), c(pred).alias("predicted")).agg(_count().alias("count"))
    return grid.join(counts, ["actual", "predicted"], "left").fillna(0, ["count"])


def binary_counts(df: DataFrame, label: str = "label", pred: str = "prediction",
                  positive=1) -> DataFrame:
    # a row without a prediction was not flagged: an unscored failure is a miss
    y, p = c(label) == positive, F.coalesce(c(pred) == positive, F.lit(False))
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def metrics_binary(df: DataFrame, label: str = "label", pred: str = "prediction",
                   positive=1) -> DataFrame:
    """accuracy, precision, recall and F1 of the positive class."""
    return binary_counts(df, label, pred, positive).select(*metrics_from_counts())


def metrics_from_counts() -> list[Column]:
    """accuracy, precision, recall, F1 as expressions over columns tp, fp, fn, tn."""
    tp, fp, fn, tn = c("tp"), c("fp"), c("fn"), c("tn")
    return [dround(_ratio0(tp + tn, tp + fp + fn + tn), DIGITS).alias("accuracy"),
            dround(_ratio0(tp, tp + fp), DIGITS).alias("precision"),
            dround(_ratio0(tp, tp + fn), DIGITS).alias("recall"),
            dround(_ratio0(2 * tp, 2 * tp + fp + fn), DIGITS).alias("f1")]


def per_class(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """class, tp, support, predicted, precision, recall, f1 for labels ∪ predictions."""
    pairs = df.groupBy(c(label).alias("_l"), c(pred).alias("_p")).agg(_count().alias("_n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(c("_l") == c("_p"), c("_n")).otherwise(zero)

    def side(cls, support, tp, predicted):
        return F.struct(c(cls).alias("class"), support.alias("support"), tp.alias("tp"),
                        predicted.alias("predicted"))
    sides = pairs.select(F.inline(F.array(side("_l", c("_n"), hit, zero), side("_p", zero, zero, c("_n")))))
    j = sides.where(c("class").isNotNull()).groupBy("class").agg(
        *[F.sum(x).alias(x) for x in ("support", "tp", "predicted")])
    prec = _ratio0(c("tp"), c("predicted"))
    rec = _ratio0(c("tp"), c("support"))
    f1 = _ratio0(2 * c("tp"), c("predicted") + c("support"))
    return j.select("class", "tp", "support", "predicted", prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"))


def metrics_weighted(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy and support-weighted precision, recall and F1."""
    pc = per_class(df, label, pred)
    n = F.sum("support")
    return pc.agg(
        dround(_ratio0(F.sum("tp"), n), DIGITS).alias("accuracy"),
        dround(_ratio0(F.sum(c("precision") * c("support")), n), DIGITS).alias("precision"),
        dround(_ratio0(F.sum(c("recall") * c("support")), n), DIGITS).alias("recall"),
        dround(_ratio0(F.sum(c("f1") * c("support")), n), DIGITS).alias("f1"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction",
                          names: Mapping | None = None) -> DataFrame:
    """Per class precision / recall / F1 / support, then accuracy, macro and weighted
    averages as extra rows (scikit-learn's text report as a table)."""
    pc = per_class(df, label, pred)
    if names:
        mapping = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        cls = F.coalesce(mapping[c("class")], c("class").cast("string"))
    else:
        cls = c("class").cast("string")
    rows = pc.select(cls.alias("class"), "precision", "recall", "f1",
                     c("support").cast("bigint").alias("support"))
    n = F.sum("support")
    summary = pc.agg(
        _ratio0(F.sum("tp"), n).alias("_acc"), n.alias("_n"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1").alias("_mf"),
        _ratio0(F.sum(c("precision") * c("support")), n).alias("_wp"),
        _ratio0(F.sum(c("recall") * c("support")), n).alias("_wr"),
        _ratio0(F.sum(c("f1") * c("support")), n).alias("_wf"))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        c("_n").cast("bigint").alias("support"))
    none = F.lit(None)
    extra = summary.select(F.inline(F.array(
        row("accuracy", none, none, c("_acc")),
        row("macro avg", c("_mp"), c("_mr"), c("_mf")),
        row("weighted avg", c("_wp"), c("_wr"), c("_wf")))))
    out = rows.unionByName(extra)
    return out.select("class", *[dround(x, DIGITS).alias(x) for x in ("precision", "recall", "f1")],
                      "support")


def low_f1_classes(report: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Class rows of a report with a flag for F1 below ``threshold``."""
    body = report.where(~c("class").isin("accuracy", "macro avg", "weighted avg"))
    return body.select("class", "f1", (c("f1") < threshold).alias("below_threshold"))


def _score_counts(df: DataFrame, label: str, score: str, positive) -> DataFrame:
    y = c(label) == positive
    return (df.where(c(score).isNotNull())
            .groupBy(c(score).alias("score"))
            .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """Exact ROC AUC with ties: sum over distinct scores of pos * (neg below + neg / 2),
    divided by P * N (the Mann-Whitney statistic); NULL if a class is absent."""
    per_score = cut_lineage(_score_counts(df, label, score, positive))  # read 3 times
    cum = running_totals(per_score, "score", ["neg"])
    part = cum.select((c("pos") * ((c("neg_cum") - c("neg")) + c("neg") / 2.0)).alias("_a"),
                      "pos", "neg")
    return part.agg(dround(F.try_divide(F.sum("_a"), F.sum("pos") * F.sum("neg")), DIGITS)
                    .alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", positive=1,
              drop_collinear: bool = False) -> DataFrame:
    """(threshold, fpr, tpr): the start point (infinity, 0, 0), where no row is predicted
    positive, then one point per distinct score with the rates of rows scored >= it.
    ``drop_collinear`` leaves out points whose step is followed by an equal step (the next
    lower score adds the same rows of both classes); the first and the last point stay."""
    per_score = cut_lineage(_score_counts(df, label, score, positive))  # read 4 times
    cum = running_totals(per_score, "score", ["pos", "neg"])
    if drop_collinear:
        top = per_score.agg(F.max("score")).first()[0]
        near = previous_values(cum, "score", ["pos", "neg"])
        cum = near.where(c("prev_score").isNull() | (c("score") == F.lit(top)) | (c("pos") != c("prev_pos"))
                         | (c("neg") != c("prev_neg")))
    # the class totals are two numbers: bring them to the driver as literals
    t = per_score.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = F.lit(int(t["P"] or 0)), F.lit(int(t["N"] or 0))
    above_pos = P - (c("pos_cum") - c("pos"))
    above_neg = N - (c("neg_cum") - c("neg"))
    points = cum.select(c("score").alias("threshold"),
                        dround(_ratio0(above_neg, N), DIGITS).alias("fpr"),
                        dround(_ratio0(above_pos, P), DIGITS).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def business_impact(df: DataFrame, label: str = "label", pred: str = "prediction",
                    positive=1) -> DataFrame:
    """failures, caught, missed (with % of failures), false alarms."""
    k = binary_counts(df, label, pred, positive)
    total = c("tp") + c("fn")
    return k.select(total.alias("total_failures"), c("tp").alias("caught"),
                    dround(F.try_divide(100.0 * c("tp"), total), 2).alias("caught_pct"),
                    c("fn").alias("missed"),
                    dround(F.try_divide(100.0 * c("fn"), total), 2).alias("missed_pct"),
                    c("fp").alias("false_alarms"))


def metrics_side_by_side(binary: DataFrame, multiclass: DataFrame) -> DataFrame:
    """metric, binary, multiclass: class-1 metrics and ROC AUC of the binary task next to
    the weighted metrics of the multiclass task."""
    b = metrics_binary(binary)
    auc = roc_auc(binary)
    m = metrics_weighted(multiclass)
    names = ["accuracy", "precision", "recall", "f1"]
    bl = b.unpivot([], names, "metric", "binary").unionByName(
        auc.select(F.lit("roc_auc").alias("metric"), c("roc_auc").alias("binary")))
    ml = m.unpivot([], names, "metric", "multiclass")
    return bl.join(ml, "metric", "left")
