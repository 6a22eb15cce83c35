"""Distribution and correlation summaries: the data behind the EDA plots.

Multi-column summaries unpivot to a long (column_name, value) form first, so one set of
jobs answers every column; groups (columns, classes) are small, values are not, and no
step orders or collects the values in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.functions.exprs import dround, pct
from sensorlab.functions.ordered import exact_quantiles
from sensorlab.schema import FAILURE_CLASSES, SENSORS

c = F.col
MAX_CLASSES = 1000  # columns a pivot may add for classes it was not told of


def n_rows():
    return F.count(F.lit(1))

# The columns pandas ``describe()`` reports for the feature view (numeric columns).
DESCRIBE_COLUMNS = ["udi", "air_temperature_k", "process_temperature_k", "rotational_speed_rpm",
                    "torque_nm", "tool_wear_min", "target", "temperature_diff",
                    "mechanical_stress", "high_stress_flag"]


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column_name, value) with value as double; NULL values dropped."""
    staged = df.select(*keep, *[c(x).cast("double").alias(x) for x in columns])
    out = staged.unpivot(list(keep), list(columns), "column_name", "value")
    return out.where(c("value").isNotNull())


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Count and share (% of non-NULL rows) per value, most frequent first."""
    counts = df.where(c(column).isNotNull()).groupBy(column).agg(n_rows().alias(name))
    total = F.sum(name).over(Window.partitionBy())  # over the aggregated rows only
    return (counts.withColumn("percentage", pct(c(name), total))
            .orderBy(c(name).desc(), column))


def describe_numeric(df: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS,
                     digits: int = 2, approx: bool = False) -> DataFrame:
    """pandas ``describe()``: count, mean, std (ddof 1), min, quartiles, max; rounded.

    Quartiles are exact (linear interpolation) by default; ``approx=True`` uses
    ``percentile_approx`` (one pass, bounded memory) instead.
    """
    lf = long_form(df, columns)
    moments = lf.groupBy("column_name").agg(
        n_rows().alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    if approx:
        qs = lf.groupBy("column_name").agg(
            F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).alias("_q"))
        qs = qs.select("column_name", *[c("_q")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])])
    else:
        q = exact_quantiles(lf, "value", [0.25, 0.5, 0.75], groups=["column_name"])
        qs = q.groupBy("column_name").agg(
            *[F.max(F.when(c("p") == p, c("quantile"))).alias(n)
              for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]])
    out = moments.join(qs, "column_name")
    r = lambda x: dround(c(x), digits).alias(x)
    return out.select("column_name", "count", r("mean"), r("std"), r("min"), r("q25"), r("q50"),
                      r("q75"), r("max"))


def _edges(lf: DataFrame, groups: list[str]) -> DataFrame:
    stats = lf.groupBy(*groups).agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"),
                                    n_rows().alias("_n"))
    same = c("_mn") == c("_mx")
    # numpy widens a zero range to (min - 0.5, max + 0.5)
    return stats.select(*groups, "_n",
                        F.when(same, c("_mn") - 0.5).otherwise(c("_mn")).alias("_lo"),
                        F.when(same, c("_mx") + 0.5).otherwise(c("_mx")).alias("_hi"))


def _binned(lf: DataFrame, groups: list[str], bins: int) -> tuple[DataFrame, DataFrame]:
    edges = _edges(lf, groups)
    # edges: one row per group (columns x classes), small by construction
    j = lf.join(F.broadcast(edges), on=groups)
    idx = F.least(F.floor((c("value") - c("_lo")) * F.lit(bins) / (c("_hi") - c("_lo"))).cast("int"),
                  F.lit(bins - 1))
    counts = j.groupBy(*groups, idx.alias("bin")).agg(n_rows().alias("count"))
    grid = edges.select(*groups, "_n", "_lo", "_hi",
                        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, on=[*groups, "bin"], how="left").fillna(0, ["count"])
    w = (c("_hi") - c("_lo")) / F.lit(bins)
    out = out.withColumn("bin_lo", c("_lo") + c("bin") * w).withColumn("bin_hi", c("_lo") + (c("bin") + 1) * w)
    return out, edges


def histogram(df: DataFrame, columns: Sequence[str] = SENSORS, bins: int = 40) -> DataFrame:
    """k equal-width bins from min to max per column (last bin closed), empty bins kept."""
    lf = long_form(df, columns)
    out, _ = _binned(lf, ["column_name"], bins)
    return out.select("column_name", "bin", dround("bin_lo", 6).alias("bin_lo"),
                      dround("bin_hi", 6).alias("bin_hi"), "count")


def histogram_by_class(df: DataFrame, columns: Sequence[str], class_col: str = "failure_type",
                       bins: int = 30) -> DataFrame:
    """Per class and column: own min..max range, counts and density count/(n * width)."""
    lf = long_form(df.where(c(class_col).isNotNull()), columns, keep=[class_col])
    out, _ = _binned(lf, [class_col, "column_name"], bins)
    width = (c("_hi") - c("_lo")) / F.lit(bins)
    dens = dround(c("count") / (c("_n") * width), 6)
    return out.select(class_col, "column_name", "bin", dround("bin_lo", 6).alias("bin_lo"),
                      dround("bin_hi", 6).alias("bin_hi"), "count", dens.alias("density"))


def _box(lf: DataFrame, groups: list[str], digits: int) -> DataFrame:
    q = exact_quantiles(lf, "value", [0.25, 0.5, 0.75], groups=groups)
    qs = q.groupBy(*groups).agg(*[F.max(F.when(c("p") == p, c("quantile"))).alias(n)
                                  for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    fences = qs.select(*groups, "q1", "median", "q3",
                       (c("q3") - c("q1")).alias("iqr"),
                       (c("q1") - 1.5 * (c("q3") - c("q1"))).alias("_flo"),
                       (c("q3") + 1.5 * (c("q3") - c("q1"))).alias("_fhi"))
    # fences: one row per group; the second pass is a map-side join plus partial aggregates
    j = lf.join(F.broadcast(fences), on=groups)
    inside = (c("value") >= c("_flo")) & (c("value") <= c("_fhi"))
    agg = j.groupBy(*groups, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, c("value"))).alias("whisker_low"),
        F.max(F.when(inside, c("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    r = lambda x: dround(c(x), digits).alias(x)
    return agg.select(*groups, r("q1"), r("median"), r("q3"), r("iqr"), r("whisker_low"),
                      r("whisker_high"), "n_outliers")


def box_stats(df: DataFrame, columns: Sequence[str] = SENSORS, digits: int = 4) -> DataFrame:
    """Box-plot numbers per column: quartiles, IQR, whiskers (extreme values within
    1.5 IQR of the box) and the outlier count."""
    return _box(long_form(df, columns), ["column_name"], digits)


def box_stats_by_class(df: DataFrame, columns: Sequence[str] = SENSORS,
                       class_col: str = "failure_type", digits: int = 4) -> DataFrame:
    """Box-plot numbers per class and column; ``class_rank`` orders classes by frequency."""
    lf = long_form(df.where(c(class_col).isNotNull()), columns, keep=[class_col])
    box = _box(lf, [class_col, "column_name"], digits)
    freq = df.where(c(class_col).isNotNull()).groupBy(class_col).agg(n_rows().alias("class_rows"))
    ranked = freq.withColumn("class_rank", F.row_number().over(
        Window.orderBy(c("class_rows").desc(), c(class_col))))
    return box.join(ranked, class_col)


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair (lower triangle), pairwise-complete rows.

    One aggregate with n(n-1)/2 ``corr`` expressions (each skips rows where either side
    is NULL), then unpivoted; nothing is assembled into vectors or collected."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    aggs = [dround(F.corr(c(a).cast("double"), c(b).cast("double")), digits).alias(f"{a}|{b}")
            for a, b in pairs]
    wide = df.agg(*aggs)
    names = [f"{a}|{b}" for a, b in pairs]
    long = wide.unpivot([], [F.col(f"`{n}`") for n in names], "_pair", "correlation")
    return long.select(F.split("_pair", r"\|")[0].alias("var_a"), F.split("_pair", r"\|")[1].alias("var_b"),
                       "correlation")


def pivot_type_failure(df: DataFrame, classes: Sequence[str] = FAILURE_CLASSES) -> DataFrame:
    """Counts machine_type x failure_type (rows with either NULL dropped), missing → 0.

    The columns are ``classes`` and, after them, every other class of the data by name.  More
    than ``MAX_CLASSES`` others are an error, as for any pivot: the label is not a class."""
    base = df.where(c("machine_type").isNotNull() & c("failure_type").isNotNull())
    others = (base.where(~c("failure_type").isin(*classes)).select("failure_type").distinct()
              .limit(MAX_CLASSES + 1).collect())
    if len(others) > MAX_CLASSES:
        raise ValueError(f"failure_type has more than {MAX_CLASSES} unknown values")
    names = [*classes, *sorted(r[0] for r in others)]
    return base.groupBy("machine_type").pivot("failure_type", names).agg(n_rows()).fillna(0, names)


def eda_summary(df: DataFrame, class_col: str = "failure_type") -> DataFrame:
    """records, columns, missing cells, failure rate, most and least common failure.

    One grouped pass per class (a handful of groups), then a global aggregate over
    those few rows; ties between classes go to the alphabetically first name."""
    cells = sum((F.count_if(c(x).isNull()) for x in df.columns), F.lit(0).cast("bigint"))
    fails = F.sum(F.when(c("target") == 1, 1).otherwise(0))
    g = df.groupBy(class_col).agg(n_rows().alias("_n"), cells.alias("_miss"), fails.alias("_f"))
    known = c(class_col).isNotNull() & (c("_f") > 0)
    return g.agg(
        F.sum("_n").alias("records"),
        F.lit(len(df.columns)).alias("columns"),
        F.sum("_miss").alias("missing_values"),
        pct(F.sum("_f"), F.sum("_n")).alias("failure_rate_percentage"),
        F.min_by(F.when(known, c(class_col)), F.when(known, F.struct(-c("_f"), c(class_col))))
        .alias("most_common_failure"),
        F.min_by(F.when(known, c(class_col)), F.when(known, F.struct(c("_f"), c(class_col))))
        .alias("least_common_failure"))
