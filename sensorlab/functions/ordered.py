"""Running totals over a global order, and exact quantiles built on them.

A window ``ORDER BY x`` without a partition puts every row into one task.  Here the
ordered column is cut into value ranges (bounds from ``percentile_approx``; only the B-1
bounds reach the driver), totals per range give each range its offset (a window over
the ranges of a group), and the running sum inside a range is a window partitioned
by (group, range).  Every size takes this path, and the number of ranges grows with the
rows.  A value that fills several ranges is split by the hash of its tie-breaking key.
The result is exact; only the balance of the ranges is approximate.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.session import cut_lineage

c = F.col

# Target number of rows per range (one window task each), and the fewest ranges.
ROWS_PER_RANGE = 2_000_000
MIN_RANGES = 4


def range_bounds(df: DataFrame, order_col: str, n_ranges: int | None = None) -> list[float]:
    """Ascending range bounds of ``order_col``: B-1 approximate percentiles, B from the row
    count.  A value that fills several ranges comes as often as it does so."""
    if n_ranges is None:
        n_ranges = max(MIN_RANGES, math.ceil(df.count() / ROWS_PER_RANGE))
    grid = [i / n_ranges for i in range(1, n_ranges)]
    if not grid:
        return []
    found = df.agg(F.percentile_approx(c(order_col).cast("double"), grid,
                                       max(10_000, 10 * n_ranges))).first()[0]
    return sorted(float(b) for b in found or [] if b is not None and math.isfinite(b))


def range_bucket(df: DataFrame, order_col: str, out_col: str = "_rng",
                 n_ranges: int | None = None, bounds: list[float] | None = None) -> DataFrame:
    """Adds a deterministic range index of ``order_col`` (0..B-1, ascending)."""
    bounds = range_bounds(df, order_col, n_ranges) if bounds is None else bounds
    bounds = sorted(set(bounds))
    if not bounds:
        return df.withColumn(out_col, F.lit(0.0))
    splits = [-math.inf, *bounds, math.inf]
    tmp = f"{out_col}_in"
    staged = df.withColumn(tmp, c(order_col).cast("double"))
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=out_col, handleInvalid="keep").transform(staged)
    return out.drop(tmp)


def running_totals(df: DataFrame, order_col: str, value_cols: Sequence[str],
                   groups: Sequence[str] = (), suffix: str = "_cum",
                   n_ranges: int | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ascending ``order_col`` within ``groups``.

    ``df`` should hold one row per (groups, order value), or ``tiebreak`` columns must
    make the order total; otherwise tied rows are summed in an arbitrary order.  Rows of a
    value that fills several ranges are ordered by a hash of ``tiebreak`` first.
    """
    g = list(groups)
    bounds = range_bounds(df, order_col, n_ranges)
    ranged = (range_bucket(df, order_col, bounds=bounds)
              .withColumn("_sub", _tie_part(bounds, order_col, tiebreak)))
    cell = ["_rng", "_sub"]
    totals = ranged.groupBy(*g, *cell).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    w_off = (Window.partitionBy(*g).orderBy(*cell)
             .rowsBetween(Window.unboundedPreceding, -1))
    # one row per (group, range); a plain join on the key of the window below, so that both
    # share one shuffle, or a broadcast where the measured size allows it
    offsets = totals.select(*[c(x).alias(f"_k_{x}") for x in (*g, *cell)],
                            *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}")
                              for v in value_cols])
    on = (c("_rng") == c("_k__rng")) & (c("_sub") == c("_k__sub"))
    for x in g:
        on = on & c(x).eqNullSafe(c(f"_k_{x}"))
    out = ranged.join(offsets, on)
    w_in = (Window.partitionBy(*g, *cell).orderBy(order_col, *tiebreak)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for v in value_cols:
        out = out.withColumn(f"{v}{suffix}", c(f"_o_{v}") + F.sum(v).over(w_in))
    return out.drop(*cell, *[f"_k_{x}" for x in (*g, *cell)], *[f"_o_{v}" for v in value_cols])


def _tie_part(bounds: list[float], order_col: str, tiebreak: Sequence[str]):
    """Part of a tied value within its range: a value that is a bound k times gets k parts by
    the hash of ``tiebreak``; it is the least of its range, whose other values come after."""
    parts = {b: k for b, k in Counter(bounds).items() if k > 1}
    if not parts or not tiebreak:
        return F.lit(0)
    known = F.create_map(*[F.lit(x) for b, k in sorted(parts.items()) for x in (b, k)])
    k = F.try_element_at(known, c(order_col).cast("double"))
    return F.when(k.isNotNull(), F.pmod(F.xxhash64(*tiebreak), k).cast("int")).otherwise(F.lit(len(bounds)))


def previous_values(df: DataFrame, order_col: str, value_cols: Sequence[str], prefix: str = "prev_",
                    n_ranges: int | None = None) -> DataFrame:
    """Adds each row's neighbour below in ``order_col`` (one row per value): its order value and
    ``value_cols`` with ``prefix``, NULL for the lowest row.  Inside a range a window looks back; the first row of
    a range takes the last row of the nearest range below, of which there is one a range."""
    cols = [order_col, *value_cols]
    ranged = range_bucket(df, order_col, n_ranges=n_ranges)
    tails = ranged.groupBy(c("_rng").alias("_at")).agg(F.max(F.struct(*cols)).alias("_tail"))
    below = tails.select("_at", F.lag("_tail").over(Window.orderBy("_at")).alias("_below"))
    inside = Window.partitionBy("_rng").orderBy(order_col)
    out = ranged.withColumn("_prev", F.lag(F.struct(*cols)).over(inside)).join(below, c("_rng") == c("_at"))
    prev = F.coalesce("_prev", "_below")
    return out.select(*df.columns, *[prev[x].alias(f"{prefix}{x}") for x in cols])


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    groups: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy 'linear', DuckDB quantile_cont).

    Returns one row per (groups, p): ``p``, ``quantile``.  NULLs are ignored.  The work
    is a count per distinct value, the running totals above, and a join of the value
    table with the (groups x probs) positions table, which is tiny.
    """
    g = list(groups)
    counts = (df.where(c(column).isNotNull())
              .groupBy(*g, c(column).alias("_x")).agg(F.count(F.lit(1)).alias("_n")))
    # the per-value counts are read four times (bounds, totals, running sums, sizes):
    # materialise them once instead of re-running the aggregation over the input
    counts = cut_lineage(counts)
    cum = running_totals(counts, "_x", ["_n"], groups=g)
    cum = cum.withColumn("_before", c("_n_cum") - c("_n"))
    if not g:
        # one group: the positions are a few numbers; select the rows that hold them
        size = int(counts.agg(F.sum("_n")).first()[0] or 0)
        picks = []
        for p in probs:
            h = p * (size - 1)
            lo, hi = math.floor(h), math.ceil(h)
            at = lambda k: (F.lit(k) >= c("_before")) & (F.lit(k) < c("_n_cum"))
            picks.append(cum.where(at(lo) | at(hi)).select(
                F.lit(float(p)).alias("p"), F.lit(h - lo).alias("_frac"),
                F.when(at(lo), c("_x")).alias("_vlo"), F.when(at(hi), c("_x")).alias("_vhi")))
        if size == 0:
            return df.sparkSession.createDataFrame([], "p double, quantile double")
        both = picks[0]
        for extra in picks[1:]:
            both = both.unionByName(extra)
        agg = both.groupBy("p").agg(F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"),
                                    F.first("_frac").alias("_frac"))
        q = c("_vlo") + (c("_vhi") - c("_vlo")) * c("_frac")
        return agg.select("p", q.cast("double").alias("quantile"))
    sizes = counts.groupBy(*g).agg(F.sum("_n").alias("_size"))
    parr = F.array(*[F.lit(float(p)) for p in probs])
    pos = (sizes.select(*g, "_size", F.explode(parr).alias("p"))
           .withColumn("_h", c("p") * (c("_size") - 1))
           .withColumn("_lo", F.floor("_h"))
           .withColumn("_hi", F.ceil("_h"))
           .withColumn("_frac", c("_h") - c("_lo")))
    # positions: #groups x #probs rows (bounded by the number of groups, e.g. classes).
    # the two sides share lineage, so the position side gets its own key names
    pos = pos.select(*[c(x).alias(f"_k_{x}") for x in g], "p", "_lo", "_hi", "_frac")
    cond = [c(x).eqNullSafe(c(f"_k_{x}")) for x in g]
    hit_lo = (c("_lo") >= c("_before")) & (c("_lo") < c("_n_cum"))
    hit_hi = (c("_hi") >= c("_before")) & (c("_hi") < c("_n_cum"))
    on = hit_lo | hit_hi
    for cond_x in cond:
        on = cond_x & on
    both = cum.join(F.broadcast(pos), on=on, how="inner")
    picked = both.select(*g, "p", "_frac",
                         F.when(hit_lo, c("_x")).alias("_vlo"), F.when(hit_hi, c("_x")).alias("_vhi"))
    agg = picked.groupBy(*g, "p").agg(F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"),
                                      F.first("_frac").alias("_frac"))
    q = c("_vlo") + (c("_vhi") - c("_vlo")) * c("_frac")
    return agg.select(*g, "p", q.cast("double").alias("quantile"))
