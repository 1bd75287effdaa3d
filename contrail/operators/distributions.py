"""Distribution panels: shared-bin density histogram, Gaussian KDE curves
and box-plot statistics, as Spark aggregates.

Exact quantiles come from ``quantiles`` (ranks computed per range cut, linear interpolation between order statistics as numpy
does), so no task holds a whole group's values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.quantiles import exact_quantiles, quantiles_of, value_counts

# Fixed values of the plotting defaults reproduced here: KDE grid size,
# box whisker reach (in IQRs).
KDE_GRID_POINTS = 200
WHISKER_IQR = 1.5


def _bin_params(rows: DataFrame, value: str, bins="auto") -> tuple[float, float, int] | None:
    """Shared bin edges: the smaller of the Freedman-Diaconis and Sturges bin
    widths over all rows (Sturges alone when the IQR is zero), bins spanning
    [min, max].  Five numbers are computed (count, min, max and two exact
    quartiles) and brought back as scalars -- what a scalar subquery does,
    without nesting the quantile plan inside every use."""
    v = F.col(value)
    stats = rows.filter(v.isNotNull()).agg(
        F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    if stats is None or not stats.n:
        return None
    n, lo, hi = stats.n, stats.lo, stats.hi
    if bins != "auto":
        first, last = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
        return first, last, int(bins)
    qs = {r.q: r.quantile for r in exact_quantiles(rows, value, [0.25, 0.75]).collect()}
    ptp = hi - lo
    sturges = ptp / (math.log2(n) + 1.0)
    fd = 2.0 * (qs[0.75] - qs[0.25]) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    first, last = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    nbins = int(math.ceil((last - first) / width)) if width > 0 else 1
    return first, last, nbins


def density_histogram(rows: DataFrame, value: str, group: str, bins="auto") -> DataFrame:
    """Per-group density over bins shared by all groups; each group
    integrates to one.  Only non-empty bins are emitted.  ``bins`` is a bin
    count or "auto" (the smaller of the Freedman-Diaconis / Sturges widths).

    The bin parameters are literals, so every row is binned inside the scan
    stage; intermediate indices are staged as columns so no expression is
    copied into its consumers."""
    params = _bin_params(rows, value, bins)
    if params is None:
        params = (0.0, 1.0, 1)
    fe, le, nb = F.lit(params[0]), F.lit(params[1]), F.lit(params[2])

    def edge(i):
        return F.when(i >= nb, le).otherwise(i * ((le - fe) / nb) + fe)

    v = F.col("_x")
    staged = (rows.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
                  .select(group, F.col(value).alias("_x"))
                  .withColumn("_raw", ((v - fe) * (nb / (le - fe))).cast("bigint"))
                  .withColumn("_i0", F.when(F.col("_raw") >= nb, nb - 1).otherwise(F.col("_raw"))))
    # Bin edges are i * step + first: correct the index where rounding put a
    # value on the wrong side of its edge.
    i0 = F.col("_i0")
    staged = staged.withColumn("_i1", F.when(v < edge(i0), i0 - 1).otherwise(i0))
    i1 = F.col("_i1")
    staged = staged.withColumn(
        "bin", F.when((v >= edge(i1 + 1)) & (i1 != nb - 1), i1 + 1).otherwise(i1))
    counts = staged.groupBy(group, "bin").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(group)
    b = F.col("bin")
    return (counts.withColumn("bin_left", edge(b)).withColumn("bin_right", edge(b + 1))
                  .select(group, "bin", "bin_left", "bin_right", "count",
                          F.round(F.col("count") / F.sum("count").over(w)
                                  / (F.col("bin_right") - F.col("bin_left")), 10).alias("density")))


def kde_curves(rows: DataFrame, value: str, group: str,
               grid_points: int = KDE_GRID_POINTS) -> DataFrame:
    """Gaussian KDE of each group (Scott bandwidth: sample stddev x
    n^(-1/5)) evaluated on one grid spanning the min..max of all rows.
    Groups with fewer than two values or zero variance get no curve.

    Equal values are counted first; each distinct value is expanded to the grid
    points by ``explode(sequence)``, its kernel term is weighted with the count,
    and the terms are summed per (group, grid point) with map-side partial
    aggregation.  The grid span is a scalar subquery; the per-group
    bandwidths are one row per group, joined back (AQE broadcasts them once
    measured small)."""
    v = F.col(value)
    clean = rows.filter(v.isNotNull() & F.col(group).isNotNull())
    g_lo = clean.agg(F.min(v)).scalar()
    g_hi = clean.agg(F.max(v)).scalar()
    per_group = clean.groupBy(group).agg(
        F.count(v).alias("n"), F.stddev_samp(v).alias("sd"))
    per_group = per_group.filter((F.col("n") >= 2) & (F.col("sd") > 0)).select(
        group, "n", (F.col("sd") * F.pow(F.col("n"), -0.2)).alias("h"))
    lo, hi = F.col("_lo"), F.col("_hi")
    i = F.col("grid_index")
    weighed = clean.groupBy(group, v.alias("_x")).agg(F.count(F.lit(1)).alias("_w"))
    terms = (weighed.select(group, "_x", "_w", g_lo.alias("_lo"), g_hi.alias("_hi"))
                  .join(per_group, group)
                  .select(group, "n", "h", "_x", "_w", "_lo", "_hi",
                          F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("grid_index"))
                  .withColumn("grid_value", F.when(i == grid_points - 1, hi).otherwise(
                      i * ((hi - lo) / float(grid_points - 1)) + lo))
                  .withColumn("k", F.col("_w") * F.exp(-0.5 * F.pow((F.col("grid_value") - F.col("_x"))
                                                      / F.col("h"), 2))))
    sums = terms.groupBy(group, "grid_index", "grid_value", "n", "h").agg(F.sum("k").alias("s"))
    return sums.select(
        group, "grid_index", "grid_value",
        F.round(F.col("s") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi)), 10).alias("density"))


def _quartiles(counts: DataFrame, group: str, probs) -> DataFrame:
    """One row per group with one column per probability (``p25`` ...)."""
    return quantiles_of(counts, probs).groupBy(F.col("_g").alias(group)).agg(*[
        F.max(F.when(F.col("q") == float(p), F.col("quantile"))).alias(f"p{round(p * 100)}")
        for p in probs])


def box_stats(rows: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles (linear interpolation), IQR, whiskers at the furthest
    values within 1.5 IQR of the box, and the number of values beyond.  All of
    it comes from the value counts, so ``rows`` is read once."""
    counts = value_counts(rows, value, group)
    values = counts.select(F.col("_g").alias(group), F.col("_v").alias("_x"), "_c")
    q = values.groupBy(group).agg(F.sum("_c").alias("n"), (F.sum(F.col("_x") * F.col("_c")) / F.sum("_c")).alias("mean")).join(
        _quartiles(counts, group, [0.25, 0.5, 0.75]), group)
    q = q.select(group, "n", "mean", F.col("p25").alias("q1"), F.col("p50").alias("median"),
                 F.col("p75").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - WHISKER_IQR * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + WHISKER_IQR * F.col("iqr"))
    # One row per group value: AQE broadcasts it after measuring it (a few
    # bytes for the phase domain) and keeps a shuffle join otherwise.
    joined = values.join(q, group)
    x = F.col("_x")
    ext = joined.groupBy(group).agg(
        F.min(F.when(x >= F.col("lo_fence"), x)).alias("lo_reach"),
        F.max(F.when(x <= F.col("hi_fence"), x)).alias("hi_reach"),
        F.coalesce(F.sum(F.when((x < F.col("lo_fence")) | (x > F.col("hi_fence")), F.col("_c"))), F.lit(0)).alias("n_fliers"))
    out = q.join(ext, group)
    whislo = F.when(F.col("lo_reach").isNull() | (F.col("lo_reach") > F.col("q1")),
                    F.col("q1")).otherwise(F.col("lo_reach"))
    whishi = F.when(F.col("hi_reach").isNull() | (F.col("hi_reach") < F.col("q3")),
                    F.col("q3")).otherwise(F.col("hi_reach"))
    r = lambda c: F.round(c, 6)
    return out.select(group, "n", r(F.col("mean")).alias("mean"), r(F.col("q1")).alias("q1"),
                      r(F.col("median")).alias("median"), r(F.col("q3")).alias("q3"),
                      r(F.col("iqr")).alias("iqr"), r(whislo).alias("whislo"),
                      r(whishi).alias("whishi"), "n_fliers")


def box_outliers(rows: DataFrame, value: str, group: str) -> DataFrame:
    """Rows beyond the whiskers (the plotted fliers)."""
    v = F.col(value)
    clean = rows.filter(v.isNotNull())
    q = _quartiles(value_counts(rows, value, group), group, [0.25, 0.75])
    iqr = F.col("p75") - F.col("p25")
    q = q.select(group, (F.col("p25") - WHISKER_IQR * iqr).alias("lo_fence"),
                 (F.col("p75") + WHISKER_IQR * iqr).alias("hi_fence"))
    return (clean.join(q, group)
                 .filter((v < F.col("lo_fence")) | (v > F.col("hi_fence")))
                 .drop("lo_fence", "hi_fence"))
