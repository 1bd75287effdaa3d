"""Exact quantiles without holding a group in one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here a
quantile is found by ranks instead:

1. count every distinct value per group (map-side combined: a value repeated
   a billion times is one row) and write that table once;
2. cut it by ``repartitionByRange`` on (group, value): Spark samples the
   values, so the cuts hold about equal numbers of them whatever their
   distribution (one outlier moves nothing);
3. prefix-sum the totals of each group's cuts, and rank the values inside each
   (group, cut) with a window partitioned by both;
4. locate the cut, then the value, that holds the order statistics
   ``floor(p (n-1))`` and ``ceil(p (n-1))`` and interpolate linearly between
   them (numpy's default "linear" method).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """Written table (_g, _v, _c, _b): distinct non-null values of each group
    with their counts, in range cuts ``_b``."""
    from contrail.plans.tables import materialize
    g = F.col(group) if group else F.lit(0)
    counts = (df.where(F.col(value).isNotNull()).groupBy(g.alias("_g"), F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    cut = counts.repartitionByRange("_g", "_v").withColumn("_b", F.spark_partition_id())
    return materialize(df.sparkSession, cut, "value_counts")


def quantiles_of(counts: DataFrame, probs) -> DataFrame:
    """Rows (_g, q, quantile) from ``value_counts``."""
    totals = counts.groupBy("_g", "_b").agg(F.sum("_c").alias("_bc"))
    before = Window.partitionBy("_g").orderBy("_b")     # one row per group and cut
    totals = totals.withColumn("_base", F.sum("_bc").over(before) - F.col("_bc"))
    n = totals.groupBy("_g").agg(F.sum("_bc").alias("_n"))
    targets = n.select("_g", "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("q"))
    targets = targets.withColumn("_pos", F.col("q") * (F.col("_n") - 1))
    ranks = F.explode(F.array(
        F.struct(F.lit(0).alias("_k"), F.floor("_pos").cast("bigint").alias("_r")),
        F.struct(F.lit(1).alias("_k"), F.ceil("_pos").cast("bigint").alias("_r"))))
    wanted = targets.select("_g", "q", "_pos", ranks.alias("_t")).select("_g", "q", "_pos", "_t.*")
    found = wanted.join(totals, "_g").where("_r >= _base AND _r < _base + _bc")
    end = F.sum("_c").over(Window.partitionBy("_g", "_b").orderBy("_v"))
    ranked = counts.withColumn("_end", end)
    hit = found.join(ranked, ["_g", "_b"]).where("_r >= _base + _end - _c AND _r < _base + _end")
    both = hit.groupBy("_g", "q", "_pos").agg(
        F.max(F.when(F.col("_k") == 0, F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_k") == 1, F.col("_v"))).alias("_hi"))
    t, diff = F.col("_pos") - F.floor("_pos"), F.col("_hi") - F.col("_lo")
    # numpy's lerp: from the nearer end, so q = 1 lands exactly on the maximum
    quantile = F.when(t >= 0.5, F.col("_hi") - diff * (1 - t)).otherwise(F.col("_lo") + diff * t)
    return both.select("_g", "q", quantile.alias("quantile"))


def exact_quantiles(df: DataFrame, value: str, probs, group: str | None = None) -> DataFrame:
    """Rows ``(group, q, quantile)`` -- or ``(q, quantile)`` without a group --
    for every probability in ``probs`` over the non-null values."""
    out = quantiles_of(value_counts(df, value, group), probs)
    return out.withColumnRenamed("_g", group) if group else out.drop("_g")
