"""Dense rank within a partition, computed on the distinct order values.

``dense_rank() OVER (PARTITION BY p ORDER BY v)`` only depends on the set of
distinct ``(p, v)`` pairs.  That set is built with a (map-side combined)
aggregate, ranked with a window (one small sort per partition value), and
joined back.  The big input is never re-shuffled by ``p``, so a partition
value holding a third of all rows costs no single task more than its share;
the join goes broadcast when AQE measures the level table as small and stays
a shuffle join otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_rank_within(df: DataFrame, partition_cols, order_col: str, name: str,
                      descending: bool = True) -> DataFrame:
    partition_cols = list(partition_cols)
    keys = partition_cols + [order_col]
    o = F.col(order_col)
    levels = df.select(*keys).distinct()
    w = Window.partitionBy(*partition_cols).orderBy(
        o.desc_nulls_last() if descending else o.asc_nulls_first())
    levels = levels.withColumn(name, F.dense_rank().over(w))
    levels = levels.select(*[F.col(k).alias(f"_lvl_{k}") for k in keys], name)
    cond = reduce(lambda a, b: a & b,
                  [df[k].eqNullSafe(levels[f"_lvl_{k}"]) for k in keys])
    return df.join(levels, cond, "inner").drop(*[f"_lvl_{k}" for k in keys])
