"""Shards of near equal bytes by Karmarkar-Karp differencing.

Documents of equal text form one indivisible group.  Differencing keeps a
heap of partial partitions, each a tuple of shard sums, and again and again
combines the two with the largest spread, the larger sums of one with the
smaller of the other.

Groups of more than 1 / ``ITEMS`` of all bytes (at most ``ITEMS`` of them) are
items of their own; the lighter ones are dealt by hash into ``ITEMS`` packages
that move as one.  Differencing thus sees at most 2 * ``ITEMS`` rows whatever
the corpus, heavy groups are balanced against many light packages, and a
package is a 500th of a shard, which differencing evens out to a few bytes.

Defined cases: a null text counts as the empty text (size 1, one group with
it); repeated rows count as often as they occur; a single group larger than
a shard's share fills its shard alone; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.plans.tables import materialize

SHARDS = 16
ITEMS = 8192
SLOT_RUN = 1000


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows; their columns in falling order) into
    one.  Returns its sums in falling order and, for each row and column, the
    place in it."""
    n, k = sums.shape
    nodes, made = list(sums), []
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = nodes[a] + nodes[b][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        made.append((a, b, order))
        heapq.heappush(heap, (-int(both[0] - both[-1]), len(nodes)))
        nodes.append(both)
    place = np.zeros((len(nodes), k), np.int64)
    place[-1] = np.arange(k)
    for node in range(len(nodes) - 1, n - 1, -1):
        a, b, order = made[node - n]
        place[a][order] = place[node]
        place[b][k - 1 - order] = place[node]
    return nodes[-1], place[:n]


def assign(groups: DataFrame, k: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """``groups`` (id: unique long, bytes, and more) with their shard."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    own = F.col("bytes") * items > total
    dealt = groups.withColumn("item", F.when(own, -1 - F.col("id")).otherwise(F.pmod(F.xxhash64("id"), F.lit(items))))

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by([("item", "ascending")])
        sums = np.zeros((table.num_rows, k), np.int64)
        sums[:, 0] = table["bytes"].to_numpy()
        place = difference(sums)[1] if table.num_rows else sums
        return pa.table({"item": table["item"], "shard": pa.array(place[:, 0], pa.int32())})

    weighed = dealt.groupBy("item").agg(F.sum("bytes").alias("bytes")).withColumn("all", F.lit(0))
    placed = weighed.groupBy("all").applyInArrow(combine, "item long, shard int")
    # at most 2 * items rows of two numbers: bounded, so it may be broadcast
    return dealt.join(F.broadcast(placed), "item").drop("item")


def shard(spark: SparkSession, docs: DataFrame, k: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialize(spark, docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("text_key"), F.monotonically_increasing_id().alias("row")), "rows")
    groups = materialize(spark, rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
                         .withColumn("id", F.monotonically_increasing_id()), "groups")
    placed = assign(groups, k, items).select("text_key", "shard")
    runs = max(1, rows.count() // (k * SLOT_RUN))
    dealt = materialize(spark, rows.join(placed, "text_key").withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs))),
                        "placed")
    # gapless slots without a whole shard in one task: rank inside short runs
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = F.row_number().over(Window.partitionBy("shard", "run").orderBy("row")) - 1
    return (dealt.withColumn("inside", inside).join(first, ["shard", "run"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("inside")).alias("slot")))
