"""Exact k-means over integer vectors, with heap-ordered bounds.

For each vector the distance to its own centroid and to the second nearest
differ by a gap.  When centroids move, the gap of a vector of cluster c shrinks
by at most what c moved plus the most that any other centroid moved; the
running sum of these is the drift of c.  A vector is kept in the heap of its
cluster under gap + drift at the time it was last scanned: as long as this key is
above the present drift, its centroid is strictly the nearest, whatever
else happened.  So a round pops from each heap until the root lasts, rescans
exactly the popped vectors against all centroids and pushes them back.

The vectors are written once, in blocks of at most ``BLOCK``, as a table that is
bucketed by block; a round reads it next to the equally bucketed table of heaps
(12 bytes a vector, without moving a vector) and writes the new heaps and, by
block, what moved between the clusters' sums.  Sums and counts are exact
integers; the driver holds k centroids and their sums only.

A vector is kept if it has exactly ``DIMENSIONS`` components, none of them
null, NaN or infinite.  Component x becomes floor(1024 * x).  Components beyond
``LARGEST`` raise an error: squared distances of such do not fit 64 bits.

Defined cases: the seeds are the vectors with the smallest SHA-256 of
``<salt>:<vec_id>`` (a null vec_id counts as empty; equal hashes are ordered by
their vectors); with fewer vectors than clusters each vector is a seed; repeated
rows are rows of their own; a tie goes to the smaller cluster; an empty cluster
keeps its centroid; an empty table, or one without a kept vector, gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.plans.tables import materialize, remove, work_folder

CLUSTERS, ROUNDS, DIMENSIONS, SALT = 8, 10, 64, 3
BLOCK = 8192
BUCKET_BLOCKS = 4                   # blocks a bucket, until the shuffle partitions are reached
MOST_BUCKETS = 100_000              # Spark's own limit
LARGEST = 1 << 27
_EXACT = 1 << 22                    # below: sums of 64 products are exact in doubles

VECTORS = "block long, ids array<long>, width int, parts binary"
HEAPS = "block long, sizes binary, keys binary, members binary, scanned long, moved array<string>"


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    whole = (F.size("embedding") == dimensions) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.coalesce(whole, F.lit(False))))


def integers(x: np.ndarray) -> np.ndarray:
    y = np.floor(1024.0 * x)
    if len(y) and np.abs(y).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // 1024} in size: its distances do not fit 64 bits")
    return y.astype(np.int64)


def _pack(x: np.ndarray) -> tuple[int, bytes]:
    width = 2 if len(x) == 0 or np.abs(x).max() < 1 << 15 else 4
    return width, x.astype(f"<i{width}").tobytes()


def _unpack(width: int, parts: bytes, dimensions: int) -> np.ndarray:
    return np.frombuffer(parts, f"<i{width}").reshape(-1, dimensions).astype(np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of every vector to every centroid."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT // 2:
        a, c = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (ties: the smaller number) and its gap."""
    d = distances(x, centroids)
    near = d.argmin(1)
    if d.shape[1] == 1:
        return near, np.full(len(x), np.inf)
    two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(float))
    return near, two[:, 1] - two[:, 0]


class Heaps:
    """The heaps of one block: lists of (key, place in the block), by cluster."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    @classmethod
    def read(cls, sizes: bytes, keys: bytes, members: bytes) -> Heaps:
        k, m = np.frombuffer(keys, "<f8").tolist(), np.frombuffer(members, "<i4").tolist()
        ends = np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
        return cls([list(zip(k[a:b], m[a:b])) for a, b in zip([0, *ends], ends)])     # heap order is list order

    def write(self) -> tuple[bytes, bytes, bytes]:
        flat = [e for h in self.heaps for e in h]
        return (np.array([len(h) for h in self.heaps], "<i4").tobytes(), np.array([k for k, _ in flat], "<f8").tobytes(),
                np.array([m for _, m in flat], "<i4").tobytes())

    def expired(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pops what no longer lasts: places and their clusters so far."""
        places, owners = [], []
        for c, h in enumerate(self.heaps):
            bound = drift[c] + 2e-6 + 1e-12 * drift[c]      # above every rounding of keys and drifts
            while h and h[0][0] <= bound:
                places.append(heapq.heappop(h)[1])
                owners.append(c)
        return np.array(places, np.int64), np.array(owners, np.int64)

    def push(self, places: np.ndarray, near: np.ndarray, gap: np.ndarray, drift: np.ndarray) -> None:
        for c in np.unique(near).tolist():
            own = near == c
            new, h = list(zip((gap[own] + drift[c]).tolist(), places[own].tolist())), self.heaps[c]
            if len(new) > len(h):
                h += new
                heapq.heapify(h)
            else:
                for e in new:
                    heapq.heappush(h, e)

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for c, h in enumerate(self.heaps):
            out[[m for _, m in h]] = c
        return out


def _moved(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, k: int) -> list[str] | None:
    """Change of each cluster's componentwise sums and count, as one list."""
    change = np.zeros((k, x.shape[1] + 1), np.int64)
    with_one = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
    np.add.at(change, new, with_one)
    if old is not None:
        np.subtract.at(change, old, with_one)
    return [str(v) for v in change.ravel().tolist()] if change.any() else None


@contextmanager
def _bucketed(spark: SparkSession):
    """``save(df, label)`` writes a table bucketed by block to the shared folder;
    whatever is still there at the end is dropped."""
    made: dict[str, str] = {}

    def drop(name: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, made.pop(name))

    def save(df: DataFrame, buckets: int, label: str) -> str:
        name, folder = f"contrail_{label}_{uuid.uuid4().hex}", work_folder(spark, label)
        made[name] = folder
        (df.repartition(buckets, "block").write.bucketBy(buckets, "block").format("parquet")
           .option("path", folder).saveAsTable(name))
        return name

    try:
        yield save, drop
    finally:
        for name in list(made):
            drop(name)


def _blocks(vectors: DataFrame, dimensions: int, block: int) -> DataFrame:
    def cut(batches):
        first, n, held_ids, held = TaskContext.get().partitionId() << 33, 0, [], []

        def row(ids, x):
            width, parts = _pack(x)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([first + n], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                "width": pa.array([width], pa.int32()), "parts": pa.array([parts], pa.binary())})

        for b in batches:
            held_ids += b.column("vec_id").to_pylist()
            x = b.column("embedding").flatten().to_numpy(zero_copy_only=False)
            held.append(integers(x.reshape(-1, dimensions)))
            while len(held_ids) >= block:
                x = np.concatenate(held)
                yield row(held_ids[:block], x[:block])
                n, held_ids, held = n + 1, held_ids[block:], [x[block:]]
        if held_ids:
            yield row(held_ids, np.concatenate(held))

    return vectors.mapInArrow(cut, VECTORS)


def _seeds(vectors: DataFrame, clusters: int, salt: int, dimensions: int) -> np.ndarray:
    named = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(named, "embedding").limit(clusters).select("embedding").collect()
    return integers(np.array([r.embedding for r in first], float).reshape(-1, dimensions))


def _first_heaps(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    k, d = centroids.shape

    def heaps(batches):
        for b in batches:
            for r in b.to_pylist():
                x = _unpack(r["width"], r["parts"], d)
                near, gap = scan(x, centroids)
                h = Heaps([[] for _ in range(k)])
                h.push(np.arange(len(x)), near, gap, np.zeros(k))
                yield _heap_row(r["block"], h, len(x), _moved(x, None, near, k))

    return vectors.select("block", "width", "parts").mapInArrow(heaps, HEAPS)


def _heap_row(block: int, heaps: Heaps, scanned: int, moved) -> pa.RecordBatch:
    sizes, keys, members = heaps.write()
    return pa.RecordBatch.from_pydict({
        "block": pa.array([block], pa.int64()), "sizes": pa.array([sizes], pa.binary()), "keys": pa.array([keys], pa.binary()),
        "members": pa.array([members], pa.binary()), "scanned": pa.array([scanned], pa.int64()),
        "moved": pa.array([moved], pa.list_(pa.string()))})


def _side_by_side(vectors: DataFrame, heaps: DataFrame) -> DataFrame:
    """Both tables are bucketed by block: this join exchanges nothing."""
    return vectors.join(heaps.drop("scanned", "moved").hint("merge"), "block")


def _next_heaps(both: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    k, d = centroids.shape

    def heaps(batches):
        for b in batches:
            for r in b.to_pylist():
                h, moved = Heaps.read(r["sizes"], r["keys"], r["members"]), None
                places, old = h.expired(drift)
                if len(places):
                    x = _unpack(r["width"], r["parts"], d)[places]
                    near, gap = scan(x, centroids)
                    h.push(places, near, gap, drift)
                    other = near != old
                    moved = _moved(x[other], old[other], near[other], k) if other.any() else None
                yield _heap_row(r["block"], h, len(places), moved)

    return both.select("block", "width", "parts", "sizes", "keys", "members").mapInArrow(heaps, HEAPS)


def _changes(heaps: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, int]:
    """Sum of the blocks' changes (Python integers), and rows scanned."""
    sums = (heaps.select(F.posexplode("moved").alias("at", "v")).groupBy("at")
            .agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect())
    out = np.zeros(k * (dimensions + 1), object)
    for r in sums:
        out[r["at"]] = int(r["v"])
    return out.reshape(k, dimensions + 1), heaps.agg(F.sum("scanned")).first()[0]


def _result(both: DataFrame, centroids: np.ndarray) -> DataFrame:
    d = centroids.shape[1]

    def rows(batches):
        for b in batches:
            for r in b.to_pylist():
                x = _unpack(r["width"], r["parts"], d)
                near = Heaps.read(r["sizes"], r["keys"], r["members"]).clusters(len(x))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": pa.array(r["ids"], pa.int64()), "cluster": pa.array(near, pa.int32()),
                    "distance": pa.array(((x - centroids[near]) ** 2).sum(1), pa.int64())})

    return both.select("width", "parts", "ids", "sizes", "keys", "members").mapInArrow(
        rows, "vec_id long, cluster int, distance long")


def cluster(spark: SparkSession, vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: int = SALT,
            dimensions: int = DIMENSIONS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, cluster, distance of every kept vector; the final centroids;
    vectors scanned exactly in each assignment, the first one first)."""
    own = kept(vectors, dimensions)
    centroids = _seeds(own, clusters, salt, dimensions)
    k = len(centroids)
    if k == 0:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids, []
    most = min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = int(max(1, min(most, -(-own.count() // (block * BUCKET_BLOCKS)))))
    with _bucketed(spark) as (save, drop):
        table = save(_blocks(own, dimensions, block), buckets, "vectors")
        heaps = save(_first_heaps(spark.table(table), centroids), buckets, "heaps")
        total, drift = np.zeros((k, dimensions + 1), object), np.zeros(k)
        change, n = _changes(spark.table(heaps), k, dimensions)
        scanned = [n]
        for _ in range(rounds):
            total = total + change
            new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old.tolist()
                            for row, old in zip(total.tolist(), centroids)], np.int64)
            step = np.sqrt(((new - centroids) ** 2).sum(1).astype(float))
            if not step.any():
                break               # no centroid moves any more: later rounds change nothing
            centroids = new
            others = np.array([np.delete(step, c).max(initial=0.0) for c in range(k)])
            drift = drift + step + others
            later = save(_next_heaps(_side_by_side(spark.table(table), spark.table(heaps)), centroids, drift), buckets, "heaps")
            drop(heaps)
            heaps = later
            change, n = _changes(spark.table(heaps), k, dimensions)
            scanned.append(n)
        rows = materialize(spark, _result(_side_by_side(spark.table(table), spark.table(heaps)), centroids), "clusters")
    return rows, centroids, scanned


def report(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its cluster's and the whole inertia and its centroid's
    SHA-256.  The joined table has one row a cluster."""
    spark = rows.sparkSession
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
             for c, v in enumerate(centroids.tolist())]
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                           T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])
    return rows.join(F.broadcast(spark.createDataFrame(names, schema)), "cluster") \
               .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
