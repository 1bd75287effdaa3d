"""Token ids in Arrow files: fixed-size-list batches of equal-length sequences.

The ids of all documents, in ascending doc_id order, each ended by ``end_id``,
form one stream.  Each task takes a range of doc_ids and writes two files:

* ``part-NNNNN.arrow`` (Arrow file format): record batches of ``BATCH``
  sequences, columns ``input_ids`` (fixed-size list of ``seq_len`` unsigned 16-
  or 32-bit integers) and ``mask`` (fixed-size list of booleans, false on the
  padding that ends the file).  Equal batches make sequence k row k % BATCH of
  batch k // BATCH: a reader maps the file and slices it without copying.
* ``part-NNNNN.docs.arrow``: doc_id, start (in the file's stream), n_tokens.

A task writes under a name of its own and renames at the end, so a repeated
or second attempt replaces a file by the same file.

Defined cases: a null or empty text is the end id alone; rows of equal doc_id
are ordered by a hash of their text; null doc_ids come first; an empty table
gives no files and no rows; extra columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.tokens import encoder
from contrail.session import shared_dir

SEQ_LEN = 2048
BATCH = 256
MANIFEST = "part int, path string, n_docs long, n_tokens long"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's view of a folder that Spark names (s3a and s3n are s3)."""
    uri = uri.replace("s3a://", "s3://").replace("s3n://", "s3://")
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class _Writer:
    """Collects ids and writes whole batches; memory is one batch."""

    def __init__(self, sink, seq_len: int, batch: int, dtype):
        self.seq_len, self.batch, self.dtype = seq_len, batch, np.dtype(dtype)
        kind = pa.uint16() if self.dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("input_ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))],
                                metadata={"seq_len": str(seq_len), "batch": str(batch)})
        self.out = ipc.new_file(sink, self.schema)
        self.held, self.n_held = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        if self.n_held >= self.batch * self.seq_len:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        stream = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        step, at = self.batch * self.seq_len, 0
        while len(stream) - at >= step or last and at < len(stream):
            part = stream[at:at + step]
            at += len(part)
            room = -(-len(part) // self.seq_len) * self.seq_len
            mask = np.arange(room) < len(part)
            if room > len(part):
                part = np.concatenate([part, np.zeros(room - len(part), self.dtype)])
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (part, mask)]
            self.out.write_batch(pa.record_batch(lists, schema=self.schema))
        self.held, self.n_held = [stream[at:]], len(stream) - at

    def close(self) -> None:
        self._flush(True)
        self.out.close()


class Shard:
    """Random access to one file; a local file is mapped, not read."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.file = ipc.open_file(self.source)
        meta = self.file.schema.metadata
        self.seq_len, self.batch = int(meta[b"seq_len"]), int(meta[b"batch"])
        self._at, self._ids, self._mask = -1, None, None

    def _load(self, k: int) -> None:
        if k != self._at:
            b = self.file.get_batch(k)
            self._ids = b.column(0).flatten().to_numpy(zero_copy_only=True)
            self._mask, self._at = b.column(1), k

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence k."""
        self._load(k // self.batch)
        row = k % self.batch
        return self._ids[row * self.seq_len:(row + 1) * self.seq_len], \
            self._mask[row].values.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids of the file's stream from ``start`` on."""
        step, parts = self.batch * self.seq_len, []
        while n > 0:
            k, at = divmod(start, step)
            self._load(k)
            parts.append(self._ids[at:at + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.uint32)])


def _publish(fs, own: str, final: str) -> None:
    if not isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(final).type != pafs.FileType.NotFound:
        fs.delete_file(final)       # some stores refuse to rename onto a file
    fs.move(own, final)


def write(spark: SparkSession, docs: DataFrame, path: str, end_id: int, folder: str,
          seq_len: int = SEQ_LEN, batch: int = BATCH) -> DataFrame:
    """Writes the files and returns the manifest (one row a file), itself a
    written table.  The number of ranges is the session's number of shuffle
    partitions, joined by AQE where they are small."""
    folder = folder.rstrip("/")

    def shards(batches):
        fs, base = filesystem(f"{folder}/data")
        fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        part, own = context.partitionId(), f"{base}/.{uuid.uuid4().hex}"
        e = encoder(path)
        small = e.tok.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        final = f"{base}/part-{part:05d}"
        sink = writer = None
        ids_, starts, counts, at = [], [], [], 0
        tail = np.array([end_id], "<u4")
        for b in batches:
            for doc_id, text in zip(b.column("doc_id"), b.column("text")):
                if writer is None:
                    sink = fs.open_output_stream(own)
                    writer = _Writer(sink, seq_len, batch, "<u2" if small else "<u4")
                ids = np.append(np.frombuffer(e.encode(text.as_py()), "<u4"), tail)
                writer.add(ids)
                ids_.append(doc_id.as_py())
                starts.append(at)
                counts.append(len(ids))
                at += len(ids)
        if writer is None:
            return
        writer.close()
        sink.close()
        index = pa.table({"doc_id": pa.array(ids_, pa.int64()), "start": pa.array(starts, pa.int64()),
                          "n_tokens": pa.array(counts, pa.int64())})
        with fs.open_output_stream(f"{own}.docs") as f, ipc.new_file(f, index.schema) as out:
            out.write_table(index)
        _publish(fs, f"{own}.docs", f"{final}.docs.arrow")
        _publish(fs, own, f"{final}.arrow")
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "path": pa.array([f"{folder}/data/part-{part:05d}"]),
            "n_docs": pa.array([len(ids_)], pa.int64()), "n_tokens": pa.array([at], pa.int64())})

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"))
    ordered.mapInArrow(shards, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with each file's start in the whole stream.  One row a
    file, so the running sum over all of them is small."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) read back
    from the files, a task a file."""
    def documents(batches):
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(f"{row['path']}.arrow")
                fs, path = filesystem(f"{row['path']}.docs.arrow")
                with fs.open_input_file(path) as f:
                    index = ipc.open_file(f).read_all()
                for part in index.to_batches(max_chunksize=512):
                    start, n = (part.column(k).to_numpy() for k in ("start", "n_tokens"))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": part.column("doc_id"), "start": pa.array(start + row["first"], pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()),
                        "ids": pa.array([shard.ids(s, m).astype("<u4").tobytes()
                                         for s, m in zip(start.tolist(), n.tolist())], pa.binary())})

    n = max(1, manifest.count())
    return (manifest.select("path", "first").repartition(n)
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary"))


def store_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/contrail-work/{uuid.uuid4().hex}/tokens"
