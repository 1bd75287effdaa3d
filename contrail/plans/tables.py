"""Table sinks.

* Append (parity mode): ``mode("append")``.
* Silver upsert: a table partitioned by day.  A batch is merged (latest wins)
  with the rows of the days it touches into a staging folder, and the
  finished staging then replaces exactly those day partitions.  A writer that
  stops before the staging is complete has changed nothing; one that stops
  while it is published left a finished staging, which the next writer
  publishes again first.  Latest-wins is idempotent, so a replayed batch, or a
  stream whose checkpoint was reset, gives the same table.
* Gold: one layout, partitioned by ``snapshot_date``, published from a finished
  staging in the same way: the touched days only, or a full refresh, which
  also drops the days that are no more.
* Create-if-absent catalog tables with the fixed schemas; partitioned and bucketed
  ones are in ``catalog_tables.py``.

One writer at a time per table.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import silver as S
from contrail.schemas import GOLD, SILVER
from contrail.session import shared_dir

DAY, SNAPSHOT_DATE, HOUR = "day", "snapshot_date", "hour_key"
#: Bytes of a row group.  A file of one row group is read by one task, and a day has few
#: files; those of several are shared out.
ROW_GROUP = 8 << 20
#: Folder name, with the number of buckets, beside the days of a table in buckets.
BUCKETED = "_buckets-"


# --- folders -------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it is missing)."""
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()] if fs.exists(at) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.mkdirs(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


# --- publishing through a finished staging --------------------------------------

def _staging(path: str) -> str:
    return f"{path.rstrip('/')}__staging"


def _with_partition(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, T.StringType() if column == HOUR else T.DateType())])


def _write_days(df: DataFrame, path: str, column: str, **options) -> None:
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).options(**options).partitionBy(column).parquet(path)


def stage(df: DataFrame, path: str, column: str, full: bool = False) -> str:
    """Write a batch aside; ``full`` marks that it replaces the whole table."""
    folder = f"{_staging(path)}/{'full' if full else 'days'}-{uuid.uuid4().hex}"
    # one shuffle by day, split by AQE where a day is large: no file per task and day
    _write_days(df.hint("rebalance", column), folder, column)
    return folder


def publish(spark: SparkSession, folder: str, path: str, schema: T.StructType, column: str) -> None:
    """Replace the table's partitions by those of a finished staging, which is
    clustered already: its files are copied without a shuffle."""
    staged = spark.read.schema(_with_partition(schema, column)).parquet(folder)
    _write_days(staged, path, column, partitionOverwriteMode="dynamic")
    if folder.rsplit("/", 1)[-1].startswith("full-"):
        kept = set(folders(spark, folder))
        for name in folders(spark, path):
            if name.startswith(f"{column}=") and name not in kept:
                remove(spark, f"{path.rstrip('/')}/{name}")


def recover(spark: SparkSession, path: str, schema: T.StructType, column: str) -> None:
    """Publish again what an earlier writer finished but may not have
    published, and drop what it did not finish."""
    for name in folders(spark, _staging(path)):
        folder = f"{_staging(path)}/{name}"
        if exists(spark, f"{folder}/_SUCCESS"):
            publish(spark, folder, path, schema, column)
        remove(spark, folder)


def read_days(spark: SparkSession, path: str, schema: T.StructType, column: str) -> DataFrame:
    """The table with its partition column; empty if it was never written."""
    full = _with_partition(schema, column)
    if not any(n.startswith(f"{column}=") for n in folders(spark, path)):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


# --- Silver ----------------------------------------------------------------------

def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_days(spark, path, SILVER, DAY).drop(DAY)


def upsert_silver(spark: SparkSession, path: str, incoming_rows: DataFrame, then=None) -> None:
    """Merge rows into the Silver table (see above).  ``then(days)`` runs after
    the publication with the touched days, before the staging is dropped: if
    it fails, the replayed batch does it again."""
    if any(name.startswith(BUCKETED) for name in folders(spark, path)):
        raise ValueError(f"{path} is in buckets: upsert its catalog table")
    recover(spark, path, SILVER, DAY)
    keyed = incoming_rows.select(*SILVER.fieldNames()).withColumn(DAY, F.to_date("time_position"))
    with written(spark, keyed, "incoming") as incoming:
        # only the touched day partitions are read (partition pruning by the join)
        base = read_days(spark, path, SILVER, DAY).join(incoming.select(DAY).distinct(), DAY, "left_semi")
        folder = stage(S.upsert(base, incoming).withColumn(DAY, F.to_date("time_position")), path, DAY)
    publish(spark, folder, path, SILVER, DAY)
    if then:
        then(spark.read.schema(_with_partition(SILVER, DAY)).parquet(folder).select(DAY).distinct())
    remove(spark, folder)


# --- Gold ------------------------------------------------------------------------

def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_days(spark, path, GOLD, SNAPSHOT_DATE).drop(SNAPSHOT_DATE)


def refresh_gold(spark: SparkSession, gold: DataFrame, path: str, full: bool) -> None:
    """Publish Gold rows: their days only, or (``full``) as the whole table."""
    recover(spark, path, GOLD, SNAPSHOT_DATE)
    folder = stage(gold.withColumn(SNAPSHOT_DATE, F.to_date("snapshot_hour")), path, SNAPSHOT_DATE, full)
    publish(spark, folder, path, GOLD, SNAPSHOT_DATE)
    remove(spark, folder)


# --- others ------------------------------------------------------------------------

@contextmanager
def written(spark: SparkSession, df: DataFrame, label: str):
    """``df`` written to the shared directory, for as long as the block runs:
    what the block publishes must not need it afterwards."""
    path = work_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def work_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/contrail-work/{uuid.uuid4().hex}/{label}"


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared directory and read
    it back: every later branch reads the written table instead of
    recomputing the plan, and the lineage is cut there."""
    path = work_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no inference job on read-back
    return spark.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION path."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
