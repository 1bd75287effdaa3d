"""Silver, Gold and the country summary as tables of the catalog.

The files are those of the path tables (``tables.py``): Silver below
``<warehouse>/silver`` by day, Gold below ``<warehouse>/gold`` by snapshot date.  A
catalog table adds names, a default ingest time and, for Silver, buckets:

* Silver is bucketed by aircraft.  An upsert shuffles its incoming rows into the
  same buckets and unites them with the stored ones, which keeps the buckets; so the
  stored rows of the touched days are read, compared and staged without an exchange,
  and each task writes one file per day.  A key has one row in Silver and position
  times are whole seconds, so an aircraft has at most 86,400 stored rows a day; the
  incoming copies of a key are reduced (map-side first, by the whole key) before they
  go to a bucket.  No hot aircraft can therefore fill a bucket.
* An upsert runs in as many tasks as there are buckets, whatever days it touches:
  choose the number so that one bucket of the days of a load is work for one task
  (about 1 GB), and no more, since a day has that many files.
* The touched days are listed on the driver: calendar days between the bounds of
  valid position times (1970 to 2100), fewer than 48,000.

Rows need both key columns, as Silver rows have them.  Publication goes through a finished staging as for the path tables, so a replay or a
crash between staging and publication gives the same table.  A table made over
existing files takes their days up.  Files of a path table are not bucketed:
``create_silver`` refuses a folder that holds such files.

One writer at a time per table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import silver as S
from contrail.plans import tables
from contrail.plans.tables import DAY, SNAPSHOT_DATE
from contrail.schemas import GOLD, SILVER

BUCKET = "icao24"
BUCKETS = 64
INGESTED = "ingested_at"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _columns(schema: T.StructType) -> str:
    now = {INGESTED: " DEFAULT localtimestamp()"}
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{now.get(f.name, '')}" for f in schema.fields)


def _create(spark: SparkSession, name: str, schema: T.StructType, path: str, layout: str) -> None:
    if not spark.catalog.tableExists(name):
        at = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet {layout} LOCATION '{at}'")


def _with(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, T.DateType())])


def sync(spark: SparkSession, name: str) -> None:
    """Days that were added to or removed from the files since."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def buckets(spark: SparkSession, name: str) -> int:
    """The number of buckets of a table; 0 if it has none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type) if rows else 0


def create_silver(spark: SparkSession, name: str, path: str, n_buckets: int = BUCKETS) -> None:
    """The Silver table, if it is not there, over ``path``."""
    if spark.catalog.tableExists(name):
        return
    stored = tables.folders(spark, path)
    if any(d.startswith(f"{DAY}=") for d in stored) and f"{tables.BUCKETED}{n_buckets}" not in stored:
        raise ValueError(f"{path} holds files without {n_buckets} buckets")
    _create(spark, name, _with(SILVER, DAY), path,
            f"PARTITIONED BY ({DAY}) CLUSTERED BY ({BUCKET}) SORTED BY ({BUCKET}, time_position) INTO {n_buckets} BUCKETS")
    # remembered beside the files, for a catalog that forgets its tables
    tables.make_folder(spark, f"{path.rstrip('/')}/{tables.BUCKETED}{n_buckets}")
    sync(spark, name)


def create_gold(spark: SparkSession, name: str, path: str) -> None:
    """The Gold table, if it is not there, over ``path``; its days are taken up anew."""
    _create(spark, name, _with(GOLD, SNAPSHOT_DATE), path, f"PARTITIONED BY ({SNAPSHOT_DATE})")
    sync(spark, name)


def create_summary(spark: SparkSession, name: str, path: str) -> None:
    """The hourly country summary, if it is not there, over the written ``path``."""
    _create(spark, name, spark.read.parquet(path).schema, path, "")
    spark.catalog.refreshTable(name)


def merged(spark: SparkSession, name: str, incoming: DataFrame, days: list) -> DataFrame:
    """The new rows of the touched days: latest wins over the stored and the incoming
    ones.  No exchange lies above the scan of the table: a union keeps the buckets of its
    sides where they come to it as they are, with all columns, so the day stays."""
    stored = spark.table(name).where(F.col(DAY).isin(days))
    fresh = S.latest(incoming).withColumn(DAY, F.to_date("time_position")).repartition(buckets(spark, name), BUCKET)
    return S.latest(stored.unionByName(fresh), columns=stored.columns)


def _publish(spark: SparkSession, name: str, folder: str) -> None:
    """Replace the table's days by those of a finished staging, whose files hold
    one bucket each.  An insert into a catalog table takes its overwrite mode from the
    session only."""
    staged = spark.read.schema(_with(SILVER, DAY)).parquet(folder)
    before = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        staged.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE, before)


def recover(spark: SparkSession, name: str, path: str) -> None:
    """Publish again what an earlier writer finished, drop what it did not."""
    for folder in tables.folders(spark, tables._staging(path)):
        folder = f"{tables._staging(path)}/{folder}"
        if tables.exists(spark, f"{folder}/_SUCCESS"):
            _publish(spark, name, folder)
        tables.remove(spark, folder)


def stage(spark: SparkSession, name: str, path: str, rows: DataFrame) -> str:
    """Write the merged rows aside in the table's buckets."""
    mark = uuid.uuid4().hex
    folder, table = f"{tables._staging(path)}/days-{mark}", f"{name}_staging_{mark}"
    (rows.write.format("parquet").partitionBy(DAY).bucketBy(buckets(spark, name), BUCKET).sortBy(BUCKET, "time_position")
     .option("path", folder).saveAsTable(table))
    spark.sql(f"DROP TABLE {table}")            # the files stay: its place is given
    return folder


def upsert_silver(spark: SparkSession, name: str, path: str, incoming_rows: DataFrame) -> None:
    """Merge rows into the catalog table over ``path``.  An empty batch changes nothing."""
    recover(spark, name, path)
    keyed = incoming_rows.select(*SILVER.fieldNames()).withColumn(DAY, F.to_date("time_position"))
    with tables.written(spark, keyed, "incoming") as incoming:
        days = [r[0] for r in incoming.select(DAY).distinct().collect()]
        if not days:
            return
        folder = stage(spark, name, path, merged(spark, name, incoming, days))
    _publish(spark, name, folder)
    tables.remove(spark, folder)
