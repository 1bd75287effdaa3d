"""Readers for the parquet tables of a data directory (files or folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(data_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(name)
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The table as its files are now (nothing is kept between calls)."""
    return spark.read.parquet(table_path(data_dir, name))


def stream_table(spark: SparkSession, data_dir: str, name: str, max_files: int) -> DataFrame:
    """File stream over a table, at most ``max_files`` files a micro-batch (a
    rate limit: every file is read).  A folder table is streamed from its own
    path; the file source takes folders only, so a single file is streamed
    from its parent by name.  A missing table raises."""
    path = table_path(data_dir, name)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
    reader = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("maxFilesPerTrigger", max_files))
    if status.isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(data_dir)
