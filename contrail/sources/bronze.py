"""JSON landing zone and the Bronze layer.

Landing (``land_records`` / ``land_payloads``): JSON files appended under
``year=/month=/day=`` (optionally ``hour=``) partitions derived from the
fetch time.

Bronze is schemaless: one VARIANT ``raw_data`` per JSON value (a line, or a
whole file with ``multi_line=True``), the ingest time and the source file.  A
value is parsed once, when it is loaded; no field is lost.  A ledger of loads
says which version of which file is loaded, so a load takes new and changed
files only.  A file with any value that is not JSON is skipped whole by the
readers (its rows stay in the table, with the unparsed text in ``bad_text``)
until a load has a repaired version of it; valid JSON of another type than
expected costs only the field or vector that has it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.timefn import epoch_to_ntz
from contrail.plans.tables import folders, remove

PATTERN = "*.json"


def _date_parts(ts: Column, hourly: bool) -> list[Column]:
    parts = [F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
             F.date_format(ts, "dd").alias("day")]
    if hourly:
        parts.append(F.date_format(ts, "HH").alias("hour"))
    return parts


def land(df: DataFrame, path: str, fetch_time: Column, hourly: bool = False) -> None:
    """Append ``df`` as JSON under date partitions of ``fetch_time``."""
    cols = ["year", "month", "day"] + (["hour"] if hourly else [])
    (df.select("*", *_date_parts(fetch_time, hourly)).hint("rebalance", *cols)
       .write.mode("append").partitionBy(*cols).json(path))


def land_records(records: DataFrame, path: str, hourly: bool = False) -> None:
    """Flat flight records, partitioned by their fetch time (epoch s)."""
    land(records, path, epoch_to_ntz(F.col("time_fetched")), hourly)


def land_payloads(vectors: DataFrame, path: str, hourly: bool = False) -> None:
    """Feed rows as payload objects: ``states`` if there is such a column (any
    number of vectors), else the one vector ``state``."""
    states = F.col("states") if "states" in vectors.columns else F.array("state")
    payloads = vectors.select("time", "fetched_at", states.alias("states"))
    land(payloads, path, epoch_to_ntz(F.coalesce("fetched_at", "time")), hourly)


def _ingest_time(ingested_at: Column | str | None) -> Column:
    if ingested_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ingested_at, str) and ingested_at == "file":
        return F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    return (ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)).cast("timestamp_ntz")


def parse_text(lines: DataFrame, ingested_at: Column | str | None = "file") -> DataFrame:
    """Bronze rows (without their load) of text read from files, batch or
    stream; blank lines are no values."""
    raw = F.try_parse_json("value")
    return lines.where(F.trim("value") != "").select(
        raw.alias("raw_data"), _ingest_time(ingested_at).alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
        F.when(raw.isNull(), F.col("value")).alias("bad_text"))


def elements(raw: str) -> Column:
    """The objects in a value.  An array counts as its elements; so does an object
    whose only field is an array of objects (records handed over as a dict),
    unless that field is ``states``, the vectors of a payload."""
    def only(m: Column) -> Column:
        one = (F.size(m) == 1) & ~F.array_contains(F.map_keys(m), "states")
        return F.when(one, F.try_variant_get(F.element_at(F.map_values(m), 1), "$", "array<variant>"))

    # the map and its list are each made once a value and then named by a lambda; the
    # cast to a struct without fields asks for the type alone
    objects = lambda inner: F.forall(inner, lambda v: F.try_variant_get(v, "$", "struct<>").isNotNull())
    inside = F.transform(F.array(F.try_variant_get(raw, "$", "map<string,variant>")), only)
    return F.coalesce(F.try_variant_get(raw, "$", "array<variant>"), F.get(F.filter(inside, objects), 0), F.array(raw))


def variant_rows(bronze: DataFrame) -> DataFrame:
    """One row per object (see ``elements``)."""
    others = [c for c in bronze.columns if c != "raw_data"]
    return bronze.select(*others, F.explode(elements("raw_data")).alias("raw_data"))


# --- the stored table and its load ledger -------------------------------------------
#
# A load writes ``<bronze>/load=<id>`` and then, as its commit, one ledger row a
# file to ``<bronze>__loads/load=<id>``.  Both overwrite what an earlier attempt
# of the same load left; readers go by the ledger, so an unfinished load is not
# seen.

BRONZE = "raw_data variant, ingested_at timestamp_ntz, source_file string, modified timestamp_ntz, bad_text string, load string"
LEDGER = "source_file string, modified timestamp_ntz, size long, n_values long, bad_values long, load string"

#: Files that one read of a load takes: bounds the path list on the driver.
FILES_PER_READ = 10_000


def load_folder(bronze_path: str, load: str) -> str:
    return f"{bronze_path.rstrip('/')}/load={load}"


def ledger_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}__loads"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not any(name.startswith("load=") for name in folders(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_ledger(spark: SparkSession, bronze_path: str) -> DataFrame:
    """One row a loaded file version: its values, how many do not parse (then the
    readers skip all of that version), and the load."""
    return _stored(spark, ledger_path(bronze_path), LEDGER)


def date_range(first: str, last: str) -> Column:
    """Days first .. last (ISO), as predicates on the partition columns alone."""
    year, month, day = (F.col(c).cast("int") for c in ("year", "month", "day"))
    (y, m, d), (yy, mm, dd) = ([int(x) for x in t.split("-")] for t in (first, last))
    return (((year > y) | ((year == y) & ((month > m) | ((month == m) & (day >= d)))))
            & ((year < yy) | ((year == yy) & ((month < mm) | ((month == mm) & (day <= dd))))))


def landed_files(spark: SparkSession, path: str, pattern: str = PATTERN, days: tuple[str, str] | None = None) -> DataFrame:
    """path, source_file, modified, size of the landing files (their content is
    not read): all below ``path``, in date partitions or not, or with ``days``
    (first, last) those of some date partitions, which prunes the rest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    files = files.load(path).where(date_range(*days)) if days else files.option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("_metadata.file_path").alias("source_file"),
                        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
                        F.col("_metadata.file_size").alias("size"))


def is_new(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files (or rows of files) in a version that no load has."""
    done = ledger.select("source_file", "modified").distinct()
    return files.join(done, ["source_file", "modified"], "left_anti")


def next_load(spark: SparkSession, bronze_path: str) -> str:
    """Ids of batch loads count up: an unfinished load is done again under its id."""
    done = read_ledger(spark, bronze_path).where(F.col("load").startswith("batch-"))
    last = done.agg(F.max(F.substring("load", 7, 12).cast("long"))).first()[0]
    return f"batch-{0 if last is None else last + 1:012d}"


def write_load(rows: DataFrame, bronze_path: str, load: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).parquet(load_folder(bronze_path, load))


def commit_load(spark: SparkSession, bronze_path: str, load: str, files: DataFrame | None = None) -> None:
    """The load's ledger rows: counted from its stored rows (three columns of them
    are read), and with ``files`` also those without any value."""
    stored = spark.read.schema("source_file string, modified timestamp_ntz, bad_text string").parquet(load_folder(bronze_path, load))
    counts = stored.groupBy("source_file", "modified").agg(
        F.count(F.lit(1)).alias("n_values"), F.count("bad_text").alias("bad_values"))
    rows = counts.withColumn("size", F.lit(None).cast("long")) if files is None else \
        files.select("source_file", "modified", "size").join(counts, ["source_file", "modified"], "left")
    (rows.select("source_file", "modified", "size", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_values", "bad_values")])
     .write.mode("overwrite").parquet(f"{ledger_path(bronze_path)}/load={load}"))


def load_files(spark: SparkSession, path: str, bronze_path: str, multi_line: bool = False,
               ingested_at: Column | str | None = None, pattern: str = PATTERN, force: bool = False,
               days: tuple[str, str] | None = None, files_per_read: int = FILES_PER_READ) -> str | None:
    """Load the files below ``path`` that are new or changed since they were
    loaded (``force``: all of them) and return the load's id, or None if there
    are none.  The ingest time is stored: every later read sees the same."""
    files = landed_files(spark, path, pattern, days)
    if not force:
        files = is_new(files, read_ledger(spark, bronze_path))
    load, listing = next_load(spark, bronze_path), f"{bronze_path.rstrip('/')}__pending"
    files.write.mode("overwrite").parquet(listing)          # the landing is listed once
    pending = spark.read.schema(files.schema).parquet(listing)
    mode, paths = "overwrite", []

    def read_some() -> None:
        nonlocal mode, paths
        lines = spark.read.text(paths, wholetext=multi_line)
        write_load(parse_text(lines, ingested_at), bronze_path, load, mode)
        mode, paths = "append", []

    for row in pending.select("path").toLocalIterator():
        paths.append(re.sub(r"([\[\]{}*?\\])", r"\\\1", row["path"]))       # names, not globs
        if len(paths) == files_per_read:
            read_some()
    if paths:
        read_some()
    if mode == "append":
        commit_load(spark, bronze_path, load, pending)
    remove(spark, listing)
    return load if mode == "append" else None


def stored_values(spark: SparkSession, bronze_path: str, load: str | None = None) -> DataFrame:
    """All stored values of the finished loads (or one), with ``file_skipped``: the
    file has, in that load, a value that does not parse."""
    ledger, rows = read_ledger(spark, bronze_path), _stored(spark, bronze_path, BRONZE)
    if load is not None:        # a partition of either table
        ledger, rows = ledger.where(F.col("load") == load), rows.where(F.col("load") == load)
    # one ledger row a file and load; AQE broadcasts it where it is small
    flags = ledger.select("source_file", "modified", "load", (F.col("bad_values") > 0).alias("file_skipped"))
    return rows.join(flags, ["source_file", "modified", "load"])


def read_bronze(spark: SparkSession, bronze_path: str, load: str | None = None) -> DataFrame:
    """Objects of the stored table (or of one load), arrays stripped.  A file with
    a value that does not parse is skipped in the loads that had it so: loaded
    again after a repair, it is there."""
    rows = stored_values(spark, bronze_path, load).where(~F.col("file_skipped"))
    return variant_rows(rows.drop("bad_text", "file_skipped"))


def load_bronze(spark: SparkSession, path: str, bronze_path: str, multi_line: bool = False,
                ingested_at: Column | str | None = None, pattern: str = PATTERN, force: bool = False,
                days: tuple[str, str] | None = None) -> DataFrame:
    """``load_files``, then the objects of the whole table."""
    load_files(spark, path, bronze_path, multi_line, ingested_at, pattern, force, days)
    return read_bronze(spark, bronze_path)


def bad_files(spark: SparkSession, bronze_path: str) -> DataFrame:
    """File versions that the readers skip, with the number of unparsable values
    and the smallest of them (whole text)."""
    return (stored_values(spark, bronze_path).where("bad_text IS NOT NULL").groupBy("source_file", "load")
            .agg(F.count(F.lit(1)).alias("bad_values"), F.min("bad_text").alias("sample")))
