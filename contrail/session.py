"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every contrail job expects. Time zone is pinned to UTC so that the
# few LTZ conversions (streaming event time) are stable; all stored
# timestamps are TIMESTAMP_NTZ.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # whole-stage method beyond that would run interpreted (10x slower than
    # the per-operator fallback Spark uses above this limit).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The driver keeps plan/metric history for finished executions even with
    # the UI off; a long-lived session running many queries only needs a few.
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "10000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "contrail", extra: dict | None = None,
                driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor.
            conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for checkpoints and intermediate tables:
    ``spark.checkpoint.dir``.  Where the session has none, a fresh local folder
    is made on a local master only; a cluster without one is an error, since
    its executors would each write to their own disk."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = sc.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def cluster_conf(input_bytes: int, executor_cores: int = 4, executors: int = 1000) -> dict:
    """Starting settings for a cluster run over ``input_bytes`` of landing
    data (pass to ``get_session(extra=...)`` or spark-submit).

    * 256 MiB scan splits: ~400k scan tasks for 100 TB, each well inside
      executor memory.
    * Initial shuffle partitions sized for ~512 MiB of the widest shuffle
      (the Silver dedup, about the input size), never fewer than the task
      slots; AQE then coalesces small partitions toward the advisory size and
      splits skewed ones.
    * Broadcasts stay at the checked 64 MiB threshold (AQE re-checks at run
      time from real shuffle sizes).
    """
    mib = 1 << 20
    slots = executor_cores * executors
    partitions = max(slots, int(input_bytes // (512 * mib)) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * mib),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mib),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * mib),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mib),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mib),
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds the package's modules to the application (once), as ``spark-submit
    --py-files`` would: Python workers on other machines import them."""
    import contrail
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(contrail.__file__))
    # code only, on the driver; executors fetch it from there
    path = os.path.join(tempfile.mkdtemp(prefix="contrail-"), "contrail.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
