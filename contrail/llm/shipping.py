"""Make this package importable in the Python workers of every executor, and
bound the batches they get."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import contrail

_SHIPPED: set[str] = set()

#: Texts can be long: an Arrow batch ends at so many rows or bytes.  Settings
#: that the session changed are left alone.
BATCH_ROWS, BATCH_BYTES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"), \
    ("spark.sql.execution.arrow.maxBytesPerBatch", None, "16m")


def bound_batches(spark: SparkSession) -> None:
    for key, usual, bound in (BATCH_ROWS, BATCH_BYTES):
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, bound)


def ship(spark: SparkSession) -> None:
    """Adds the package's modules to the application (once), as
    ``spark-submit --py-files`` would; the executors fetch them from the driver."""
    bound_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(contrail.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="contrail-"), "contrail.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
