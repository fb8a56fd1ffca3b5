"""The library on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import gristmill

_shipped: set[str] = set()

# Whole texts are long: a batch between Spark and Python carries this many bytes, unless the session says otherwise.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT, BATCH_BYTES = "67108864b", "8m"


def ship(spark: SparkSession) -> None:
    """Set the session up: small batches, and the package on the executors unless their Python finds it by itself.

    It does if the driver's PYTHONPATH or working folder has it, which workers inherit; a job that was
    submitted with the package as ``--py-files`` has it on the path as well.
    """
    # Asked with a default of its own, the session would not name the value that holds if nobody set one.
    if spark.conf.get(BATCH) == BATCH_DEFAULT:
        spark.conf.set(BATCH, BATCH_BYTES)
    root = Path(gristmill.__file__).resolve().parent.parent
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _shipped or any(path and Path(path).resolve() == root for path in known) or not root.is_dir():
        return
    # Only the driver reads this file; Spark serves it to the executors.
    target = Path(tempfile.mkdtemp(prefix="gristmill-package-")) / "gristmill_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted((root / "gristmill").rglob("*.py")):
            archive.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
