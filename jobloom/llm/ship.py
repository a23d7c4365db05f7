"""Sending this package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


# A batch of long texts stays small in the executor and in its Python workers.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
           "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship_package(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, once per application, and keep the Arrow
    batches of this session small.

    Has the effect of `--py-files` for a session that was started without it.
    """
    context = spark.sparkContext
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    if context.applicationId not in _sent:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        context.addPyFile(str(target))
        _sent.add(context.applicationId)
    return spark
