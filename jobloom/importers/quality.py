"""Importer of quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.importers.base import Importer
from jobloom.schemas import QUALITY

# File name, table name, error text and the column that names the job.
FILE_NAME = "quality_report.tsv"
NAMESPACE, TABLE = "autoimport", "checkm2"
NO_FILES = "No checkm2 quality report files found"
JOB_COLUMN = "cts_job_id"


def _with_job(rows: DataFrame, jobs: DataFrame) -> DataFrame:
    return rows.withColumn(JOB_COLUMN, F.col("id"))


QUALITY_IMPORTER = Importer(
    name="quality_report",
    namespace=NAMESPACE,
    table=TABLE,
    schema=QUALITY,
    keys=["Name"],
    file_columns=[c for c in QUALITY.names if c != JOB_COLUMN],
    accepts=lambda file: F.substring_index(file, "/", -1) == FILE_NAME,
    no_files_error=NO_FILES,
    transform=_with_job,
)
