"""Write and read a table in a namespace of its own, as a check at start-up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.operators.compare import differences
from jobloom.schemas import EMPLOYEES
from jobloom.sources import tables


def probe_rows(spark: SparkSession, n: int = 10) -> DataFrame:
    """A few generated rows."""
    return spark.range(n).select(
        F.col("id").cast("int").alias(EMPLOYEES.names[0]),
        F.concat(F.lit("probe "), "id").alias(EMPLOYEES.names[1]))


def self_check(spark: SparkSession, rows: DataFrame | None = None,
               provider: str = "parquet") -> None:
    """Raise unless a table that was written reads back the same. The namespace is always
    dropped again."""
    namespace = "check_" + uuid.uuid4().hex
    expected = probe_rows(spark) if rows is None else rows
    tables.create_namespace(spark, namespace, if_not_exists=False)
    try:
        table = f"{tables.quoted(namespace)}.written"
        tables.overwrite_table(expected, table, provider)
        if wrong := differences(tables.scan_table(spark, table), expected).head(5):
            raise ValueError(f"the start-up check failed, rows that differ: {wrong}")
    finally:
        tables.drop_namespace(spark, namespace)
