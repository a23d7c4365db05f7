"""Table equality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side; empty if the tables are equal as bags.

    Like `exceptAll` both ways, but with one exchange: rows are counted up for one side and
    down for the other.
    """
    columns = actual.columns
    signed = actual.withColumn("_n", F.lit(1)).unionByName(
        expected.select(*columns).withColumn("_n", F.lit(-1))
    )
    counts = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return counts.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_n")))).select(
        *columns, F.when(F.col("_n") > 0, "actual").otherwise("expected").alias("side")
    )
